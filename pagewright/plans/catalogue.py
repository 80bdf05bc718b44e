"""All registered queries of the document engine and their SQL."""

from __future__ import annotations

from ..operators import documents, kqi, markup, quality, relate, state, tables_in_text, telemetry
from ..streaming import health

MODULES = (quality, kqi, telemetry, relate, state, documents, markup, tables_in_text, health)

QUERIES = {k: q for m in MODULES for k, q in m.QUERIES.items()}
ORACLES = {k: q for m in MODULES for k, q in m.ORACLES.items()}
