"""The quality report: aggregated on the cluster, laid out on the driver from a few rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import page_stats, passed


def suggestions(score: float, empty: int, pages: int, failed: int, compliance: float, review: int) -> list[str]:
    share = empty / max(pages, 1)
    rules = [
        (score < 60, "The overall score is low: check whether recognition works."),
        (share > 0.1, f"Many empty pages ({share * 100:.1f} %): scans may be poor or recognition failed."),
        (failed > 0, f"{failed} documents failed: see the log."),
        (compliance < 100, f"Compliance is {compliance:.0f} %: some documents lack metadata."),
        (review > 0, f"{review} documents need a review."),
    ]
    return [text for on, text in rules if on] or ["Nothing to suggest."]


def quality_report(pages: DataFrame, findings: DataFrame, top: int = 50, failed: int = 0, compliance: float = 100.0) -> str:
    """Markdown: summary, documents by score (at most `top`), findings by check, suggestions. pages: name, body, n."""
    docs = page_stats(pages, "name")
    whole = docs.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pages", "empty_pages", "medium_pages", "long_pages")], F.count("*").alias("docs"), F.count_if("needs_review").alias("review")).first()
    score = round(100 * (whole.medium_pages + whole.long_pages) / whole.pages, 1) if whole.pages else 0.0
    result = passed(findings).first()
    rows = docs.orderBy(F.desc("score"), "name").limit(top).collect()
    checks = findings.groupBy("check", "severity").count().orderBy("check", "severity").collect()
    out = ["# Quality report", "", f"Documents: {whole.docs}, pages: {whole.pages}, score: {score}, passed: {'yes' if result.passed else 'no'}", "", "| Document | Pages | Empty | Score | Review |", "|---|---|---|---|---|"]
    out += [f"| {r.name} | {r.pages} | {r.empty_pages} | {r.score} | {'yes' if r.needs_review else ''} |" for r in rows]
    out += [f"… {whole.docs - top} more"] if whole.docs > top else []
    out += ["", "## Findings", "", *(f"- {r.check}, {r.severity}: {r['count']}" for r in checks), "", "## Suggestions", ""]
    return "\n".join(out + [f"- {s}" for s in suggestions(score, whole.empty_pages, whole.pages, failed, compliance, whole.review)]) + "\n"
