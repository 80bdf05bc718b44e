"""What the driver holds between the steps of a query."""

import re
from pathlib import Path

from pagewright.llm import runtime


def test_freed_native_memory_is_given_back(spark):
    """malloc keeps what the JVM freed between things still in use; written() and swept() end with little of it."""
    status = Path(f"/proc/{spark._jvm.java.lang.ProcessHandle.current().pid()}/status")
    held = lambda: int(re.search(r"VmRSS:\s+(\d+)", status.read_text())[1]) >> 10
    for step in (runtime.swept, lambda session: runtime.written(session.range(1), "one")):
        step(spark)
        start, kept = held(), [spark._jvm.java.util.zip.Deflater() for _ in range(3000)]
        full = held()
        for deflater in kept[::2]:
            deflater.end()
        step(spark)
        left = held()
        for deflater in kept[1::2]:
            deflater.end()
        assert full - start > 100 and full - left > (full - start) / 4, (start, full, left)
