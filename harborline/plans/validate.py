"""The validation report as a command: prints each check and the counts, and ends with 1 if any check failed.

    python -m harborline.plans.validate /data/tables
"""

from __future__ import annotations

import sys
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from ..sources import trade
from . import quality


def summary(report: DataFrame) -> tuple[list[str], int]:
    """Lines to print of a report (category, name, status), a row a check, and the exit code: 1 with a FAIL, else 0."""
    rows = sorted(report.select("category", "name", "status").collect())
    counts = Counter(r.status for r in rows)
    lines = [f"[{r.status}] {r.category}: {r.name}" for r in rows]
    return [*lines, ", ".join(f"{s} {counts[s]}" for s in ("PASS", "WARN", "INFO", "FAIL"))], int(counts["FAIL"] > 0)


def main(args: list[str]) -> int:
    if len(args) != 1:
        print(__doc__)
        return 2
    lines, code = summary(trade.run(SparkSession.builder.getOrCreate(), args[0], quality.SQL["validation_report"]))
    print("\n".join(lines))
    return code


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
