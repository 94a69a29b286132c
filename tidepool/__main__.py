"""Run a named query and print its rows (the print sink, K1).

    python -m tidepool                      # list the query keys
    python -m tidepool rolling_top_words /root/testdata/sf0.01 [rows]
"""

from __future__ import annotations

import sys

from tidepool.plans.catalog import QUERIES
from tidepool.session import get_session


def main(argv: list[str]) -> int:
    if not argv or argv[0] not in QUERIES:
        print("query keys:", " ".join(sorted(QUERIES)))
        return 0 if not argv else 2
    key = argv[0]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    rows = int(argv[2]) if len(argv) > 2 else 20
    spark = get_session()
    QUERIES[key](spark, sf_dir).show(rows, truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
