"""Print the physical plan of registered queries.

    python tools/explain_plans.py [sf_dir] [name ...]   (default: the bench's headline queries)

Plans are printed as Spark formats them (``explain("formatted")``); nothing is
executed beyond what planning needs.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kerbside.queries import QUERIES  # noqa: E402
from kerbside.session import build_session  # noqa: E402

PLANNED_ONLY = ["silver_listings", "market_impact", "diesel_devaluation", "impact_summary",
                "run_quality_checks", "backfill_missing", "incremental_silver"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or PLANNED_ONLY
    spark = build_session("local[8]", 8)
    for name in names:
        print("=" * 24, name)
        QUERIES[name](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
