"""Time the headline queries and a full refresh; prints one JSON line.

BENCH_SF_DIR names the folder of test tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerloom import TableSink, refresh  # noqa: E402
from ledgerloom.plans.registry import registered  # noqa: E402
from ledgerloom.session import local_session  # noqa: E402
from ledgerloom.sources.testdata import AS_OF, bank_tables  # noqa: E402

HEADLINES = (
    "int_transactions_decoded",
    "int_fees_decoded",
    "int_acct_cust_bridge",
    "fct_account_summary",
    "fct_customer_360",
    "fct_fees_revenue",
    "fct_channel_agg",
    "fct_daily_transactions",
    "fct_branch_performance",
    "fct_division_performance",
    "metric_active_accounts_asof",
    "dq_report",
)
REPEATS = 3


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    queries = registered()

    def discard(name: str) -> None:
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()

    for name in HEADLINES:
        discard(name)
    timings = {
        name: statistics.median(seconds(lambda: discard(name)) for _ in range(REPEATS))
        for name in HEADLINES
    }
    target = tempfile.mkdtemp(prefix="ledgerloom-bench-")

    def full_refresh() -> None:
        refresh(bank_tables(spark, folder), TableSink(path=target), AS_OF).checks.collect()

    # the first one is cold: of three, the median is a warm one
    timings["refresh_all_tables"] = statistics.median(seconds(full_refresh) for _ in range(REPEATS))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries and full refresh, median seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in timings.items()},
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
