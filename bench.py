"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  table folder (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default 8)
BENCH_RUNS    runs per query, the fastest counts (default 2)
"""

from __future__ import annotations

import json
import os
import time

from tally.session import build_session

HEADLINE = [
    "p09_share_of_total",
    "p10_change_against_baseline",
    "r01_unpivot_measures",
    "r03_pivot_many_values",
    "j01_candidates_inner",
    "j02_baseline_left",
    "j08_drop_listed",
    "u04_patch_union",
    "a04_postal_quota",
    "a08_first_row_of_key",
    "w01_carry_forward",
    "w05_quintile_of_hot_value",
    "w08_top_of_each_group",
    "t02_rest_after_leading",
    "f21_flatten_documents",
    "x02_newly_completed_batch",
    "l01_state_list_votes",
    "l02_constituency_direct_votes",
    "l03_constituency_list_votes",
    "l04_municipality_direct_votes",
    "l05_municipality_list_votes",
    "l16_strongholds",
    "l17_municipality_list_tables",
    "e01_snapshot_cycle",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("OFF")
    from tally.catalog import QUERIES

    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_custkey").count().write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
