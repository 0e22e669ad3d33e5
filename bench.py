"""Time the headline queries on $BENCH_SF_DIR with $BENCH_CPUS local threads; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rollmatch.queries import QUERIES  # noqa: E402
from rollmatch.session import build_session  # noqa: E402

HEADLINE = (
    "a1_fill_down_global", "a2_fill_down_per_key", "a3_fill_records", "a5_concat_rows", "a6_collect_rows",
    "a7_roll_up_lists", "a8_roll_up_text", "a9_last_answers", "d1_keep_first", "d2_keep_last", "l4_row_numbers",
    "m1_merge_old_new", "m2_upsert_with_orphans", "m3_combine_keep_last", "j3_new_key_rows", "j4_new_rows",
    "j6_attach_labels", "j7_first_keyword", "j7_first_keyword_long_list", "r3_ranked_to_wide", "r4_wide_to_ranked",
    "v2_term_weights_documents", "v3_nearest_cosine", "v3_nearest_cosine_blocks", "v4_nearest_l2",
    "v5_retrieve_or_default", "e3_years_between", "e11_json_object", "t1_participant_summary", "s1_read_tab",
    "s10_read_latest_run", "x5_first_trouble", "g1_rolled_participants", "e5_participant_frame", "g3_allocate",
    "g6_ranked_predictions", "g8_reconcile_requests", "g9_tag_records", "g10_structured_table",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in HEADLINE if not sys.argv[1:] or n in sys.argv[1:]]
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
