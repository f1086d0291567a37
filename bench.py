"""Benchmark the headline jobs; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_REPEAT`` (timed runs per query, default 2).  Each query is
run once to warm up, then timed ``BENCH_REPEAT`` times and the best run is
reported; a run executes the whole plan into Spark's ``noop`` sink (nothing is
collected to the driver).  Storing the bucketed order tables is timed once, as a
line of its own.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from platewise.queries import all_queries  # noqa: E402
from platewise.session import get_session  # noqa: E402

HEADLINE = (
    "customer_category",
    "menu_category",
    "menu_category_by_count",
    "shop_category",
    "shop_category_change",
    "area_category",
    "backfill_days",
    "agg_popularity",
    "customer_category_list",
    "serve_recommendations",
    "tag_decode",
    "fn_clean_text",
    "upsert_by_key",
    "tag_menus",
    "ml_train_text",
)


def run(spark, fn, sf: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def extra(spark, sf: str, repeat: int) -> dict[str, float]:
    """One-off storing of the bucketed order tables (after a first job has started the JVM's
    workers), a gold job over plain files, and the serving join without building its table."""
    from platewise.plans import gold, lists
    from platewise.queries import _stored_lists
    from platewise.sources.fixtures import RUN_DATE, Fixtures

    spark.read.parquet(f"{sf}/orders.parquet").agg({"o_orderkey": "max"}).collect()
    f, t0 = Fixtures(spark, sf), time.perf_counter()
    f.order_transaction(), f.order_item()
    out = {"store_order_tables_once": round(time.perf_counter() - t0, 3)}
    plain = Fixtures(spark, sf, materialise=False)
    unstored = lambda *_: gold.customer_category(
        plain.order_transaction(), plain.order_item(), plain.dish_tagging(), RUN_DATE)
    table, requests = _stored_lists(f), f.requests()
    for name, fn in (("customer_category_from_plain_files", unstored),
                     ("serve_join_only", lambda *_: lists.serve(requests, table))):
        run(spark, fn, sf)
        out[name] = round(min(run(spark, fn, sf) for _ in range(repeat)), 3)
    return out


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    qs = all_queries()
    keys = sys.argv[1:] or list(HEADLINE)
    times: dict[str, float] = {}
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    if not sys.argv[1:]:
        times |= extra(spark, sf, int(os.environ.get("BENCH_REPEAT", "2")))
    for k in keys:
        run(spark, qs[k], sf)
        times[k] = round(min(run(spark, qs[k], sf) for _ in range(repeat)), 3)
    sf_name = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_warm_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf_name, "cpus": int(cpus),
                      "spark": spark.version}))


if __name__ == "__main__":
    main()
