"""Time the headline queries; prints one line of JSON.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores.
All work runs once to warm up and then ``BENCH_RUNS`` times (default 5) in
turn; the median counts. Tables that a job needs are made before its time. Results go to a sink that reads every row and keeps none.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from pyspark.sql import SparkSession, functions as F

from gapmend import operators as op, sinks
from gapmend.plans import queries as q, repair

HEADLINE = [
    "coverage_status",
    "composite_coverage",
    "missing_keys",
    "missing_rows",
    "matched_rows",
    "matched_copies",
    "present_key_days",
    "target_duplicate_keys",
    "duplicate_occurrences",
    "dedup_target",
    "csv_scan",
    "history_load",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gapmend-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def median_seconds(works: dict, runs: int) -> dict[str, float]:
    """Seconds of each piece of work, taken in turn so that no order shows.

    Work is a function, or a pair of one that prepares, which is not timed, and
    one that gets what was prepared.
    """
    taken = {name: [] for name in works}
    for turn in range(runs + 1):
        for name, work in works.items():
            prepare, act = work if isinstance(work, tuple) else (lambda: None, lambda _, work=work: work())
            ready = prepare()
            start = time.perf_counter()
            act(ready)
            if turn:
                taken[name].append(time.perf_counter() - start)
    return {name: round(statistics.median(seconds), 4) for name, seconds in taken.items()}


def prepared(spark, sf_dir: str) -> dict:
    """Jobs on a table, which is made before the clock starts."""
    def landed():
        return q.landed_orders(spark, sf_dir, "bench")

    def lines():
        rows = q.read(spark, sf_dir, "lineitem").withColumn("day", q._month(F.col("l_shipdate")))
        table = q.Landing(spark, rows.schema, "bench_lines")
        sinks.append_dynamic(rows, table.name, rebalance=True)
        return table

    def repaired(table, **options):
        repair(q.orders(spark, sf_dir), table.name, q.ORDER_KEY, day=q.RUN_DAY, **options)
        table.close()

    def files_of(rows, keys, source, shared):
        drain(op.duplicate_files(rows, keys, source, shared))

    source = q.orders(spark, sf_dir).select(F.col(q.ORDER_KEY).alias("l_orderkey"))
    span = op.resolve_range(q.orders(spark, sf_dir), q.ORDER_KEY)
    return {
        "duplicate_files": (
            lambda: q.landed_lines(spark, sf_dir), lambda rows: files_of(rows, "l_orderkey", source, "l_orderkey")
        ),
        "duplicate_line_files": (
            lambda: q.landed_lines(spark, sf_dir), lambda rows: files_of(rows, q.LINE_KEY, source, "l_orderkey")
        ),
        "repair_exact": (landed, repaired),
        "repair_exact_given_range": (landed, lambda table: repaired(table, key_range=span)),
        "repair_range": (landed, lambda table: repaired(table, mode="range")),
        "dedup_partition_rewrite": (
            lines, lambda table: sinks.rewrite_duplicates(spark, table.name, q.LINE_KEY, q.LINE_ORDER)
        ),
    }


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def other_forms(spark, sf_dir: str) -> dict:
    """The same answers asked in ways that this library avoids."""
    source, target = q.orders(spark, sf_dir), q.landed(spark, sf_dir)
    key = q.ORDER_KEY
    marked = target.select(F.col(key).alias("t"))
    joined = source.join(marked, source[key] == marked.t, "left_outer")
    outer = joined.where("t IS NULL").select(source[key])
    anti = source.join(target, key, "left_anti").select(key)

    def four_actions():
        source.join(target, key).count()
        source.count()
        outer.orderBy(key).agg(F.min(key)).collect()
        outer.orderBy(key).agg(F.max(key)).collect()

    return {
        "coverage_as_four_actions": four_actions,
        "coverage_in_one": lambda: op.coverage(source, target, key).collect(),
        "missing_by_outer_join": lambda: drain(outer),
        "missing_by_anti_join": lambda: drain(anti),
        "missing_by_count": lambda: drain(op.missing_keys(source, target, key)),
        "range_by_sort": lambda: anti.orderBy(key).rdd.map(lambda r: r[0]).min(),
        "range_by_aggregate": lambda: op.missing_range(source, target, key).collect(),
    }


def scans(spark, sf_dir: str, form: str = "parquet", ranged: bool = True) -> dict[str, int]:
    """How often a validated repair reads its source and its target."""
    source, place = q.orders(spark, sf_dir), "orders.parquet"
    if form == "csv":
        source, place = q.csv_scan(spark, sf_dir), "orders-csv"
    span = op.resolve_range(q.orders(spark, sf_dir), q.ORDER_KEY) if ranged else None
    table = q.landed_orders(spark, sf_dir, "scanned")
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    repair(source, table.name, q.ORDER_KEY, day=q.RUN_DAY, key_range=span)
    runs = store.executionsList(before, 100)
    plans = [runs.apply(i).physicalPlanDescription() for i in range(runs.length())]
    table.close()
    places = {"source": place, "target": table.path}
    return {
        side: sum(scanned(plan).count(name) for plan in plans)
        for side, name in places.items()
    }


def scanned(plan: str) -> str:
    """The locations that the plan which ran has scanned, one per line."""
    if "\n\n\n" not in plan:
        return ""
    tree = plan[: plan.index("\n\n\n")].split("== Initial Plan ==")[0]
    places = []
    for number in re.findall(r"Scan \w+ .*\((\d+)\)", tree):
        block = plan[plan.index(f"\n({number}) Scan") :]
        # Up to the next node; rows of the driver have no location.
        places += re.findall(r"Location: (.*)", block.split("\n\n")[0])
    return "\n".join(places)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    works = {name: lambda name=name: drain(q.QUERIES[name](spark, sf_dir)) for name in HEADLINE}
    works |= prepared(spark, sf_dir)
    forms = other_forms(spark, sf_dir)
    taken = median_seconds(works | forms, runs)
    seconds = {name: taken[name] for name in works}
    forms = {name: taken[name] for name in forms}
    result = {
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "forms": forms,
        "scans_per_repair": {
            f"{form}, {'range given' if ranged else 'no range'}": scans(spark, sf_dir, form, ranged)
            for form in ("parquet", "csv")
            for ranged in (True, False)
        },
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
