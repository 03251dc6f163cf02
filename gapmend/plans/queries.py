"""Every operator as a query over the test tables.

Most queries ask how ``lineitem`` covers ``orders``: orders are the source,
line items the landed copies, their ship date the day they landed on. That
pair has real gaps (orders without lines) and real duplicates (orders with
many lines, and repeated line numbers within an order).

Queries that write use tables partitioned by month, under fresh paths in the
shared folder, and give back what a reader then finds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from gapmend import functions as fn, operators as op, sinks, sources
from gapmend.plans.jobs import history, repair
from gapmend.shared import delete_path, fresh_path, write_shared

ORDER_KEY = "o_orderkey"
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]
RUN_TS = "2024-02-01 06:30:00"
RUN_DAY = "2024-02-01"

Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").withColumn("day", _date(F.col("l_shipdate")))


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and days of the orders that have landed, one row per line."""
    return lines(spark, sf_dir).select(F.col("l_orderkey").alias(ORDER_KEY), "day")


def _date(ts: Column) -> Column:
    return ts.cast("date").cast("string")


def _month(ts: Column) -> Column:
    return _date(F.trunc(ts.cast("date"), "month"))


class Landing:
    """A day-partitioned Parquet table under a fresh path."""

    def __init__(self, spark: SparkSession, schema: StructType, label: str):
        self.spark = spark
        self.path = fresh_path(spark, label)
        self.name = f"{label}_{self.path[-32:]}"
        sinks.create_table(spark, self.name, schema, self.path)
        self.schema = sinks.table_schema(spark, self.name, partitions=True)

    def close(self) -> DataFrame:
        """Forget the table and read its files."""
        self.spark.sql(f"DROP TABLE {self.name}")
        return self.spark.read.schema(self.schema).parquet(self.path)


def landed_orders(spark: SparkSession, sf_dir: str, label: str) -> Landing:
    """A table of the orders that have lines, by month of order."""
    found = op.matched_rows(orders(spark, sf_dir), landed(spark, sf_dir), ORDER_KEY)
    rows = found.drop("target_rows").withColumn("day", _month(F.col("o_orderdate")))
    table = Landing(spark, rows.schema, label)
    sinks.append_dynamic(rows, table.name, rebalance=True)
    return table


# Sources


def key_range_probe(spark, sf_dir):
    return op.key_range(orders(spark, sf_dir), ORDER_KEY)


def range_scan(spark, sf_dir):
    """Orders whose key is within the ids of the events, which end earlier."""
    low, high = op.resolve_range(read(spark, sf_dir, "events"), "event_id", low=100)
    return op.in_range(orders(spark, sf_dir), ORDER_KEY, low, high)


CSV = {"delimiter": ";", "null_value": "NA", "quote": "'", "charset": "UTF-8"}


def _orders_csv(spark, sf_dir) -> str:
    """Orders as text: some NULLs, and a delimiter inside one field."""
    path = fresh_path(spark, "orders-csv")
    status = F.col("o_orderstatus")
    text = orders(spark, sf_dir).withColumns(
        {
            "o_totalprice": F.col("o_totalprice").cast("decimal(12,2)"),
            "o_orderdate": F.col("o_orderdate").cast("string"),
            "o_orderstatus": F.when(status != "P", status),
            "o_orderpriority": F.concat_ws(";", status, "o_orderpriority"),
        }
    )
    text.write.options(header=True, sep=";", nullValue="NA", quote="'").csv(path)
    return path


def csv_scan(spark, sf_dir):
    return sources.read_source(spark, "csv", path=_orders_csv(spark, sf_dir), **CSV)


def target_scan(spark, sf_dir):
    view = f"lineitem_{fresh_path(spark, 'view')[-32:]}"
    read(spark, sf_dir, "lineitem").createTempView(view)
    rows = sources.read_source(spark, "table", name=view)
    spark.catalog.dropTempView(view)
    return rows


def _file_stem(filename: Column) -> Column:
    return F.regexp_extract(fn.split_path(filename).getField("key"), r"([^/]+)\.parquet", 1)


def scan_with_file(spark, sf_dir):
    rows = fn.file_name(read(spark, sf_dir, "lineitem"))
    return rows.withColumn("filename", _file_stem(F.col("filename")))


# Projections


def change_envelope(spark, sf_dir):
    return fn.change_envelope(orders(spark, sf_dir), "sales.orders", RUN_TS)


def _decimal_orders(spark, sf_dir):
    return orders(spark, sf_dir).withColumns(
        {
            ORDER_KEY: F.col(ORDER_KEY).cast("decimal(18,0)"),
            "o_totalprice": F.col("o_totalprice").cast("decimal(12,2)"),
        }
    )


def decimal_widening(spark, sf_dir):
    return fn.widen_decimals(_decimal_orders(spark, sf_dir))


def conform_schema(spark, sf_dir):
    rows = orders(spark, sf_dir)
    target = [*rows.dtypes, ("dat_kafka", "string")]
    text = rows.select(
        *[F.col(n).cast("string").alias(n.upper()) for n in rows.columns],
        F.lit("batch").alias("ORIGIN"),
    )
    return fn.conform(text, target)


def schema_drift(spark, sf_dir):
    target = [
        ("O_ORDERKEY", "int"),
        ("o_custkey", "bigint"),
        ("o_orderstatus", "string"),
        ("o_totalprice", "decimal(7,2)"),
        ("o_orderdate", "date"),
        ("o_comment", "string"),
        ("dat_kafka", "string"),
    ]
    return fn.schema_drift(orders(spark, sf_dir), target)


def target_order_projection(spark, sf_dir):
    target = ["L_SHIPDATE", "L_LINENUMBER", "L_ORDERKEY", "L_QUANTITY"]
    return fn.project_to_target(read(spark, sf_dir, "lineitem"), target)


def partition_stamp(spark, sf_dir):
    return fn.partition_stamp(orders(spark, sf_dir), RUN_DAY)


def business_day_partition(spark, sf_dir):
    day = fn.business_day(F.col("ts"))
    return fn.partition_stamp(read(spark, sf_dir, "events"), day)


# Coverage


def coverage_status(spark, sf_dir):
    return op.coverage(orders(spark, sf_dir), landed(spark, sf_dir), ORDER_KEY)


def composite_coverage(spark, sf_dir):
    """Do the orders and days of shipped lines cover those of all lines?"""
    rows = lines(spark, sf_dir)
    keys = [*LINE_KEY, "day"]
    return op.coverage(rows, rows.where(F.col("l_linestatus") == "F"), keys)


def _some_null(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(key, F.when(F.col(key) % 10 != 7, F.col(key)))


def coverage_null_keys(spark, sf_dir):
    """Every tenth order and line has lost its key."""
    source = _some_null(orders(spark, sf_dir), ORDER_KEY)
    return op.coverage(source, _some_null(landed(spark, sf_dir), ORDER_KEY), ORDER_KEY)


def missing_keys(spark, sf_dir):
    found = op.missing_keys(orders(spark, sf_dir), landed(spark, sf_dir), ORDER_KEY)
    return found.orderBy(ORDER_KEY)


def _part_text(spark, sf_dir):
    """Keys of the parts as text, a small source."""
    return read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("l_partkey"))


def _returned(spark, sf_dir):
    """Lines of large quantity that came back; some parts have none."""
    return read(spark, sf_dir, "lineitem").where("l_returnflag = 'R' AND l_quantity > 25").select("l_partkey")


def missing_text_keys(spark, sf_dir):
    """Text against whole numbers, which the order of text would mix up."""
    found = op.missing_keys(_part_text(spark, sf_dir), _returned(spark, sf_dir), "l_partkey")
    return found.select(F.col("l_partkey").cast("bigint").alias("l_partkey"), "source_rows")


def coverage_text_keys(spark, sf_dir):
    found = op.coverage(_part_text(spark, sf_dir), _returned(spark, sf_dir), "l_partkey")
    return found.drop("min_missing", "max_missing")


def _half_landed(spark, sf_dir) -> DataFrame:
    """Orders without those that are pending; some have landed twice."""
    rows = orders(spark, sf_dir).where("o_orderstatus <> 'P'").select(ORDER_KEY)
    return rows.unionByName(rows.where(F.col(ORDER_KEY) % 500 == 0))


def coverage_dense(spark, sf_dir):
    """A key with few gaps and few copies, compared by words of 64 keys."""
    return op.coverage(orders(spark, sf_dir), _half_landed(spark, sf_dir), ORDER_KEY, dense=True)


def missing_keys_dense(spark, sf_dir):
    return op.missing_keys(orders(spark, sf_dir), _half_landed(spark, sf_dir), ORDER_KEY)


def missing_keys_preview(spark, sf_dir):
    return op.missing_preview(orders(spark, sf_dir), landed(spark, sf_dir), ORDER_KEY)


def missing_range(spark, sf_dir):
    return op.missing_range(orders(spark, sf_dir), landed(spark, sf_dir), ORDER_KEY)


def missing_rows(spark, sf_dir):
    return op.missing_rows(orders(spark, sf_dir), landed(spark, sf_dir), ORDER_KEY)


def unlabelled_documents(spark, sf_dir):
    """Whole documents that no label covers."""
    documents, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return op.missing_rows(documents, labels, "doc_id")


def rows_in_missing_range(spark, sf_dir):
    return op.rows_in_missing_range(
        orders(spark, sf_dir), landed(spark, sf_dir), ORDER_KEY
    )


def matched_rows(spark, sf_dir):
    return op.matched_rows(orders(spark, sf_dir), landed(spark, sf_dir), ORDER_KEY)


def matched_copies(spark, sf_dir):
    return op.matched_copies(orders(spark, sf_dir), landed(spark, sf_dir), ORDER_KEY)


def present_key_days(spark, sf_dir):
    return op.present_key_days(orders(spark, sf_dir), landed(spark, sf_dir), ORDER_KEY)


# Duplicates


def target_duplicate_keys(spark, sf_dir):
    return op.duplicate_keys(read(spark, sf_dir, "lineitem"), LINE_KEY)


def source_keys_duplicated(spark, sf_dir):
    found = op.source_keys_duplicated(
        orders(spark, sf_dir), landed(spark, sf_dir), ORDER_KEY
    )
    return found.orderBy(ORDER_KEY)


def duplicate_occurrences(spark, sf_dir):
    return op.duplicate_occurrences(lines(spark, sf_dir), LINE_KEY)


def duplicate_row_numbers(spark, sf_dir):
    return op.number_rows(lines(spark, sf_dir), LINE_KEY, LINE_ORDER)


def landed_lines(spark, sf_dir) -> DataFrame:
    """Lines as files under month folders, with the folder each was read from."""
    path = fresh_path(spark, "landed-lines")
    rows = read(spark, sf_dir, "lineitem").withColumn("month", _month(F.col("l_shipdate")))
    rows.hint("rebalance", "month").write.partitionBy("month").parquet(path)
    schema = rows.schema
    found = fn.file_name(spark.read.schema(schema).parquet(path))
    folder = F.regexp_extract(fn.split_path(F.col("filename")).getField("key"), r"(month=[^/]+)/[^/]+$", 1)
    return found.withColumn("filename", folder).withColumn("day", _date(F.col("l_shipdate")))


def duplicate_files(spark, sf_dir):
    rows = landed_lines(spark, sf_dir).select(F.col("l_orderkey").alias(ORDER_KEY), "day", "filename")
    return op.duplicate_files(rows, ORDER_KEY, orders(spark, sf_dir)).orderBy(ORDER_KEY)


def duplicate_line_files(spark, sf_dir):
    """For the orders that are not finished."""
    source = orders(spark, sf_dir).where("o_orderstatus <> 'F'").select(F.col(ORDER_KEY).alias("l_orderkey"))
    found = op.duplicate_files(landed_lines(spark, sf_dir), LINE_KEY, source, "l_orderkey")
    return found.orderBy(LINE_KEY)


def dedup_target(spark, sf_dir):
    return op.dedup(read(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER)


def dedup_partition_rewrite(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").withColumn("day", _month(F.col("l_shipdate")))
    table = Landing(spark, rows.schema, "lines")
    sinks.append_dynamic(rows, table.name, rebalance=True)
    sinks.rewrite_duplicates(spark, table.name, LINE_KEY, LINE_ORDER)
    return table.close()


# Sinks


def append_static_partition(spark, sf_dir):
    table = landed_orders(spark, sf_dir, "appended")
    rows = op.missing_rows(orders(spark, sf_dir), landed(spark, sf_dir), ORDER_KEY)
    staged = sinks.stage(rows, fresh_path(spark, "staged"), "parquet")
    sinks.append_static(staged, table.name, RUN_DAY)
    return table.close()


def append_dynamic_partition(spark, sf_dir):
    rows = business_day_partition(spark, sf_dir)
    table = Landing(spark, rows.schema, "events")
    sinks.append_dynamic(rows, table.name, rebalance=True)
    return table.close()


def partition_inventory(spark, sf_dir):
    rows = business_day_partition(spark, sf_dir)
    table = Landing(spark, rows.schema, "inventory")
    rows.hint("rebalance", "day").write.partitionBy("day").parquet(table.path)
    listed = sinks.sync_partitions(spark, table.name)
    table.close()
    return listed


def partition_states(spark, sf_dir):
    """Days that the catalog knows, one whose folder is gone, and new ones."""
    rows = business_day_partition(spark, sf_dir)
    table = Landing(spark, rows.schema, "states")
    sinks.append_dynamic(rows.where("day < '2024-01-20'"), table.name, rebalance=True)
    delete_path(spark, f"{table.path}/day=2024-01-05")
    later = rows.where("day >= '2024-01-20'")
    later.hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(table.path)
    states = write_shared(sinks.partition_states(spark, table.name), "partition-states").frame
    table.close()
    return states


def newest_landed(spark, sf_dir):
    """What the file that landed last holds: the totals after all the lines."""
    path = fresh_path(spark, "newest")
    rows = lines(spark, sf_dir).withColumn("day", _month(F.col("l_shipdate")))
    rows.hint("rebalance", "day").write.partitionBy("day").parquet(path)
    totals = rows.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))
    totals.withColumn("day", F.lit("1992-06-01")).coalesce(1).write.mode("append").partitionBy("day").parquet(path)
    schema = sources.newest_schema(spark, path, fmt="parquet")
    return spark.read.schema(schema).parquet(sources.newest_file(spark, path, ending=".parquet"))


def append_resumed(spark, sf_dir):
    """A full load that is run twice under one name appends each row once."""
    table = landed_orders(spark, sf_dir, "resumed")
    path = fresh_path(spark, "staged")
    for _ in range(2):
        repair(
            orders(spark, sf_dir), table.name, ORDER_KEY, "full", day=RUN_DAY, staging_path=path, staging_format="parquet",
            run_id="load-1",
        )
    return table.close()


def null_partition_rows(spark, sf_dir):
    """Orders landed under the month they first shipped in; some never did."""
    shipped = landed(spark, sf_dir).groupBy(ORDER_KEY).agg(
        F.min(F.to_date("day")).alias("first_day")
    )
    rows = orders(spark, sf_dir).join(shipped, ORDER_KEY, "left")
    rows = rows.withColumn("day", _month(F.col("first_day"))).drop("first_day")
    table = Landing(spark, rows.schema, "undated")
    sinks.append_dynamic(rows, table.name, rebalance=True)
    return sinks.null_partition_rows(table.close())


def history_load(spark, sf_dir):
    path = fresh_path(spark, "history")
    source = fn.change_envelope(_decimal_orders(spark, sf_dir), "sales.orders", RUN_TS)
    history(source, path, fmt="parquet")
    return spark.read.parquet(path)


# Jobs


def _repair(spark, sf_dir, mode, **options):
    table = landed_orders(spark, sf_dir, f"repair_{mode}")
    source = orders(spark, sf_dir)
    repair(source, table.name, ORDER_KEY, mode, day=RUN_DAY, **options)
    return table.close()


def repair_exact(spark, sf_dir):
    return _repair(spark, sf_dir, "exact")


def repair_range(spark, sf_dir):
    return _repair(spark, sf_dir, "range")


def repair_null_keys(spark, sf_dir):
    """A source whose keys are partly gone: such rows are not appended."""
    table = landed_orders(spark, sf_dir, "repair_null")
    repair(_some_null(orders(spark, sf_dir), ORDER_KEY), table.name, ORDER_KEY, day=RUN_DAY)
    return table.close()


def _repair_text(spark, sf_dir, mode):
    """The table holds every third order, and keeps the number as text."""
    rows = orders(spark, sf_dir).withColumn("day", _month(F.col("o_orderdate")))
    text = rows.withColumn(ORDER_KEY, F.col(ORDER_KEY).cast("string"))
    table = Landing(spark, text.schema, f"text_{mode}")
    sinks.append_dynamic(text.where(F.col(ORDER_KEY).cast("bigint") % 3 == 0), table.name, rebalance=True)
    repair(orders(spark, sf_dir), table.name, ORDER_KEY, mode, day=RUN_DAY)
    return table.close()


def repair_text_key(spark, sf_dir):
    return _repair_text(spark, sf_dir, "exact")


def repair_text_key_range(spark, sf_dir):
    return _repair_text(spark, sf_dir, "range")


def repair_unsynced(spark, sf_dir):
    """Another system has landed files that the catalog does not know of."""
    rows = orders(spark, sf_dir).withColumn("day", _month(F.col("o_orderdate")))
    table = Landing(spark, rows.schema, "unsynced")
    known = F.col("o_orderdate") < F.lit("1995-01-01")
    sinks.append_dynamic(rows.where(known), table.name, rebalance=True)
    later = rows.where(~known & (F.col(ORDER_KEY) % 5 != 0))
    later.hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(table.path)
    repair(orders(spark, sf_dir), table.name, ORDER_KEY, day=RUN_DAY)
    return table.close()


def repair_full(spark, sf_dir):
    path = fresh_path(spark, "staged")
    return _repair(spark, sf_dir, "full", staging_path=path, staging_format="parquet")


def repair_from_csv(spark, sf_dir):
    table = landed_orders(spark, sf_dir, "repair_csv")
    repair(csv_scan(spark, sf_dir), table.name, ORDER_KEY, day=RUN_DAY, parse_once=True)
    return table.close()


def _priority_text(df: DataFrame) -> DataFrame:
    """Closed orders have the number of their priority, others its name too;
    every seventh key is no number either."""
    priority, key = F.col("o_orderpriority"), F.col(ORDER_KEY)
    return df.withColumns(
        {
            "o_orderpriority": F.when(F.col("o_orderstatus") == "F", F.left(priority, F.lit(1))).otherwise(priority),
            ORDER_KEY: F.concat(F.when(key % 7 == 0, "no. ").otherwise(""), key.cast("string")),
        }
    )


def _checked_repair(spark, sf_dir, mode) -> tuple[DataFrame, DataFrame]:
    """Into a table that holds every third order: the table, and what was lost."""
    rows = orders(spark, sf_dir).withColumn("day", _month(F.col("o_orderdate")))
    rows = rows.withColumn("o_orderpriority", F.left("o_orderpriority", F.lit(1)).cast("int"))
    table = Landing(spark, rows.schema, "checked")
    sinks.append_dynamic(rows.where(F.col(ORDER_KEY) % 3 == 0), table.name, rebalance=True)
    path = fresh_path(spark, "rejects")
    source = _priority_text(orders(spark, sf_dir))
    repair(source, table.name, ORDER_KEY, mode, RUN_DAY, on_error="null", rejects_path=path)
    return table.close(), spark.read.parquet(path)


def repair_with_rejects(spark, sf_dir):
    return _checked_repair(spark, sf_dir, "exact")[0]


def repair_rejects(spark, sf_dir):
    """The keys and priorities that were no numbers, where rows lacked."""
    lost = _checked_repair(spark, sf_dir, "exact")[1]
    return lost.select("column", "value", "source_type", "target_type", "row.o_orderkey", "row.o_orderstatus")


def history_rejects(spark, sf_dir):
    """Decimals that no whole number of 64 bits can hold."""
    source = orders(spark, sf_dir).select(
        ORDER_KEY, (F.col(ORDER_KEY).cast("decimal(20,0)") * F.lit(10**18).cast("decimal(19,0)")).cast("decimal(38,0)").alias("wide")
    )
    path, lost = fresh_path(spark, "history"), fresh_path(spark, "rejects")
    history(source, path, "parquet", on_error="null", rejects_path=lost)
    failed = spark.read.parquet(lost).select("row.o_orderkey", "value", "target_type")
    return spark.read.parquet(path).join(failed, ORDER_KEY, "left")


def history_from_csv(spark, sf_dir):
    path = fresh_path(spark, "history")
    history(csv_scan(spark, sf_dir), path, fmt="parquet")
    return spark.read.parquet(path)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        key_range_probe,
        range_scan,
        csv_scan,
        target_scan,
        scan_with_file,
        change_envelope,
        decimal_widening,
        conform_schema,
        schema_drift,
        target_order_projection,
        partition_stamp,
        business_day_partition,
        coverage_status,
        composite_coverage,
        coverage_null_keys,
        missing_keys,
        missing_text_keys,
        coverage_text_keys,
        coverage_dense,
        missing_keys_dense,
        missing_keys_preview,
        missing_range,
        missing_rows,
        unlabelled_documents,
        rows_in_missing_range,
        matched_rows,
        matched_copies,
        present_key_days,
        target_duplicate_keys,
        source_keys_duplicated,
        duplicate_occurrences,
        duplicate_row_numbers,
        duplicate_files,
        duplicate_line_files,
        dedup_target,
        dedup_partition_rewrite,
        append_static_partition,
        append_dynamic_partition,
        partition_inventory,
        partition_states,
        newest_landed,
        append_resumed,
        null_partition_rows,
        history_load,
        repair_exact,
        repair_range,
        repair_full,
        repair_null_keys,
        repair_text_key,
        repair_text_key_range,
        repair_unsynced,
        repair_from_csv,
        repair_with_rejects,
        repair_rejects,
        history_from_csv,
        history_rejects,
    )
}
