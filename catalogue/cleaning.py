"""Files, filters, casts, fills, bins and outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import catalogue, table
from plumbline.operators import binning, clean, outliers
from plumbline.operators.gate import table_gate as gate
from plumbline.operators.sample import split_train_test
from plumbline.sources.files import load_table, materialize, save_sized, save_table, write_split as save_split
from plumbline.sources.files import scan_csv as read_csv
from plumbline.sources.scratch import new_path

SUPPLIER = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"


@catalogue.add("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def scan_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "supplier-csv")
    table(spark, folder, "supplier").write.option("header", "true").csv(path)
    return read_csv(spark, path, SUPPLIER)


@catalogue.add("""
SELECT 'csv' AS format, p_partkey, p_name, p_size, p_retailprice FROM part
UNION ALL SELECT 'json', p_partkey, p_name, p_size, p_retailprice FROM part
UNION ALL SELECT 'orc', p_partkey, p_name, p_size, p_retailprice FROM part
UNION ALL SELECT 'parquet', p_partkey, p_name, p_size, p_retailprice FROM part
""")
def load_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    base = new_path(spark, "part")
    out = None
    for form in ("csv", "json", "orc", "parquet"):
        save_table(part, f"{base}/{form}", form)
        back = load_table(spark, f"{base}/{form}", form, part.schema)
        back = back.select(F.lit(form).alias("format"), *part.columns)
        out = back if out is None else out.unionByName(back)
    return out


@catalogue.add("SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey")
def materialize_reuse(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "orders-per-customer")

    def build() -> DataFrame:
        return table(spark, folder, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"))

    def never() -> DataFrame:
        raise AssertionError("the table is complete and must be reused")

    materialize(spark, path, build)
    return materialize(spark, path, never)


HASH = "('0x' || substr(md5(concat_ws('|', '42', CAST({key} AS VARCHAR))), 1, 15))::BIGINT"


@catalogue.add(f"""
SELECT o_orderkey, o_orderstatus,
  CASE WHEN row_number() OVER (ORDER BY {HASH.format(key='o_orderkey')})
       <= ceil(round(count(*) OVER () * 0.2, 9)) THEN 'test' ELSE 'train' END AS split
FROM orders
""")
def write_split(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    path = new_path(spark, "orders-split")
    save_split(split_train_test(orders, "o_orderkey"), path, rows_per_file=1_000_000)
    return spark.read.parquet(path)


# Orders with gaps: one priority is missing, one status is blank, low prices are missing.
def gappy_orders(spark: SparkSession, folder: str) -> DataFrame:
    priority, price = F.col("o_orderpriority"), F.col("o_totalprice")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.nullif(priority, F.lit("4-NOT SPECIFIED")).alias("priority"),
        F.when(F.col("o_orderstatus") == "P", "  ").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(price < 50_000, None).when(price > 450_000, float("nan")).otherwise(price).alias("price"),
    )


GAPPY = """
WITH gappy AS (
  SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority,
    CASE WHEN o_orderstatus = 'P' THEN '  ' ELSE o_orderstatus END AS status,
    CASE WHEN o_totalprice < 50000 OR o_totalprice > 450000 THEN NULL ELSE o_totalprice END AS price
  FROM orders
)
"""


@catalogue.add(GAPPY + "SELECT * FROM gappy WHERE priority IS NOT NULL AND price IS NOT NULL")
def drop_missing(spark: SparkSession, folder: str) -> DataFrame:
    return clean.drop_missing(gappy_orders(spark, folder))


@catalogue.add(GAPPY + "SELECT o_orderkey, priority, status FROM gappy WHERE trim(status) <> ''")
def drop_blank(spark: SparkSession, folder: str) -> DataFrame:
    return clean.drop_blank(gappy_orders(spark, folder), "status").drop("price")


@catalogue.add("""
SELECT p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size,
  TRY_CAST(p_brand AS DOUBLE) AS p_brand, TRY_CAST(split_part(p_name, ' ', 1) AS BIGINT) AS word
FROM part
""")
def cast_columns(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select(
        "p_partkey", "p_name", "p_size", "p_brand", F.split_part("p_name", F.lit(" "), F.lit(1)).alias("word")
    )
    return clean.cast_columns(part, {"p_size": "string", "p_brand": "double", "word": "bigint", "absent": "int"})


@catalogue.add("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS o_orderstatus FROM orders
""")
def map_values(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return clean.map_values(orders, "o_orderstatus", {"F": 1, "O": 0})


@catalogue.add("SELECT p_size, 0 AS p_width, p_partkey, 0 AS p_depth FROM part")
def align_columns(spark: SparkSession, folder: str) -> DataFrame:
    return clean.align_columns(table(spark, folder, "part"), ["p_size", "p_width", "p_partkey", "p_depth"])


@catalogue.add(GAPPY + """
SELECT o_orderkey, round(coalesce(price, (SELECT quantile_cont(price, 0.5) FROM gappy)), 6) AS price FROM gappy
""")
def impute_median(spark: SparkSession, folder: str) -> DataFrame:
    filled = clean.impute_median(gappy_orders(spark, folder), ["price"])
    return filled.select("o_orderkey", F.round("price", 6).alias("price"))


@catalogue.add(GAPPY + "SELECT o_orderkey, coalesce(priority, 'missing') AS priority FROM gappy")
def impute_constant(spark: SparkSession, folder: str) -> DataFrame:
    return clean.impute_constant(gappy_orders(spark, folder).select("o_orderkey", "priority"), ["priority"])


@catalogue.add("""
SELECT p_partkey, CASE WHEN p_size <= 12 THEN 'Newer' WHEN p_size <= 48 THEN 'Medium' ELSE 'Long-term' END AS p_size_bins
FROM part
""")
def bin_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return binning.bin_fixed(table(spark, folder, "part").select("p_partkey", "p_size"), "p_size")


def event_values(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("value")
    return table(spark, folder, "events").select("event_id", "value", (value * value).alias("square"))


FENCES = """
WITH ev AS (SELECT event_id, value, value * value AS square FROM events),
q AS (
  SELECT quantile_cont(value, 0.25) AS v1, quantile_cont(value, 0.75) AS v3,
         quantile_cont(square, 0.25) AS s1, quantile_cont(square, 0.75) AS s3 FROM ev
),
counted AS (
  SELECT event_id, value,
    CAST(value < v1 - 1.5 * (v3 - v1) OR value > v3 + 1.5 * (v3 - v1) AS INTEGER)
    + CAST(square < s1 - 1.5 * (s3 - s1) OR square > s3 + 1.5 * (s3 - s1) AS INTEGER) AS outlier_count,
    square > s3 + 1.5 * (s3 - s1) OR square < s1 - 1.5 * (s3 - s1) AS square_out,
    value < v1 - 1.5 * (v3 - v1) OR value > v3 + 1.5 * (v3 - v1) AS value_out
  FROM ev, q
)
"""
COLUMNS = ["value", "square"]


@catalogue.add("""
WITH long AS (
  SELECT 'value' AS "column", value AS v FROM events UNION ALL SELECT 'square', value * value FROM events
), q AS (
  SELECT "column", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM long GROUP BY 1
)
SELECT "column", round(q1, 6) AS q1, round(q3, 6) AS q3,
  round(q1 - 1.5 * (q3 - q1), 6) AS lower_bound, round(q3 + 1.5 * (q3 - q1), 6) AS upper_bound
FROM q
""")
def iqr_bounds(spark: SparkSession, folder: str) -> DataFrame:
    events = event_values(spark, folder)
    found = outliers.bounds_table(events, outliers.fit_iqr(events, COLUMNS))
    return found.select("column", *[F.round(c, 6).alias(c) for c in found.columns[1:]])


@catalogue.add(FENCES + "SELECT event_id, value, outlier_count FROM counted")
def outlier_count(spark: SparkSession, folder: str) -> DataFrame:
    events = event_values(spark, folder)
    return outliers.outlier_count(events, outliers.fit_iqr(events, COLUMNS)).drop("square")


@catalogue.add(FENCES + "SELECT event_id, value FROM counted WHERE outlier_count < 2")
def remove_outliers(spark: SparkSession, folder: str) -> DataFrame:
    events = event_values(spark, folder)
    return outliers.remove_outliers(events, outliers.fit_iqr(events, COLUMNS)).drop("square")


@catalogue.add("""
WITH m AS (SELECT avg(value) AS mean, stddev_samp(value) AS std FROM events)
SELECT event_id, value, CAST(value < mean - 3 * std OR value > mean + 3 * std AS INTEGER) AS outlier_count
FROM events, m
""")
def sigma_outliers(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "value")
    return outliers.outlier_count(events, outliers.fit_sigma(events, ["value"]))


@catalogue.add(FENCES + """
SELECT 'value' AS "column", count(*) FILTER (value_out) AS n_outliers, count(*) AS n_rows,
  round(count(*) FILTER (value_out) / count(*), 3) AS fraction FROM counted
UNION ALL
SELECT 'square', count(*) FILTER (square_out), count(*), round(count(*) FILTER (square_out) / count(*), 3) FROM counted
""")
def outlier_report(spark: SparkSession, folder: str) -> DataFrame:
    events = event_values(spark, folder)
    return outliers.outlier_report(events, outliers.fit_iqr(events, COLUMNS))


@catalogue.add("""
SELECT 'orders' AS "table", 'columns' AS "check", 'pass' AS status, 'all present' AS detail
UNION ALL SELECT 'orders', 'rows', CASE WHEN count(*) >= 1000 THEN 'pass' ELSE 'fail' END,
  CASE WHEN count(*) >= 1000 THEN 'at least 1000' ELSE 'fewer than 1000' END FROM orders
UNION ALL SELECT 'returns', 'columns', 'fail', 'missing: r_reason'
UNION ALL SELECT 'returns', 'rows', CASE WHEN count(*) >= 1 THEN 'pass' ELSE 'fail' END,
  CASE WHEN count(*) >= 1 THEN 'at least 1' ELSE 'fewer than 1' END FROM orders WHERE o_totalprice < 0
""")
def table_gate(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    full = gate(orders, ["o_orderkey", "o_totalprice"], 1000)
    empty = gate(orders.filter("o_totalprice < 0"), ["o_orderkey", "r_reason"])
    return full.select(F.lit("orders").alias("table"), "*").unionByName(
        empty.select(F.lit("returns").alias("table"), "*")
    )


@catalogue.add("""
SELECT o_orderkey, o_totalprice, (SELECT greatest(1, least(200, count(*) // 10000)) FROM orders)::BIGINT AS files FROM orders
""")
def layout_by_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Orders saved in as many files as their number asks for."""
    path = new_path(spark, "sized")
    save_sized(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), path)
    written = spark.read.parquet(path)
    files = written.select(F.col("_metadata.file_path")).distinct().count()
    return written.withColumn("files", F.lit(files).cast("long"))
