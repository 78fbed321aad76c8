"""Encoders, scalers and the prepared feature table."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import catalogue, table
from catalogue.cleaning import GAPPY, HASH, gappy_orders
from plumbline.operators import binning, features, stages, vocabulary
from plumbline.plans.prepare import prepare, prepare_with_metrics
from plumbline.sources.scratch import materialize_once, new_path
from plumbline.spec import FeatureSpec

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def dummies(column: str, values: list[str], name: str | None = None) -> str:
    """SQL list of 0/1 columns."""
    return ", ".join(
        f"CAST(coalesce({column} = '{v}', false) AS INTEGER) AS \"{name or column}_{v}\"" for v in values
    )


@catalogue.add(f"""
SELECT o_orderkey, {dummies('o_orderstatus', ['F', 'O', 'P'])}, {dummies('o_orderpriority', PRIORITIES)} FROM orders
""")
def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    encoder = stages.DummyEncoder(inputCols=["o_orderstatus", "o_orderpriority", "absent"])
    return encoder.fit(orders).transform(orders)


def binned_parts(spark: SparkSession, folder: str) -> DataFrame:
    return binning.bin_fixed(table(spark, folder, "part").select("p_partkey", "p_size"), "p_size")


@catalogue.add("""
SELECT p_partkey, CASE WHEN p_size <= 12 THEN 2.0::DOUBLE WHEN p_size <= 48 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS p_size_bins
FROM part
""")
def ordinal_encode(spark: SparkSession, folder: str) -> DataFrame:
    parts = binned_parts(spark, folder)
    return stages.CategoryIndexer(inputCols=["p_size_bins"]).fit(parts).transform(parts)


@catalogue.add("""
SELECT p_partkey, CASE WHEN p_size <= 12 THEN 0.0::DOUBLE WHEN p_size <= 48 THEN 1.0::DOUBLE END AS p_size_bins FROM part
""")
def ordinal_mapped(spark: SparkSession, folder: str) -> DataFrame:
    parts = binned_parts(spark, folder)
    indexer = stages.CategoryIndexer(
        inputCols=["p_size_bins"], orders={"p_size_bins": ["Newer", "Medium"]}, onInvalid="keep_null"
    )
    return indexer.fit(parts).transform(parts)


@catalogue.add("""
SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS DOUBLE) AS o_orderstatus FROM orders
""")
def label_encode(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return stages.CategoryIndexer(inputCols=["o_orderstatus"], onInvalid="error").fit(orders).transform(orders)


@catalogue.add("""
SELECT p_partkey, CASE WHEN p_size < 20 THEN 'No' WHEN p_size < 40 THEN 'Yes' ELSE 'Unknown' END AS answer FROM part
""")
def label_decode(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", F.floor(F.col("p_size") / 20).cast("double").alias("index"))
    decoder = stages.LabelDecoder(inputCol="index", outputCol="answer", values=["No", "Yes"])
    return decoder.transform(parts).drop("index")


SCALED = ["l_quantity", "l_extendedprice", "l_discount"]


def rounded_lines(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in SCALED})


def lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *SCALED)


def scaled_sql(shift: str, scale: str) -> str:
    fitted = ", ".join(
        f"{shift.format(c=c)} AS {c}_shift, {scale.format(c=c)} AS {c}_scale" for c in SCALED
    )
    out = ", ".join(f"round(({c} - {c}_shift) / {c}_scale, 9) AS {c}" for c in SCALED)
    return f"WITH m AS (SELECT {fitted} FROM lineitem) SELECT l_orderkey, l_linenumber, {out} FROM lineitem, m"


@catalogue.add(scaled_sql("min({c})", "max({c}) - min({c})"))
def minmax_scale(spark: SparkSession, folder: str) -> DataFrame:
    rows = lines(spark, folder)
    return rounded_lines(stages.MinMaxScale(inputCols=SCALED).fit(rows).transform(rows))


@catalogue.add(scaled_sql("avg({c})", "stddev_pop({c})"))
def standard_scale(spark: SparkSession, folder: str) -> DataFrame:
    rows = lines(spark, folder)
    return rounded_lines(stages.StandardScale(inputCols=SCALED).fit(rows).transform(rows))


@catalogue.add("""
WITH m AS (SELECT min(p_retailprice) AS low, max(p_retailprice) AS high FROM part)
SELECT l_orderkey, l_linenumber, round((l_extendedprice - low) / (high - low), 9) AS price, 0.5::DOUBLE AS flat
FROM lineitem, m
""")
def minmax_apply(spark: SparkSession, folder: str) -> DataFrame:
    flat = F.lit(7.0).alias("flat")
    parts = table(spark, folder, "part").select(F.col("p_retailprice").alias("price"), flat)
    path = new_path(spark, "minmax")
    stages.MinMaxScale(inputCols=["price", "flat"]).fit(parts).write().overwrite().save(path)
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"), flat
    )
    return stages.MinMaxModel.load(path).transform(rows).withColumn("price", F.round("price", 9))


@catalogue.add(GAPPY + f""", filled AS (
  SELECT o_orderkey, coalesce(priority, 'missing') AS priority, status,
    coalesce(price, (SELECT quantile_cont(price, 0.5) FROM gappy)) AS price, o_orderdate
  FROM gappy JOIN orders USING (o_orderkey)
), m AS (SELECT avg(price) AS mean, stddev_pop(price) AS std FROM filled)
SELECT o_orderkey, CAST(CASE status WHEN '  ' THEN 0 WHEN 'F' THEN 1 ELSE 2 END AS DOUBLE) AS status,
  round((price - mean) / std, 6) AS price,
  {dummies('priority', ['1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW', 'missing'])},
  CAST(CASE WHEN (2002 - year(o_orderdate)) * 12 - month(o_orderdate) <= 12 THEN 2
    WHEN (2002 - year(o_orderdate)) * 12 - month(o_orderdate) <= 48 THEN 1 ELSE 0 END AS DOUBLE) AS months_bins,
  day(o_orderdate) AS day_of_month
FROM filled, m
""")
def column_preprocess(spark: SparkSession, folder: str) -> DataFrame:
    dates = table(spark, folder, "orders").select(
        "o_orderkey",
        ((2002 - F.year("o_orderdate")) * 12 - F.month("o_orderdate")).alias("months"),
        F.dayofmonth("o_orderdate").alias("day_of_month"),
    )
    rows = binning.bin_fixed(gappy_orders(spark, folder).join(dates, "o_orderkey"), "months")
    spec = FeatureSpec(
        key="o_orderkey",
        target="status",
        nominal=("priority",),
        numerical=("price",),
        binned="months",
        remainder=("day_of_month",),
    )
    out = features.column_preprocessor(rows, spec).transform(rows)
    return out.withColumn("price", F.round("price", 6))


@catalogue.add("""
SELECT l_quantity, l_tax, CASE WHEN l_linestatus = 'O' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
FROM lineitem WHERE l_discount <> 0
""")
def assemble_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        F.when(F.col("l_discount") != 0, F.col("l_quantity")).alias("l_quantity"),
        "l_tax",
        F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0).alias("label"),
    )
    vectors = features.assemble_features(rows, ["l_quantity", "l_tax"], "label")
    return features.vector_to_columns(vectors, "features", ["l_quantity", "l_tax"])


# Orders with their customer as a raw record: text price that may be blank,
# months since the order, two skewed numbers, a yes/no target.
RAW_SPEC = FeatureSpec(
    key="order_id",
    target="done",
    nominal=("segment", "priority"),
    numerical=("spend", "charge"),
    binned="months",
    remainder=("nation",),
    critical="charge",
)


def raw_records(spark: SparkSession, folder: str) -> DataFrame:
    """The raw table, joined and written once: fitting passes over it several times."""
    share = F.col("o_totalprice") / 100000.0
    square = share * share
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    orders = table(spark, folder, "orders")
    raw = orders.join(customers, orders["o_custkey"] == customers["c_custkey"]).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("c_mktsegment").alias("segment"),
        F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("priority"),
        ((2002 - F.year("o_orderdate")) * 12 - F.month("o_orderdate")).alias("months"),
        F.col("c_nationkey").alias("nation"),
        (square * square).alias("spend"),
        F.when(F.col("o_orderstatus") == "P", " ").otherwise((square * square * share).cast("string")).alias("charge"),
        F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No").alias("done"),
    )
    return materialize_once(raw, "raw-records")


def hash_split_sql(source: str, key: str, label: str) -> str:
    """Stratified 20% test assignment: ceil of the total, by largest remainder."""
    return f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {HASH.format(key=key)}) AS rn FROM {source}
), class AS (
  SELECT {label} AS c, count(*) AS n, sum(count(*)) OVER () AS total FROM {source} GROUP BY 1
), share AS (
  SELECT c, ceil(round(total * 0.2, 9)) AS wanted, ceil(round(total * 0.2, 9)) * n / total AS part FROM class
), size AS (
  SELECT c, floor(part) + CASE WHEN row_number() OVER (ORDER BY floor(part) - part, CAST(c AS VARCHAR))
    <= wanted - sum(floor(part)) OVER () THEN 1 ELSE 0 END AS n_test FROM share
), assigned AS (
  SELECT ranked.*, CASE WHEN rn <= n_test THEN 'test' ELSE 'train' END AS split
  FROM ranked JOIN size ON size.c = ranked.{label}
)"""


RAW = """
WITH raw AS (
  SELECT o_orderkey AS order_id, c_mktsegment AS segment, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority,
    (2002 - year(o_orderdate)) * 12 - month(o_orderdate) AS months, c_nationkey AS nation,
    ((o_totalprice / 100000) * (o_totalprice / 100000)) * ((o_totalprice / 100000) * (o_totalprice / 100000)) AS spend,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE ((o_totalprice / 100000) * (o_totalprice / 100000))
      * ((o_totalprice / 100000) * (o_totalprice / 100000)) * (o_totalprice / 100000) END AS charge,
    CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END AS done
  FROM orders JOIN customer ON o_custkey = c_custkey
), clean AS (SELECT * FROM raw WHERE priority IS NOT NULL AND charge IS NOT NULL)
"""
FENCE = """
q AS (
  SELECT quantile_cont(spend, 0.25) AS s1, quantile_cont(spend, 0.75) AS s3,
    quantile_cont(charge, 0.25) AS c1, quantile_cont(charge, 0.75) AS c3 FROM {source} {where}
), kept AS (
  SELECT {source}.* FROM {source}, q
  WHERE CAST(spend < s1 - 1.5 * (s3 - s1) OR spend > s3 + 1.5 * (s3 - s1) AS INTEGER)
    + CAST(charge < c1 - 1.5 * (c3 - c1) OR charge > c3 + 1.5 * (c3 - c1) AS INTEGER) < 2
)"""
PREPARED = f"""
SELECT order_id, nation, round((spend - s_low) / (s_high - s_low), 9) AS spend,
  round((charge - c_low) / (c_high - c_low), 9) AS charge, {dummies('segment', SEGMENTS)},
  {dummies('priority', ['1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW'])},
  CAST(CASE WHEN months <= 12 THEN 2 WHEN months <= 48 THEN 1 ELSE 0 END AS DOUBLE) AS months_bins,
  CAST(done = 'Yes' AS DOUBLE) AS done, split
"""
RANGE = """
range_ AS (
  SELECT min(spend) AS s_low, max(spend) AS s_high, min(charge) AS c_low, max(charge) AS c_high FROM {source} {where}
)"""
SQL_TRAIN = (
    RAW + ", " + hash_split_sql("clean", "order_id", "done") + ", "
    + FENCE.format(source="assigned", where="WHERE split = 'train'") + ", "
    + RANGE.format(source="kept", where="WHERE split = 'train'")
)
SQL_ALL = (
    RAW + ", " + FENCE.format(source="clean", where="") + ", "
    + hash_split_sql("kept", "order_id", "done") + ", " + RANGE.format(source="assigned", where="")
)


def rounded_features(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in RAW_SPEC.numerical})


@catalogue.add(SQL_TRAIN + PREPARED + " FROM kept, range_")
def feature_prepare(spark: SparkSession, folder: str) -> DataFrame:
    return rounded_features(prepare(raw_records(spark, folder), RAW_SPEC))


@catalogue.add(SQL_ALL + PREPARED + " FROM assigned, range_")
def feature_prepare_all(spark: SparkSession, folder: str) -> DataFrame:
    return rounded_features(prepare(raw_records(spark, folder), RAW_SPEC, fit_scope="all"))


@catalogue.add(SQL_ALL + """
SELECT (SELECT count(*) FROM raw) AS raw_rows,
  (SELECT count(*) FROM raw WHERE priority IS NULL OR charge IS NULL) AS missing_rows,
  (SELECT count(*) FROM clean) - count(*) AS outliers_removed, count(*) AS dataset_rows,
  count(*) FILTER (split = 'train') AS training_rows, count(*) FILTER (split = 'test') AS test_rows,
  13 AS num_features
FROM assigned
""")
def prep_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return prepare_with_metrics(raw_records(spark, folder), RAW_SPEC, new_path(spark, "prepared"), fit_scope="all")


@catalogue.add(f"""
SELECT o_orderkey, {dummies('o_orderstatus', ['F', 'O', 'P'])}, round((o_totalprice - low) / (high - low), 9) AS o_totalprice
FROM orders, (SELECT min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders)
""")
def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Saved and reloaded preparation gives the same rows as the fitted one."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    fitted = PipelineModel([
        stages.DummyEncoder(inputCols=["o_orderstatus"]).fit(orders),
        stages.MinMaxScale(inputCols=["o_totalprice"]).fit(orders),
    ])
    path = new_path(spark, "preparation")
    fitted.write().overwrite().save(path)
    loaded = PipelineModel.load(path).transform(orders)
    return loaded.withColumn("o_totalprice", F.round("o_totalprice", 9))


@catalogue.add("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, CAST(l_partkey AS VARCHAR) AS part, strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM lineitem),
p AS (SELECT part, CAST(row_number() OVER (ORDER BY part) - 1 AS DOUBLE) AS part_index FROM (SELECT DISTINCT part FROM l)),
s AS (SELECT shipped, CAST(row_number() OVER (ORDER BY shipped) - 1 AS DOUBLE) AS shipped_index FROM (SELECT DISTINCT shipped FROM l))
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, part_index AS part, shipped_index AS shipped, part AS decoded,
  CAST((SELECT count(*) FROM p) AS BIGINT) AS width
FROM l JOIN p USING (part) JOIN s USING (shipped)
""")
def vocabulary_encode(spark: SparkSession, folder: str) -> DataFrame:
    """Two columns of many values indexed from dictionaries that are tables, one decoded again, one also as a sparse vector."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", F.col("l_partkey").cast("string").alias("part"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped")
    )
    fitted = vocabulary.VocabularyIndexer(inputCols=["part", "shipped"], onInvalid="error").fit(lines)
    indexed = fitted.decode(fitted.transform(lines), "part", "decoded", "part")
    sparse = vocabulary.SparseDummies(fitted).transform(indexed)
    hot = F.try_element_at(vector_to_array("shipped_vec"), (F.col("shipped") + 1).cast("int"))
    width = F.lit(fitted.sizes(spark)["part"]).cast("long")
    return sparse.where(hot == 1).select(*indexed.columns, width.alias("width"))
