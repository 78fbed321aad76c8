"""Profiles, frequencies and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import catalogue, table
from catalogue.cleaning import GAPPY, gappy_orders
from plumbline.operators import profile, stats
from plumbline.operators.balance import class_distribution as distribution
from plumbline.operators.sample import split_train_test

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@catalogue.add(GAPPY + """
SELECT 'o_orderkey' AS "column", count(*) FILTER (o_orderkey IS NULL) AS missing,
  count(*) FILTER (o_orderkey IS NULL) AS missing_or_blank FROM gappy
UNION ALL SELECT 'priority', count(*) FILTER (priority IS NULL OR priority = ''),
  count(*) FILTER (priority IS NULL OR trim(priority) = '') FROM gappy
UNION ALL SELECT 'status', count(*) FILTER (status IS NULL OR status = ''),
  count(*) FILTER (status IS NULL OR trim(status) = '') FROM gappy
UNION ALL SELECT 'price', count(*) FILTER (price IS NULL), count(*) FILTER (price IS NULL) FROM gappy
""")
def missing_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.missing_counts(gappy_orders(spark, folder))


def _long(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS v FROM {source}" for c in columns)


@catalogue.add(f"""
WITH long AS ({_long(NUMBERS, 'lineitem')})
SELECT "column", count(*) FILTER (v IS NULL) AS null_count,
  100.0 * count(*) FILTER (v IS NULL) / count(*) AS null_percentage,
  round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS stddev, min(v) AS min, max(v) AS max,
  round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.5), 6) AS median,
  round(quantile_cont(v, 0.75), 6) AS q3
FROM long GROUP BY "column"
""")
def column_stats_numeric(spark: SparkSession, folder: str) -> DataFrame:
    found = profile.column_stats(table(spark, folder, "lineitem"), NUMBERS)
    return rounded(rounded(found, 4, "mean", "stddev"), 6, "q1", "median", "q3")


@catalogue.add(GAPPY + """, long AS (
  SELECT 'priority' AS "column", priority AS v FROM gappy UNION ALL SELECT 'status', status FROM gappy
)
SELECT "column", count(*) FILTER (v IS NULL) AS null_count,
  round(100.0 * count(*) FILTER (v IS NULL) / count(*), 6) AS null_percentage,
  count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END) AS unique_values
FROM long GROUP BY "column"
""")
def column_stats_categorical(spark: SparkSession, folder: str) -> DataFrame:
    found = profile.categorical_stats(gappy_orders(spark, folder), ["priority", "status"])
    return rounded(found, 6, "null_percentage")


@catalogue.add("""
SELECT p_brand AS value, count(*) AS count FROM part GROUP BY p_brand ORDER BY 2 DESC, 1 LIMIT 10
""")
def top_values(spark: SparkSession, folder: str) -> DataFrame:
    return profile.top_values(table(spark, folder, "part"), "p_brand", 10)


TOP_COLUMNS = ["p_brand", "p_type", "p_size"]


@catalogue.add(" UNION ALL ".join(f"""
SELECT * FROM (SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS count,
  CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) AS INTEGER) AS rank FROM part GROUP BY {c})
WHERE rank <= 10""" for c in TOP_COLUMNS))
def top_values_of_all(spark: SparkSession, folder: str) -> DataFrame:
    return profile.top_values_of_all(table(spark, folder, "part"), TOP_COLUMNS, 10)


PROFILED = ["o_orderkey", "o_custkey", "o_totalprice"]


@catalogue.add(f"""
WITH long AS ({_long(PROFILED, 'orders')}), wide AS (
  SELECT "column", CAST(count(v) AS DOUBLE) AS count, avg(v) AS mean, stddev_samp(v) AS stddev,
    CAST(min(v) AS DOUBLE) AS min, CAST(max(v) AS DOUBLE) AS max FROM long GROUP BY "column"
)
SELECT "column", stat, round(value, 3) AS value FROM (
  SELECT '*' AS "column", 'rows' AS stat, CAST(count(*) AS DOUBLE) AS value FROM orders
  UNION ALL SELECT "column", 'count', count FROM wide
  UNION ALL SELECT "column", 'mean', mean FROM wide
  UNION ALL SELECT "column", 'stddev', stddev FROM wide
  UNION ALL SELECT "column", 'min', min FROM wide
  UNION ALL SELECT "column", 'max', max FROM wide
)
""")
def table_profile(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.table_profile(table(spark, folder, "orders")), 3, "value")


CATEGORIES = ["p_type", "p_brand"]


@catalogue.add("""
WITH long AS (
  SELECT 'p_type' AS "column", p_type AS value FROM part UNION ALL SELECT 'p_brand', p_brand FROM part
)
SELECT "column", value, count(*) AS count,
  round(count(*) / sum(count(*)) OVER (PARTITION BY "column") * 100, 2) AS percent
FROM long GROUP BY "column", value
""")
def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.value_counts(table(spark, folder, "part"), CATEGORIES)


@catalogue.add("""
WITH long AS (
  SELECT 'o_orderpriority' AS "column", o_orderpriority AS value, o_orderstatus FROM orders
  UNION ALL SELECT 'o_year', CAST(year(o_orderdate) AS VARCHAR), o_orderstatus FROM orders
)
SELECT "column", value, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) * 100, 6) AS rate
FROM long GROUP BY "column", value
""")
def rate_by_category(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        "o_orderpriority",
        F.year("o_orderdate").alias("o_year"),
        (F.col("o_orderstatus") == "F").cast("int").alias("done"),
    )
    return rounded(profile.rate_by_category(orders, ["o_orderpriority", "o_year"], "done"), 6, "rate")


@catalogue.add("""
SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F",
  count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P"
FROM orders GROUP BY o_orderpriority
""")
def crosstab(spark: SparkSession, folder: str) -> DataFrame:
    return profile.crosstab(table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


CHI2 = """
SELECT '{name}' AS pair, round(sum(pow(abs(o - e) - adj, 2) / e), 6) AS stat, max(dof) AS dof FROM (
  SELECT o, e, dof, CASE WHEN dof = 1 THEN least(0.5, abs(o - e)) ELSE 0 END AS adj FROM (
    SELECT coalesce(c.n, 0) AS o, r.n * k.n / t.n AS e, CAST((rk.n - 1) * (kk.n - 1) AS BIGINT) AS dof
    FROM (SELECT {a} AS a, count(*) AS n FROM {source} GROUP BY 1) r
    CROSS JOIN (SELECT {b} AS b, count(*) AS n FROM {source} GROUP BY 1) k
    CROSS JOIN (SELECT count(*) AS n FROM {source}) t
    CROSS JOIN (SELECT count(DISTINCT {a}) AS n FROM {source}) rk
    CROSS JOIN (SELECT count(DISTINCT {b}) AS n FROM {source}) kk
    LEFT JOIN (SELECT {a} AS a, {b} AS b, count(*) AS n FROM {source} GROUP BY 1, 2) c
      ON c.a = r.a AND c.b = k.b
  )
)
"""


@catalogue.add(
    CHI2.format(name="labels", a="quality", b="toxic", source="labels")
    + " UNION ALL "
    + CHI2.format(name="orders", a="o_orderpriority", b="o_orderstatus", source="orders")
)
def chi2_test(spark: SparkSession, folder: str) -> DataFrame:
    pairs = {"labels": ("quality", "toxic"), "orders": ("o_orderpriority", "o_orderstatus")}
    out = None
    for name, (a, b) in pairs.items():
        test = stats.chi2_test(table(spark, folder, name), a, b)
        row = test.select(F.lit(name).alias("pair"), F.round("stat", 6).alias("stat"), "dof")
        out = row if out is None else out.unionByName(row)
    return out


@catalogue.add(
    "SELECT dof, round(exp(-stat / 2) * (1 + stat / 2 + pow(stat / 2, 2) / 2 + pow(stat / 2, 3) / 6), 5) AS p_value FROM ("
    + CHI2.format(name="orders", a="o_orderpriority", b="o_orderstatus", source="orders") + ")"
)
def chi2_p_value(spark: SparkSession, folder: str) -> DataFrame:
    """Eight degrees of freedom, where the tail has a closed form."""
    test = stats.chi2_test(table(spark, folder, "orders"), "o_orderpriority", "o_orderstatus")
    return test.select("dof", F.round("p_value", 5).alias("p_value"))


@catalogue.add("""
WITH m AS (
  SELECT count(l_extendedprice) FILTER (l_linestatus = 'F') AS n1, count(l_extendedprice) FILTER (l_linestatus = 'O') AS n2,
    avg(l_extendedprice) FILTER (l_linestatus = 'F') AS m1, avg(l_extendedprice) FILTER (l_linestatus = 'O') AS m2,
    var_samp(l_extendedprice) FILTER (l_linestatus = 'F') AS v1, var_samp(l_extendedprice) FILTER (l_linestatus = 'O') AS v2
  FROM lineitem
)
SELECT round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)), 6) AS t,
  CAST(n1 + n2 - 2 AS BIGINT) AS dof FROM m
""")
def t_test(spark: SparkSession, folder: str) -> DataFrame:
    test = stats.t_test(table(spark, folder, "lineitem"), "l_extendedprice", "l_linestatus", "F", "O")
    return test.select(F.round("t", 6).alias("t"), "dof")


@catalogue.add(" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round({f'corr({a}, {b})' if a != b else '1.0::DOUBLE'}, 6) AS corr FROM "
    + ("lineitem" if a != b else "(SELECT 1)")
    for a in NUMBERS for b in NUMBERS
))
def corr_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.corr_matrix(table(spark, folder, "lineitem"), NUMBERS), 6, "corr")


WIDE = [f"x{i}" for i in range(30)]


@catalogue.add("WITH w AS (SELECT " + ", ".join(
    f"CASE WHEN l_orderkey % {i + 3} <> 0 THEN l_quantity * {i + 1} + l_extendedprice / {i + 7} + l_partkey % {i + 2} END AS x{i}" for i in range(30)
) + " FROM lineitem) " + " UNION ALL ".join(
    f"SELECT 'x{a}' AS col_a, 'x{b}' AS col_b, round({f'corr(x{a}, x{b})' if a != b else '1.0::DOUBLE'}, 6) AS corr FROM {'w' if a != b else '(SELECT 1)'}"
    for a in range(30) for b in range(30)
))
def corr_matrix_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Thirty columns with gaps in blocks of eight columns."""
    gappy = [
        F.expr(f"CASE WHEN l_orderkey % {i + 3} <> 0 THEN l_quantity * {i + 1} + l_extendedprice / {i + 7} + l_partkey % {i + 2} END").alias(f"x{i}")
        for i in range(30)
    ]
    return rounded(profile.corr_matrix_wide(table(spark, folder, "lineitem").select(*gappy), WIDE, block=8), 6, "corr")


BOXED = ["l_quantity", "l_extendedprice"]


@catalogue.add(f"""
WITH long AS ({_long(BOXED, 'lineitem')} UNION ALL SELECT 'l_markup', l_extendedprice * l_extendedprice FROM lineitem),
q AS (
  SELECT "column", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
  FROM long GROUP BY 1
), f AS (
  SELECT long."column", v, q1, median, q3,
    v >= q1 - (q3 - q1) * 1.5 AND v <= q3 + (q3 - q1) * 1.5 AS inside
  FROM long JOIN q ON q."column" = long."column"
)
SELECT "column", round(min(v) FILTER (inside), 3) AS whisker_low, round(min(q1), 3) AS q1,
  round(min(median), 3) AS median, round(min(q3), 3) AS q3,
  round(max(v) FILTER (inside), 3) AS whisker_high, count(*) FILTER (NOT inside) AS n_fliers
FROM f GROUP BY "column"
""")
def box_summary(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("l_extendedprice")
    lines = table(spark, folder, "lineitem").select(*BOXED, (price * price).alias("l_markup"))
    found = profile.box_summary(lines, [*BOXED, "l_markup"])
    return rounded(found, 3, "whisker_low", "q1", "median", "q3", "whisker_high")


@catalogue.add("""
WITH m AS (
  SELECT count(value) AS n, stddev_samp(value) * pow(count(value), -0.2) AS h, min(value) AS low, max(value) AS high
  FROM events
), grid AS (
  SELECT CAST(i AS INTEGER) AS grid_id, low - 3 * h + i * ((high + 3 * h - (low - 3 * h)) / 199) AS x, n, h
  FROM m, range(200) r(i)
), weights AS (SELECT value AS v, count(*) AS w FROM events GROUP BY 1)
SELECT grid_id, round(x, 6) AS x, round(sum(w * exp(-0.5 * pow((x - v) / h, 2))) / (n * h * sqrt(2 * pi())), 8) AS density
FROM grid, weights GROUP BY grid_id, x, n, h
""")
def kde_grid(spark: SparkSession, folder: str) -> DataFrame:
    found = profile.kde_grid(table(spark, folder, "events"), "value")
    return found.select("grid_id", F.round("x", 6).alias("x"), F.round("density", 8).alias("density"))


@catalogue.add("""
WITH hashed AS (
  SELECT o_orderstatus, ('0x' || substr(md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR))), 1, 15))::BIGINT AS h
  FROM orders
), ranked AS (
  SELECT o_orderstatus, row_number() OVER (ORDER BY h) AS rn, count(*) OVER () AS n FROM hashed
)
SELECT CASE WHEN rn <= ceil(round(n * 0.2, 9)) THEN 'test' ELSE 'train' END AS split, o_orderstatus, count(*) AS count
FROM ranked GROUP BY 1, 2
""")
def class_distribution(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return distribution(split_train_test(orders, "o_orderkey"), "o_orderstatus", "split")
