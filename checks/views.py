"""Fixture views over the driver's tables, as SQL text that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabstride.operators.net import NetWeights

FEATURES = [f"f{i}" for i in range(1, 8)]

_ACTIVITIES = """
SELECT concat(cast(l_orderkey AS string),'-',cast(l_partkey AS string),'-',
              cast(l_suppkey AS string),'-',cast(l_linenumber AS string)) AS id,
       concat('P',cast(l_partkey AS string)) AS compound_id,
       l_suppkey AS target_id, l_linestatus AS standard_type,
       CASE WHEN l_returnflag='R' THEN '>'
            WHEN l_returnflag='N' AND l_linenumber=7 THEN NULL ELSE '=' END AS standard_relation,
       CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE o_totalprice/300 END AS standard_value,
       CASE WHEN l_orderkey % 23 = 0 THEN 'n/a'
            ELSE cast(cast(l_quantity AS int) AS string) END AS raw_value,
       year(o_orderdate) AS document_year, o_orderpriority AS document_journal,
       l_extendedprice AS f1, p_retailprice AS f2, {f3} AS f3,
       cast(l_linenumber AS double) AS f4, cast(p_size AS double) AS f5,
       l_discount AS f6, s_acctbal AS f7, l_partkey AS pk, l_suppkey AS sk
FROM {lineitem} JOIN {orders} ON o_orderkey=l_orderkey
                JOIN {part} ON p_partkey=l_partkey
                JOIN {supplier} ON s_suppkey=l_suppkey
"""
_F3_FULL = "l_quantity"
_F3_GAPS = "CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE l_quantity END"
_SCORED = """
SELECT id, label, ((label*20 + (pk*7+sk*13) % 81)/cast(100 AS double)) AS prob
FROM (SELECT id, pk, sk, CASE WHEN standard_value<1000 THEN 1 ELSE 0 END AS label FROM {v1}) b
"""
_STAR = ("lineitem", "orders", "part", "supplier")
_NAMES = {t: t for t in _STAR}

V1 = _ACTIVITIES.format(f3=_F3_FULL, **_NAMES)
V2 = _ACTIVITIES.format(f3=_F3_GAPS, **_NAMES)


def with_v1(sql: str) -> str:
    return f"WITH v1 AS ({V1})\n{sql}"


def with_v2(sql: str) -> str:
    return f"WITH v1 AS ({V1}), v2 AS ({V2})\n{sql}"


def with_v3(sql: str) -> str:
    """``v3`` has ``id, label, prob`` and ``prediction`` (prob at or above one half)."""
    v3 = _SCORED.format(v1="v1")
    return (
        f"WITH v1 AS ({V1}), v3 AS (SELECT *, CASE WHEN prob >= 0.5 THEN 1 ELSE 0 END "
        f"AS prediction FROM ({v3}) s)\n{sql}"
    )


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def activities(spark: SparkSession, sf: str) -> DataFrame:
    """V1: raw and featurised activity rows."""
    tables = {t: table(spark, sf, t) for t in _STAR}
    return spark.sql(_ACTIVITIES.replace("{f3}", _F3_FULL), **tables)


def activities_with_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """V2: V1 with missing values in ``f3``."""
    tables = {t: table(spark, sf, t) for t in _STAR}
    return spark.sql(_ACTIVITIES.replace("{f3}", _F3_GAPS), **tables)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """V3: labels with probabilities that tie and touch the grid points."""
    rows = spark.sql(_SCORED, v1=activities(spark, sf))
    return rows.withColumn("prediction", F.when(F.col("prob") >= 0.5, 1).otherwise(0))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """All documents, and one more row with an invalid (null) text for every thirteenth."""
    rows = table(spark, sf, "documents").select("doc_id", "lang", "text")
    invalid = rows.filter(F.col("doc_id") % 13 == 0).withColumn("text", F.lit(None).cast("string"))
    return rows.unionByName(invalid)


def json_pages(spark: SparkSession, sf: str) -> DataFrame:
    """V5: all events as JSON pages, then a page without records, then every page again.

    What follows the empty page must not be read.
    """
    record = F.struct("event_id", "user_id", "event_type", "value", "props")
    body = F.to_json(F.struct(F.collect_list(record).alias("activities")))
    start = F.floor(F.col("event_id") / 1000) * 1000
    pages = table(spark, sf, "events").groupBy(start.alias("offset")).agg(body.alias("body"))
    last = pages.agg((F.max("offset") + 1000).alias("end"))
    empty = last.select(F.col("end").alias("offset"), F.lit('{"page_meta":{}}').alias("body"))
    again = pages.crossJoin(F.broadcast(last)).select(
        (F.col("offset") + F.col("end") + 1000).alias("offset"), "body"
    )
    return pages.unionByName(empty).unionByName(again)


EVENT_RECORD = "event_id bigint, user_id bigint, event_type string, value double, props string"

# Fixed-weights net: the same rule in every layer.
NET = NetWeights.from_rule(
    [7, 32, 16, 1],
    w=lambda layer, o, i: ((o * 7 + i * 3) % 11 - 5) / 10,
    b=lambda layer, o: ((o * 5) % 7 - 3) / 10,
)
# Divisors that bring f1..f7 near one.
NET_SCALES = [100000.0, 1000.0, 50.0, 7.0, 50.0, 0.1, 10000.0]


def net_inputs(df: DataFrame) -> DataFrame:
    return df.select(
        "id",
        F.when(F.col("standard_value") < 1000, 1).otherwise(0).alias("label"),
        *[(F.col(f) / s).alias(f) for f, s in zip(FEATURES, NET_SCALES)],
    )


def net_logit_sql(inputs: str) -> str:
    """DuckDB query that adds ``z``, the net's logit, to rows with a list column ``x``."""
    unit = "cast((o*7+i*3)%11-5 AS double)/10"
    bias = "cast((o*5)%7-3 AS double)/10"

    def layer(source: str, fan_in: int, fan_out: int) -> str:
        dot = f"list_sum(list_transform(range({fan_in}), lambda i: {source}[i+1]*({unit})))"
        return f"list_transform(range({fan_out}), lambda o: {dot} + {bias})"

    relu = "list_transform({0}, lambda v: greatest(v, 0.0::double))"
    return f"""
SELECT * EXCLUDE (x, h1, h2), {layer('h2', 16, 1)}[1] AS z FROM (
  SELECT *, {relu.format(layer('h1', 32, 16))} AS h2 FROM (
    SELECT *, {relu.format(layer('x', 7, 32))} AS h1 FROM ({inputs}) n0) n1) n2"""


NET_INPUT_SQL = """
SELECT id, CASE WHEN standard_value < 1000 THEN 1 ELSE 0 END AS label,
       [f1/100000.0::double, f2/1000.0::double, f3/50.0::double, f4/7.0::double,
        f5/50.0::double, f6/0.1::double, f7/10000.0::double] AS x
FROM v1"""


def rounded(df: DataFrame, digits: int = 6, *cols: str) -> DataFrame:
    """Double columns (or the named ones) rounded for comparison."""
    chosen = cols or [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, digits) for c in chosen})
