"""Checks of table profiling."""

from __future__ import annotations

from checks.views import (
    FEATURES,
    activities,
    activities_with_gaps,
    rounded,
    with_v1,
    with_v2,
    with_v3,
)
from tabstride.operators import profile as P
from tabstride.operators.columns import label_threshold
from tabstride.operators.quantiles import median_stats
from tabstride.plans import profile_report

NUMBERS = ["standard_value", *FEATURES]


def boxes(spark, sf):
    rows = label_threshold(activities_with_gaps(spark, sf)).select("active", *FEATURES)
    return rounded(P.box_stats(rows, FEATURES, "active"), 4)


def report(part):
    """One table of the composed profile."""

    def run(spark, sf):
        rows = label_threshold(activities_with_gaps(spark, sf))
        tables = profile_report(rows, NUMBERS, ["document_journal"], "compound_id", "active")
        return tables[part]()

    return run


QUERIES = {
    "row_count": lambda spark, sf: P.row_count(activities(spark, sf)),
    "null_counts": lambda spark, sf: P.null_counts(activities_with_gaps(spark, sf)),
    "schema_profile": lambda spark, sf: P.schema_profile(
        activities_with_gaps(spark, sf).select("id", "target_id", "standard_value", "f3")
    ),
    "describe_numeric": lambda spark, sf: rounded(
        P.describe_numeric(activities_with_gaps(spark, sf), NUMBERS), 4
    ),
    "describe_string": lambda spark, sf: P.describe_string(activities(spark, sf), "compound_id"),
    "value_counts": lambda spark, sf: P.value_counts(activities(spark, sf), "compound_id"),
    "value_counts_relation": lambda spark, sf: P.value_counts(
        activities(spark, sf), "standard_relation"
    ),
    "count_distinct": lambda spark, sf: P.count_distinct(activities(spark, sf), "compound_id"),
    "count_by_year": lambda spark, sf: P.count_by_year(activities(spark, sf)),
    "year_span": lambda spark, sf: P.year_span(activities(spark, sf)),
    "share_by_category": lambda spark, sf: rounded(
        P.share_by_category(activities(spark, sf), "document_journal")
    ),
    "class_balance": lambda spark, sf: rounded(
        P.share_by_category(label_threshold(activities(spark, sf)), "active")
    ),
    "corr_matrix": lambda spark, sf: rounded(
        P.corr_matrix(activities_with_gaps(spark, sf), [*FEATURES, "f7", "standard_value"]), 4
    ),
    "histogram": lambda spark, sf: rounded(
        P.histogram(activities(spark, sf), "standard_value", 200), 3
    ),
    "histogram_auto": lambda spark, sf: rounded(P.histogram(activities(spark, sf), "f1"), 3),
    "box_stats": boxes,
    "median_stats": lambda spark, sf: rounded(
        median_stats(activities_with_gaps(spark, sf), NUMBERS)
    ),
    "profile_report_describe": lambda spark, sf: rounded(report("describe")(spark, sf), 4),
    "profile_report_histogram": lambda spark, sf: rounded(report("histogram.f3")(spark, sf), 3),
    "profile_report_share": lambda spark, sf: rounded(report("share.document_journal")(spark, sf)),
}

_V2_COLUMNS = (
    "id compound_id target_id standard_type standard_relation standard_value raw_value "
    "document_year document_journal f1 f2 f3 f4 f5 f6 f7 pk sk"
).split()


def _each(columns, select: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {select.format(c=c)} FROM {source}" for c in columns
    )


def _describe_sql(digits: int) -> str:
    parts = {
        "mean": "avg({c})",
        "std": "stddev_samp({c})",
        "min": "min({c})",
        "q25": "quantile_cont({c}, 0.25)",
        "q50": "quantile_cont({c}, 0.5)",
        "q75": "quantile_cont({c}, 0.75)",
        "max": "max({c})",
    }
    columns = ", ".join(f"round({e}, {digits}) AS {n}" for n, e in parts.items())
    return with_v2(_each(NUMBERS, 'count({c}) AS "count", ' + columns, "v2"))


def _histogram_sql(c: str, bins: str, source: str, kind: str, least: int) -> str:
    """Equal-width bins; ``bins`` is a number or an expression over n, lo, hi, q1, q3."""
    return f"""
SELECT b.bin::{kind} AS bin, round(lo + b.bin*w, 3) AS bin_start,
       round(lo + (b.bin+1)*w, 3) AS bin_end, coalesce(n, 0) AS n
FROM (SELECT unnest(range(bins)) AS bin, lo, w FROM e) b
LEFT JOIN (SELECT least(floor(({c}-lo)/w), bins-1)::bigint AS bin, count(*) AS n
           FROM {source}, e WHERE {c} IS NOT NULL GROUP BY 1) f ON f.bin = b.bin
WHERE coalesce(n, 0) >= {least}
""", f"""e AS (SELECT lo, hi, bins, (hi-lo)/bins AS w FROM (
  SELECT lo, hi, ({bins})::bigint AS bins FROM (
    SELECT min({c}) AS lo, max({c}) AS hi, count({c}) AS n,
           quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {source}) s) t)"""


AUTO_BINS = "ceil((hi-lo)/least((hi-lo)/(log2(n)+1), 2*(q3-q1)/pow(n, 1.0/3)))"


def _histogram(c: str, bins: str, prefix) -> str:
    source = "v1" if prefix is with_v1 else "v2"
    kind, least = ("bigint", 1) if bins == AUTO_BINS else ("int", 0)
    body, extent = _histogram_sql(c, bins, source, kind, least)
    head = prefix("").rstrip()
    return f"{head}, {extent}\n{body}"


def _values(c: str, source: str = "v1") -> str:
    return with_v1(
        f"SELECT {c}, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY 1"
    )


_SHARE = (
    "SELECT {c}, count(*) AS n, round(count(*)/(SELECT count(*) FROM {t}), 6) AS share "
    "FROM {t} GROUP BY 1"
)
_SCHEMA = [("id", "string"), ("target_id", "bigint"), ("standard_value", "double"), ("f3", "double")]
_PAIRS = [(a, b) for a in NUMBERS for b in NUMBERS]

ORACLES = {
    "row_count": with_v1("SELECT count(*) AS n_rows FROM v1"),
    "null_counts": with_v2(_each(_V2_COLUMNS, "count(*) - count({c}) AS n_missing", "v2")),
    "schema_profile": with_v2(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {i} AS position, '{t}' AS type, count({c}) AS n_present FROM v2"
        for i, (c, t) in enumerate(_SCHEMA)
    )),
    "describe_numeric": _describe_sql(4),
    "describe_string": with_v1("""
SELECT sum(n)::bigint AS "count", count(*) AS "unique", arg_max(compound_id, n) AS top, max(n) AS freq
FROM (SELECT compound_id, count(*) AS n FROM v1 GROUP BY 1 ORDER BY n DESC, compound_id) g"""),
    "value_counts": _values("compound_id"),
    "value_counts_relation": _values("standard_relation"),
    "count_distinct": with_v1("SELECT count(DISTINCT compound_id) AS n_distinct FROM v1"),
    "count_by_year": with_v1("SELECT document_year::int AS document_year, count(*) AS n FROM v1 GROUP BY 1"),
    "year_span": with_v1("""
SELECT min(document_year)::int AS first_year, max(document_year)::int AS last_year,
       (SELECT document_year::int FROM v1 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS peak_year
FROM v1"""),
    "share_by_category": with_v1(_SHARE.format(c="document_journal", t="v1")),
    "class_balance": with_v3(_SHARE.format(c="label", t="v3")).replace(
        "SELECT label, count(*)", "SELECT label AS active, count(*)"
    ),
    "corr_matrix": with_v2(" UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(r{i}, 4) + 0.0::double AS r FROM c"
        for i, (a, b) in enumerate(_PAIRS)
    )).replace("\nSELECT 'standard_value' AS a", ", c AS (SELECT " + ", ".join(
        f"corr({a}, {b}) AS r{i}" for i, (a, b) in enumerate(_PAIRS)
    ) + " FROM v2)\nSELECT 'standard_value' AS a", 1),
    "histogram": _histogram("standard_value", "200", with_v1),
    "histogram_auto": _histogram("f1", AUTO_BINS, with_v1),
    "box_stats": with_v2("""
SELECT active, "column", count(*) AS n, round(q1, 4) AS q1, round(median, 4) AS median,
       round(q3, 4) AS q3,
       round(least(min(v) FILTER (v BETWEEN lo AND hi), q1), 4) AS whisker_lo,
       round(greatest(max(v) FILTER (v BETWEEN lo AND hi), q3), 4) AS whisker_hi,
       count(*) FILTER (v NOT BETWEEN lo AND hi) AS n_outliers
FROM long JOIN (SELECT active AS a, "column" AS c, quantile_cont(v, 0.25) AS q1,
                       quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3,
                       quantile_cont(v, 0.25)*2.5 - quantile_cont(v, 0.75)*1.5 AS lo,
                       quantile_cont(v, 0.75)*2.5 - quantile_cont(v, 0.25)*1.5 AS hi
                FROM long GROUP BY 1, 2) s ON a = active AND c = "column"
GROUP BY active, "column", q1, median, q3""").replace(
        "\nSELECT active", ", long AS (" + " UNION ALL ".join(
            "SELECT CASE WHEN standard_value < 1000 THEN 1 ELSE 0 END AS active, "
            f"'{f}' AS \"column\", {f} AS v FROM v2 WHERE {f} IS NOT NULL" for f in FEATURES
        ) + ")\nSELECT active", 1),
    "median_stats": with_v2(_each(NUMBERS, "round(quantile_cont({c}, 0.5), 6) AS median", "v2")),
    "profile_report_describe": _describe_sql(4),
    "profile_report_histogram": _histogram("f3", AUTO_BINS, with_v2),
    "profile_report_share": with_v1(_SHARE.format(c="document_journal", t="v1")),
}
