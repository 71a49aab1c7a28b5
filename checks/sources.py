"""Checks of sources and sinks."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.views import (
    EVENT_RECORD,
    FEATURES,
    activities,
    json_pages,
    rounded,
    scored,
    table,
    with_v1,
    with_v3,
)
from tabstride.operators.metrics import binary_metrics
from tabstride.operators.scaling import fit_scaler
from tabstride.plans import prepare
from tabstride.session import scratch_path
from tabstride.sources.artefacts import load_scaler, log_metrics_table, read_runs, save_scaler
from tabstride.sources.pages import filter_activities, ingest_pages, union_pages
from tabstride.sources.tables import scan_csv, scan_prepared, write_csv, write_prepared

EVENT_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double, props string"


def scan_csv_declared(spark, sf):
    path = scratch_path(spark, "events.csv")
    write_csv(table(spark, sf, "events").drop("ts"), path)
    return scan_csv(spark, path, EVENT_SCHEMA)


def scan_csv_inferred(spark, sf):
    """Types found from the text, with null tokens among the numbers."""
    path = scratch_path(spark, "activities.csv")
    rows = activities(spark, sf).select(
        "id", "target_id", "standard_relation", "standard_value", "raw_value", "f6"
    )
    write_csv(rows, path)
    back = scan_csv(spark, path)
    return back.withColumn("raw_value", F.coalesce("raw_value", F.lit(-1).cast("bigint")))


def scan_csv_multi_line(spark, sf):
    path = scratch_path(spark, "documents.csv")
    write_csv(table(spark, sf, "documents").select("doc_id", "text", "lang"), path)
    return scan_csv(spark, path, "doc_id bigint, text string, lang string", multi_line=True)


def write_csv_round_trip(spark, sf):
    """Timestamps keep their microseconds."""
    path = scratch_path(spark, "events.csv")
    write_csv(table(spark, sf, "events").select("event_id", "ts", "value", "props"), path)
    kind = dict(table(spark, sf, "events").dtypes)["ts"]
    back = scan_csv(spark, path, f"event_id bigint, ts {kind}, value double, props string")
    return back.select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"),
                       "value", "props")


def _prepared(spark, sf):
    path = scratch_path(spark, "prepared")
    n = write_prepared(prepare(activities(spark, sf), feats=FEATURES), path)
    return path, n


def scan_prepared_table(spark, sf):
    path, _ = _prepared(spark, sf)
    values = vector_to_array("features")
    return rounded(
        scan_prepared(spark, path).select(
            "id", "label", *[values[i].alias(f) for i, f in enumerate(FEATURES)]
        )
    )


def write_prepared_count(spark, sf):
    """Rows reported by the write beside the rows read back."""
    path, n = _prepared(spark, sf)
    return scan_prepared(spark, path).agg(F.count(F.lit(1)).alias("n_read")).withColumn(
        "n_written", F.lit(n).cast("bigint")
    )


def union_two_pages(spark, sf):
    events = table(spark, sf, "events")
    return union_pages(
        [events.select("event_id", "event_type", "value"), events.select("props", "event_id")]
    )


def save_load_scaler(spark, sf):
    path = scratch_path(spark, "scaler")
    save_scaler(spark, fit_scaler(activities(spark, sf), FEATURES, ddof=0), path)
    return rounded(load_scaler(spark, path).to_df(spark), 4)


def logged_metrics(spark, sf):
    path = scratch_path(spark, "runs")
    rows = scored(spark, sf)
    for run, t in (("half", 0.5), ("forest", 0.38)):
        log_metrics_table(binary_metrics(rows, t), path, run)
    return read_runs(spark, path).select(
        "run_id", "kind", "key", F.round(F.col("value").cast("double"), 6).alias("value")
    )


# Adding zero turns a rounded -0.0 into 0.0, as Spark rounds it.
SCALED_SQL = ", ".join(
    f"round(({f}-m_{f})/s_{f}, 6) + 0.0::double AS {f}" for f in FEATURES
)
STATS_SQL = ", ".join(f"avg({f}) AS m_{f}, stddev_samp({f}) AS s_{f}" for f in FEATURES)
PREPARED_SQL = with_v1(f"""
SELECT id, CASE WHEN standard_value < 1000 THEN 1 ELSE 0 END AS label, {SCALED_SQL}
FROM v1 CROSS JOIN (SELECT {STATS_SQL} FROM v1) s""")
EVENTS_SQL = "SELECT event_id, user_id, event_type, value, props FROM events"
SCALER_SQL = with_v1(" UNION ALL ".join(
    f"SELECT {i} AS position, '{f}' AS feature, round(avg({f}),4) AS mean, "
    f"round(stddev_pop({f}),4) AS std FROM v1"
    for i, f in enumerate(FEATURES)
))


def _run_sql(run: str, t: str) -> str:
    counts = f"""SELECT count(*) FILTER (prob >= {t} AND label=1) AS tp,
  count(*) FILTER (prob >= {t} AND label=0) AS fp,
  count(*) FILTER (prob < {t} AND label=1) AS fn,
  count(*) FILTER (prob < {t} AND label=0) AS tn FROM v3"""
    parts = {
        "accuracy": "(tp+tn)/(tp+fp+fn+tn)",
        "precision": "tp/(tp+fp)",
        "recall": "tp/(tp+fn)",
        "f1": "2*tp/(2*tp+fp+fn)",
    }
    return " UNION ALL ".join(
        f"SELECT '{run}' AS run_id, 'metric' AS kind, '{k}' AS key, round({e}, 6) AS value "
        f"FROM ({counts}) c"
        for k, e in parts.items()
    )


QUERIES = {
    "scan_csv": scan_csv_declared,
    "scan_csv_inferred": scan_csv_inferred,
    "scan_csv_multi_line": scan_csv_multi_line,
    "scan_prepared": scan_prepared_table,
    "ingest_pages": lambda spark, sf: ingest_pages(json_pages(spark, sf), EVENT_RECORD),
    "ingest_pages_inferred": lambda spark, sf: ingest_pages(json_pages(spark, sf)),
    "filter_activities": lambda spark, sf: filter_activities(
        activities(spark, sf), 7, "F", target_col="target_id"
    ).select("id", "target_id", "standard_type"),
    "write_csv": write_csv_round_trip,
    "write_prepared": write_prepared_count,
    "save_load_scaler": save_load_scaler,
    "log_run": logged_metrics,
    "union_pages": union_two_pages,
}

ORACLES = {
    "scan_csv": EVENTS_SQL,
    "scan_csv_inferred": with_v1(
        "SELECT id, target_id, standard_relation, standard_value, "
        "coalesce(try_cast(raw_value AS bigint), -1) AS raw_value, f6 FROM v1"
    ),
    "scan_csv_multi_line": "SELECT doc_id, text, lang FROM documents",
    "scan_prepared": PREPARED_SQL,
    "ingest_pages": EVENTS_SQL,
    "ingest_pages_inferred": EVENTS_SQL,
    "filter_activities": with_v1(
        "SELECT id, target_id, standard_type FROM v1 WHERE target_id=7 AND standard_type='F'"
    ),
    "write_csv": "SELECT event_id, epoch_us(ts) AS micros, value, props FROM events",
    "write_prepared": with_v1("SELECT count(*) AS n_read, count(*) AS n_written FROM v1"),
    "save_load_scaler": SCALER_SQL,
    "log_run": with_v3(_run_sql("half", "0.5") + " UNION ALL " + _run_sql("forest", "0.38")),
    "union_pages": """SELECT event_id, event_type, value, NULL AS props FROM events
UNION ALL SELECT event_id, NULL, NULL, props FROM events""",
}
