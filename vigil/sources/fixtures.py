"""Adapters that give the driver's parquet tables the roles the library works on.

Each Spark builder has a DuckDB twin (``*_SQL``) used as a CTE by the oracle
queries, so both sides derive exactly the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# Reference / current cut of the drift pair, in seconds of `Time`.
DRIFT_CUT_SECONDS = 1200 * 86400
# Feature columns of the transactions role.
TXN_FEATURES = ["Time", "Amount", "V1", "V2", "V3"]
LABEL = "Class"
KEY = "txn_id"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _days() -> Column:
    return F.expr("datediff(l_shipdate, timestamp_ntz'1995-01-01 00:00:00')")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled card-transaction role derived from ``lineitem``.

    Columns: txn_id (md5 hex, unique), Time, Amount, V1, V2, V3 (double),
    Class (int 0/1), score (double in [0, 1], heavily tied).
    """
    li = table(spark, sf_dir, "lineitem")
    days = _days()
    return li.select(
        F.md5(F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                          F.col("l_quantity").cast("int"), days)).alias("txn_id"),
        (days.cast("double") * F.lit(86400.0)).alias("Time"),
        F.col("l_extendedprice").alias("Amount"),
        F.col("l_discount").alias("V1"),
        F.col("l_tax").alias("V2"),
        F.col("l_quantity").alias("V3"),
        ((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 50)).cast("int").alias("Class"),
        F.round(F.expr("0.6D * (l_quantity / 50D) + 0.4D * (l_discount / 0.1D)"), 6).alias("score"),
    )


def drift_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Reference = transactions before the cut, current = the rest."""
    t = transactions(spark, sf_dir).drop("score")
    return t.where(F.col("Time") < DRIFT_CUT_SECONDS), t.where(F.col("Time") >= DRIFT_CUT_SECONDS)


# --- DuckDB twins --------------------------------------------------------

TXN_SQL = """
transactions AS (
  SELECT md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                       CAST(l_quantity AS INTEGER),
                       date_diff('day', TIMESTAMP '1995-01-01', l_shipdate))) AS txn_id,
         CAST(date_diff('day', TIMESTAMP '1995-01-01', l_shipdate) AS DOUBLE) * 86400 AS "Time",
         l_extendedprice AS "Amount",
         l_discount AS "V1",
         l_tax AS "V2",
         l_quantity AS "V3",
         CAST(l_returnflag = 'R' AND l_quantity >= 50 AS INTEGER) AS "Class",
         round(0.6 * (l_quantity / 50) + 0.4 * (l_discount / 0.1), 6) AS score
  FROM lineitem
)"""

DRIFT_SQL = TXN_SQL + f""",
ref AS (SELECT * FROM transactions WHERE "Time" < {DRIFT_CUT_SECONDS}),
cur AS (SELECT * FROM transactions WHERE "Time" >= {DRIFT_CUT_SECONDS}),
ref_long AS (
  SELECT feature, value FROM (UNPIVOT ref ON "Time", "Amount", "V1", "V2", "V3" INTO NAME feature VALUE value)
  WHERE value IS NOT NULL AND NOT isnan(value) AND abs(value) < 'inf'::DOUBLE),
cur_long AS (
  SELECT feature, value FROM (UNPIVOT cur ON "Time", "Amount", "V1", "V2", "V3" INTO NAME feature VALUE value)
  WHERE value IS NOT NULL AND NOT isnan(value) AND abs(value) < 'inf'::DOUBLE)"""


# Deterministic faults by the first two hex digits of md5(txn_id:'dirty').
DIRTY_FAULTS = {
    "Amount": [("00", None), ("01", "'x'"), ("02", "'3f'"), ("03", "'nan'"), ("04", "NEG")],
    "Time": [("05", None), ("06", "'x'"), ("07", "NEG")],
    "Class": [("08", "'2'"), ("09", None), ("0a", "'abc'"), ("0b", "'1.5'")],
    "V1": [("0c", None), ("0d", "'nan'")],
}


def _dirty_case(col: str, text: str, dialect: str) -> str:
    h = "_h" if dialect == "spark" else "substring(md5(concat_ws(':', txn_id, 'dirty')), 1, 2)"
    parts = []
    for code, val in DIRTY_FAULTS.get(col, []):
        if val is None:
            v = "NULL"
        elif val == "NEG":
            v = f"concat('-', {text})"
        else:
            v = val
        parts.append(f"WHEN {h} = '{code}' THEN {v}")
    if not parts:
        return f"{text} AS \"{col}\"" if dialect == "duckdb" else f"{text} AS `{col}`"
    q = f"\"{col}\"" if dialect == "duckdb" else f"`{col}`"
    return f"CASE {' '.join(parts)} ELSE {text} END AS {q}"


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with every column as text and deterministic faults:
    NULLs, 'x', '3f', 'nan', negative amounts/times, labels 2, 'abc', '1.5'."""
    t = (transactions(spark, sf_dir).drop("score")
         .withColumn("_h", F.expr("substring(md5(concat_ws(':', txn_id, 'dirty')), 1, 2)")))
    out = [F.col("txn_id")]
    for c in ["Time", "Amount", "V1", "V2", "V3", "Class"]:
        text = F.col(c).cast("string")
        faults = DIRTY_FAULTS.get(c, [])
        if not faults:
            out.append(text.alias(c))
            continue
        variants = [F.concat(F.lit("-"), text) if v == "NEG" else
                    (F.lit(None).cast("string") if v is None else F.lit(v.strip("'"))) for _, v in faults]
        # One lookup of the hash prefix per column: position 0 keeps the value.
        pos = F.array_position(F.array(*[F.lit(code) for code, _ in faults]), F.col("_h"))
        out.append(F.element_at(F.array(text, *variants), (pos + 1).cast("int")).alias(c))
    return t.select(*out)


DIRTY_SQL = TXN_SQL + """,
dirty AS (SELECT txn_id, """ + ",\n    ".join(
    _dirty_case(c, f"CAST(\"{c}\" AS VARCHAR)", "duckdb") for c in ["Time", "Amount", "V1", "V2", "V3", "Class"]
) + """ FROM transactions)"""


# --- run and asset tables ------------------------------------------------------

# Spellings a sweep may record as its primary metric (chosen by l_suppkey % 8).
PRIMARY_METRIC_SPELLINGS = ["auc", "AUC", "roc_auc", "metrics.AUC_macro", "average_precision",
                            "Accuracy", "log_loss", "f1"]


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per supplier: run_id, experiment_name, status, primary_metric."""
    li = table(spark, sf_dir, "lineitem")
    s = li.select("l_suppkey").distinct()
    k = F.col("l_suppkey")
    spell = F.element_at(F.array(*[F.lit(x) for x in PRIMARY_METRIC_SPELLINGS]), (k % 8 + 1).cast("int"))
    return s.select(
        F.concat(F.lit("run-"), k.cast("string")).alias("run_id"),
        F.when(k % 3 == 0, "custom_train").when(k % 3 == 1, "automl_train").otherwise("scratch").alias("experiment_name"),
        F.when(k % 7 == 0, "FAILED").otherwise("FINISHED").alias("status"),
        spell.alias("primary_metric"))


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long run metrics (run_id, key, value) from per-supplier averages;
    AUC_macro is missing for every 11th supplier."""
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy("l_suppkey").agg(F.avg("l_discount").alias("d"), F.avg("l_tax").alias("t"),
                                   F.avg("l_quantity").alias("q"))
    k = F.col("l_suppkey")
    rid = F.concat(F.lit("run-"), k.cast("string"))
    auc = F.when(k % 11 != 0, F.round(F.lit(0.5) + F.col("d") * 4, 6))
    arr = F.array(F.struct(F.lit("AUC_macro").alias("key"), auc.alias("value")),
                  F.struct(F.lit("accuracy").alias("key"), F.round(1 - F.col("t"), 6).alias("value")),
                  F.struct(F.lit("log_loss").alias("key"), F.round(F.col("q") / 50, 6).alias("value")))
    return g.select(rid.alias("run_id"), F.inline(arr)).where(F.col("value").isNotNull())


def model_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asset catalogue from ``part``: name = brand, version text
    ``p_size.(p_partkey % 10)`` or, for every 13th part, a non-numeric text;
    tags carry the run that produced it under one of three tag keys."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    version = F.when(k % 13 == 0, F.concat(F.lit("v"), F.col("p_size").cast("string"))).otherwise(
        F.concat(F.col("p_size").cast("string"), F.lit("."), (k % 10).cast("string")))
    run = F.concat(F.lit("run-"), (k % 97).cast("string"))
    tag_key = F.element_at(F.array(F.lit("run_id"), F.lit("mlflow_run_id"), F.lit("best_run_id"), F.lit("note")),
                           (k % 4 + 1).cast("int"))
    return p.select(F.col("p_brand").alias("name"), version.alias("version"), k.alias("asset_id"),
                    F.create_map(tag_key, run, F.lit("dataset_version"),
                                 F.concat(F.lit("d"), (k % 5).cast("string"))).alias("tags"),
                    F.concat(F.lit("/assets/"), F.col("p_brand"), F.lit("/"), version).alias("path"))


RUNS_SQL = """
runs AS (
  SELECT 'run-' || CAST(l_suppkey AS VARCHAR) AS run_id,
         CASE WHEN l_suppkey % 3 = 0 THEN 'custom_train' WHEN l_suppkey % 3 = 1 THEN 'automl_train' ELSE 'scratch' END
           AS experiment_name,
         CASE WHEN l_suppkey % 7 = 0 THEN 'FAILED' ELSE 'FINISHED' END AS status,
         ['""" + "', '".join(PRIMARY_METRIC_SPELLINGS) + """'][l_suppkey % 8 + 1] AS primary_metric
  FROM (SELECT DISTINCT l_suppkey FROM lineitem)),
run_agg AS (
  SELECT 'run-' || CAST(l_suppkey AS VARCHAR) AS run_id,
         CASE WHEN l_suppkey % 11 <> 0 THEN round(0.5 + avg(l_discount) * 4, 6) END AS auc,
         round(1 - avg(l_tax), 6) AS acc, round(avg(l_quantity) / 50, 6) AS ll
  FROM lineitem GROUP BY l_suppkey),
run_metrics AS (
  SELECT run_id, 'AUC_macro' AS key, auc AS value FROM run_agg WHERE auc IS NOT NULL
  UNION ALL SELECT run_id, 'accuracy', acc FROM run_agg
  UNION ALL SELECT run_id, 'log_loss', ll FROM run_agg)"""

ASSETS_SQL = """
assets AS (
  SELECT p_brand AS name, p_partkey AS asset_id,
         CASE WHEN p_partkey % 13 = 0 THEN 'v' || CAST(p_size AS VARCHAR)
              ELSE CAST(p_size AS VARCHAR) || '.' || CAST(p_partkey % 10 AS VARCHAR) END AS version,
         ['run_id', 'mlflow_run_id', 'best_run_id', 'note'][p_partkey % 4 + 1] AS tag_key,
         'run-' || CAST(p_partkey % 97 AS VARCHAR) AS tag_run,
         'd' || CAST(p_partkey % 5 AS VARCHAR) AS dataset_version
  FROM part)"""


# --- request / response logs -------------------------------------------------------

REQUEST_COLUMNS = ["row_id", "Amount", "V1", "V2", "V3"]
# Request-id key written by a client, chosen by o_orderkey % 5 (4 = none).
REQUEST_ID_SPELLINGS = ["request_id", "requestId", "correlation_id", "correlationId"]


def request_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scoring request per order: its line items as records, in one of six
    payload shapes chosen by ``o_orderkey % 6``; columns (request_key, payload)."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("request_key"))
    rows = li.groupBy(F.col("l_orderkey").alias("request_key")).agg(F.array_sort(F.collect_list(F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_quantity"))).alias("rows"))
    j = o.join(rows, "request_key")
    k = F.col("request_key")
    data = F.transform("rows", lambda r: F.array(r["l_linenumber"].cast("double"), r["l_extendedprice"],
                                                  r["l_discount"], r["l_tax"], r["l_quantity"]))
    dicts = F.transform("rows", lambda r: F.struct(
        r["l_linenumber"].cast("double").alias("row_id"), r["l_extendedprice"].alias("Amount"),
        r["l_discount"].alias("V1"), r["l_tax"].alias("V2"), r["l_quantity"].alias("V3")))
    cols = F.array(*[F.lit(c) for c in REQUEST_COLUMNS])
    def field(c):
        return lambda d: d[c]
    lists = F.struct(*[F.transform(dicts, field(c)).alias(c) for c in REQUEST_COLUMNS])
    # a dict of scalars holds one record, so orders with more lines are sent as a list
    shape = F.when((k % 6 == 3) & (F.size(dicts) > 1), F.lit(5)).otherwise(k % 6)
    body = (F.when(shape == 0, F.to_json(F.struct(
                F.struct(cols.alias("columns"), data.alias("data"), F.lit(3).alias("max_alerts")).alias("input_data"),
                (k % 3).alias("max_alerts"))))
            .when(shape == 1, F.to_json(F.struct(cols.alias("columns"), data.alias("data"), (k % 4).alias("max_alerts"))))
            .when(shape == 2, F.to_json(F.struct(dicts.alias("data"), F.lit(2).alias("alert_cap"))))
            .when(shape == 3, F.to_json(F.element_at(dicts, 1)))
            .when(shape == 4, F.to_json(lists))
            .otherwise(F.to_json(dicts)))
    id_key = F.element_at(F.array(*[F.lit(x) for x in REQUEST_ID_SPELLINGS]), (k % 5 + 1).cast("int"))
    with_id = F.concat(F.lit('{"'), id_key, F.lit('":"req-'), k.cast("string"), F.lit('",'), F.expr("substring(_b, 2)"))
    return j.select("request_key", body.alias("_b")).select(
        "request_key", F.when((k % 6 <= 2) & (k % 5 < 4), with_id).otherwise(F.col("_b")).alias("payload"))
