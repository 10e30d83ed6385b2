"""DuckDB oracle SQL for every registered query (same column names)."""

from __future__ import annotations

from vigil.sources.fixtures import DRIFT_SQL, TXN_SQL  # noqa: F401

ORACLE: dict[str, str] = {}

_PROBS10 = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]"

_PSI_CTE = DRIFT_SQL + f""",
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, {_PROBS10}))) AS e
          FROM ref_long GROUP BY feature),
sided AS (SELECT feature, value, 0 AS side FROM ref_long UNION ALL SELECT feature, value, 1 FROM cur_long),
binned AS (SELECT s.feature, s.side, len(list_filter(g.e, lambda x: x <= s.value)) AS bin
           FROM sided s JOIN edges g USING (feature)),
counts AS (SELECT feature, bin, count(*) FILTER (WHERE side = 0) AS nr, count(*) FILTER (WHERE side = 1) AS nc
           FROM binned GROUP BY feature, bin),
allb AS (SELECT feature, unnest(range(0, len(e) + 1)) AS bin FROM edges),
fullb AS (SELECT a.feature, a.bin, coalesce(nr, 0) AS nr, coalesce(nc, 0) AS nc
          FROM allb a LEFT JOIN counts USING (feature, bin)),
tot AS (SELECT *, sum(nr) OVER (PARTITION BY feature) AS tr, sum(nc) OVER (PARTITION BY feature) AS tc FROM fullb),
sh AS (SELECT *, greatest(nr / tr, 1e-6) AS rs, greatest(nc / tc, 1e-6) AS cs FROM tot),
nrm AS (SELECT *, rs / sum(rs) OVER (PARTITION BY feature) AS rn, cs / sum(cs) OVER (PARTITION BY feature) AS cn FROM sh),
psi AS (SELECT feature, sum((rn - cn) * ln(rn / cn)) AS psi, CAST(max(tr) AS BIGINT) AS n_ref,
               CAST(max(tc) AS BIGINT) AS n_cur FROM nrm GROUP BY feature)"""

_KS_CTE = """,
kd AS (SELECT feature, value, count(*) FILTER (WHERE side = 0) AS nr, count(*) FILTER (WHERE side = 1) AS nc
       FROM (SELECT feature, value, 0 AS side FROM ref_long UNION ALL SELECT feature, value, 1 FROM cur_long)
       GROUP BY feature, value),
kc AS (SELECT feature,
              sum(nr) OVER (PARTITION BY feature ORDER BY value) / sum(nr) OVER (PARTITION BY feature) AS fr,
              sum(nc) OVER (PARTITION BY feature ORDER BY value) / sum(nc) OVER (PARTITION BY feature) AS fc
       FROM kd),
ks AS (SELECT feature, max(abs(fr - fc)) AS ks FROM kc GROUP BY feature)"""

ORACLE["psi_by_feature"] = "WITH " + _PSI_CTE + """
SELECT feature, round(psi, 6) AS psi, n_ref, n_cur FROM psi"""

ORACLE["psi_edges"] = "WITH " + DRIFT_SQL + f""",
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, {_PROBS10}))) AS e
          FROM ref_long GROUP BY feature)
SELECT feature, CAST(pos - 1 AS BIGINT) AS pos, round(e[pos], 6) AS edge
FROM (SELECT feature, e, unnest(range(1, len(e) + 1)) AS pos FROM edges)"""

ORACLE["ks_by_feature"] = "WITH " + DRIFT_SQL + _KS_CTE + """
SELECT feature, round(ks, 6) AS ks FROM ks"""

_REPORT_CTE = _PSI_CTE + _KS_CTE + """,
report AS (SELECT f.feature, p.psi, k.ks,
                  coalesce(p.psi >= 0.2, false) AS psi_exceeds, coalesce(k.ks >= 0.1, false) AS ks_exceeds
           FROM (VALUES ('Time'), ('Amount'), ('V1'), ('V2'), ('V3')) f(feature)
           LEFT JOIN psi p USING (feature) LEFT JOIN ks k USING (feature))"""

ORACLE["drift_report"] = "WITH " + _REPORT_CTE + """
SELECT feature, round(psi, 6) AS psi, round(ks, 6) AS ks, psi_exceeds, ks_exceeds FROM report"""

ORACLE["drift_summary"] = "WITH " + _REPORT_CTE + """
SELECT CAST(count(*) AS BIGINT) AS feature_count, 0.2::DOUBLE AS psi_threshold, 0.1::DOUBLE AS ks_threshold,
       round(max(psi), 6) AS psi_max, round(avg(psi), 6) AS psi_mean,
       round(max(ks), 6) AS ks_max, round(avg(ks), 6) AS ks_mean,
       CAST(count(*) FILTER (WHERE psi_exceeds) AS BIGINT) AS psi_exceeded_count,
       CAST(count(*) FILTER (WHERE ks_exceeds) AS BIGINT) AS ks_exceeded_count,
       (count(*) FILTER (WHERE psi_exceeds) > 0 OR count(*) FILTER (WHERE ks_exceeds) > 0) AS drift_detected
FROM report"""

ORACLE["drift_metric_map"] = "WITH " + _REPORT_CTE.replace(
    "\"Time\", \"Amount\", \"V1\", \"V2\", \"V3\" INTO", "\"Time\", \"Amount\", \"V1\", \"V2\", \"V3\", \"Class\" INTO") + """
SELECT 'drift.psi.' || feature AS metric, round(psi, 6) AS value FROM psi
UNION ALL SELECT 'drift.ks.' || feature AS metric, round(ks, 6) AS value FROM ks"""


# --- validation ---------------------------------------------------------------

from vigil.functions.scalars import NUMERIC_TEXT  # noqa: E402
from vigil.operators.validate import REQUIRED_COLUMNS  # noqa: E402
from vigil.sources.fixtures import DIRTY_SQL  # noqa: E402


def num_sql(col: str) -> str:
    """DuckDB twin of scalars.to_number for a text column."""
    v = f"CASE WHEN regexp_matches({col}, '{NUMERIC_TEXT}') THEN TRY_CAST(trim({col}) AS DOUBLE) END"
    return f"(CASE WHEN isnan({v}) THEN NULL ELSE {v} END)"


_DIRTY_COLS = ["txn_id", "Time", "Amount", "V1", "V2", "V3", "Class"]
_MISSING_REQ = sorted(c for c in REQUIRED_COLUMNS if c not in _DIRTY_COLS)
_LAB = num_sql('"Class"')

_COUNTERS = DIRTY_SQL + """,
k AS (SELECT count(*) AS n, """ + ", ".join(
    f"count(*) FILTER (WHERE \"{c}\" IS NULL) AS m{i}" for i, c in enumerate(_DIRTY_COLS)) + f""",
  count(*) FILTER (WHERE {_LAB} = 0) AS l0, count(*) FILTER (WHERE {_LAB} = 1) AS l1,
  count(*) FILTER (WHERE "Class" IS NULL) AS lm,
  count(*) FILTER (WHERE "Class" IS NOT NULL AND ({_LAB} IS NULL OR {_LAB} NOT IN (0, 1))) AS li,
  count(*) FILTER (WHERE "Amount" IS NOT NULL AND {num_sql('"Amount"')} IS NULL) AS ai,
  count(*) FILTER (WHERE {num_sql('"Amount"')} < 0) AS an,
  count(*) FILTER (WHERE "Time" IS NOT NULL AND {num_sql('"Time"')} IS NULL) AS ti,
  count(*) FILTER (WHERE {num_sql('"Time"')} < 0) AS tn
  FROM dirty),
inv AS (SELECT list_sort(list(v)) AS inv FROM (
  SELECT DISTINCT "Class" AS v FROM dirty
  WHERE "Class" IS NOT NULL AND ({_LAB} IS NULL OR {_LAB} NOT IN (0, 1)) ORDER BY v LIMIT 10)),
kk AS (SELECT * FROM k, inv)"""

_OVER = "concat_ws(', ', " + ", ".join(
    f"CASE WHEN m{i} / n > 0.0 THEN '{c} (' || printf('%.2f', m{i} / n * 100) || '%)' END"
    for i, c in enumerate(_DIRTY_COLS)) + ")"


def _amount_like(tag: str, title: str) -> str:
    i, ng = f"{tag}i", f"{tag}n"
    return f"""CASE WHEN {i} = 0 AND {ng} = 0 THEN '{title} column has no negative or non-numeric values.'
      WHEN {i} > 0 AND {ng} > 0 THEN printf('{title} column has %d negative values and %d non-numeric values.', {ng}, {i})
      WHEN {i} > 0 THEN printf('{title} column has %d non-numeric values.', {i})
      ELSE printf('{title} column has %d negative values.', {ng}) END"""


_RATIO = "(CASE WHEN n > 0 THEN l1 / n ELSE 0.0 END)"

ORACLE["validation_checks"] = "WITH " + _COUNTERS + f"""
SELECT CAST(0 AS BIGINT) AS ord, 'minimum_rows' AS "check", n >= 1000 AS passed,
       printf('Dataset has %d rows; minimum required is 1000.', n) AS message FROM kk
UNION ALL SELECT 1, 'required_columns', false, 'Missing required columns: {", ".join(_MISSING_REQ)}' FROM kk
UNION ALL SELECT 2, 'missing_values', {_OVER} = '',
       CASE WHEN {_OVER} = '' THEN 'Missing value ratios within threshold (0.00%).'
            ELSE 'Columns exceed missing value ratio threshold: ' || {_OVER} END FROM kk
UNION ALL SELECT 3, 'label_column',
       CASE WHEN n = 0 THEN false WHEN li > 0 THEN false WHEN l0 + l1 = 0 THEN false ELSE true END,
       CASE WHEN n = 0 THEN 'Label column ''Class'' is present but dataset is empty.'
            WHEN li > 0 THEN 'Label column ''Class'' contains invalid values: ' || array_to_string(inv[1:5], ', ') || '.'
            WHEN l0 + l1 = 0 THEN 'Label column ''Class'' has no valid 0/1 values.'
            ELSE 'Label column ''Class'' contains only 0/1 values.' END FROM kk
UNION ALL SELECT 4, 'amount_non_negative', ai = 0 AND an = 0, {_amount_like('a', 'Amount')} FROM kk
UNION ALL SELECT 5, 'time_non_negative', ti = 0 AND tn = 0, {_amount_like('t', 'Time')} FROM kk
UNION ALL SELECT 6, 'class_balance',
       CASE WHEN n = 0 OR li > 0 THEN false ELSE {_RATIO} BETWEEN 0.0005 AND 0.03 END,
       CASE WHEN n = 0 THEN 'Dataset is empty; cannot compute class balance.'
            WHEN li > 0 THEN 'Label column has invalid values; cannot compute class balance.'
            WHEN {_RATIO} BETWEEN 0.0005 AND 0.03 THEN 'Class balance ratio within bounds.'
            ELSE 'Class balance ratio out of bounds: observed ' || printf('%.4f', {_RATIO} * 100)
                 || '%, expected between 0.05% and 3.00%.' END FROM kk"""

ORACLE["missing_stats"] = "WITH " + _COUNTERS + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(m{i} AS BIGINT) AS missing_count, "
    f"round(CASE WHEN n > 0 THEN m{i} / n ELSE 0.0 END, 6) AS missing_ratio FROM kk"
    for i, c in enumerate(_DIRTY_COLS))

ORACLE["label_stats"] = "WITH " + _COUNTERS + """
SELECT 'Class' AS label_column, CAST(l0 AS BIGINT) AS count_0, CAST(l1 AS BIGINT) AS count_1,
       CAST(lm AS BIGINT) AS count_missing, CAST(li AS BIGINT) AS invalid_label_count,
       round(CASE WHEN n > 0 THEN l1 / n END, 6) AS positive_ratio,
       array_to_string(inv, ', ') AS invalid_labels FROM kk"""

ORACLE["validation_metrics"] = "WITH " + TXN_SQL + f""",
k AS (SELECT count(*) AS n, sum("Class") AS s FROM transactions)
SELECT 'validation.total_rows' AS metric, CAST(n AS DOUBLE) AS value FROM k
UNION ALL SELECT 'validation.missing_columns_count', {float(len([c for c in REQUIRED_COLUMNS if c not in
    ['txn_id', 'Time', 'Amount', 'V1', 'V2', 'V3', 'Class', 'score']]))} FROM k
UNION ALL SELECT 'validation.non_numeric_columns_count', 1.0 FROM k
UNION ALL SELECT 'validation.nan_total', 0.0 FROM k
UNION ALL SELECT 'validation.class_ratio', round(CASE WHEN n > 0 THEN s / n END, 6) FROM k"""

ORACLE["numeric_coercion"] = "WITH " + DIRTY_SQL + f"""
SELECT txn_id, round({num_sql('"Amount"')}, 6) AS amount, round({num_sql('"Time"')}, 6) AS time,
       round({num_sql('"V1"')}, 6) AS v1, CAST(coalesce(TRY_CAST(trunc({_LAB}) AS INTEGER), 0) AS BIGINT) AS label
FROM dirty"""


# --- splits and scaling -------------------------------------------------------

def split_cte(name: str, src: str, test: float, hash_expr: str) -> str:
    """DuckDB twin of split.mark_split: largest-remainder sizes, md5 order."""
    return f"""
{name}_cnt AS (SELECT "Class" AS c, count(*) AS n_c FROM {src} GROUP BY 1),
{name}_tot AS (SELECT sum(n_c) AS n, CAST(ceil(CAST({test} AS DOUBLE) * sum(n_c)) AS BIGINT) AS n_test FROM {name}_cnt),
{name}_sh AS (SELECT c, n_c, n - n_test AS n_train, ((n - n_test) * n_c) // n AS fl,
                     ((n - n_test) * n_c) % n AS rm FROM {name}_cnt, {name}_tot),
{name}_rk AS (SELECT *, row_number() OVER (ORDER BY rm DESC, c) AS rr, n_train - sum(fl) OVER () AS lft
              FROM {name}_sh),
{name}_alloc AS (SELECT c, n_c - (fl + CASE WHEN rr <= lft THEN 1 ELSE 0 END) AS test_c FROM {name}_rk),
{name} AS (SELECT s.*, row_number() OVER (PARTITION BY s."Class" ORDER BY {hash_expr}) <= a.test_c AS is_test
           FROM {src} s JOIN {name}_alloc a ON s."Class" = a.c)"""


_H42 = "md5(concat_ws(':', txn_id, '42'))"
_SPLIT = TXN_SQL + "," + split_cte("sp", "transactions", 0.1, _H42) + """,
train AS (SELECT * FROM sp WHERE NOT is_test)"""

ORACLE["split_members"] = "WITH " + _SPLIT + """
SELECT txn_id, CASE WHEN is_test THEN 'test' ELSE 'train' END AS split FROM sp"""

ORACLE["split_sizes"] = "WITH " + _SPLIT + """
SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, "Class", CAST(count(*) AS BIGINT) AS n
FROM sp GROUP BY ALL"""

ORACLE["three_way_split"] = "WITH " + TXN_SQL + "," + split_cte("s1", "transactions", 0.2, _H42) + """,
rest AS (SELECT * EXCLUDE (is_test) FROM s1 WHERE NOT is_test),""" + split_cte(
    "s2", "rest", 0.2, "md5(concat_ws(':', txn_id, '42', 'val'))") + """
SELECT txn_id, 'test' AS split FROM s1 WHERE is_test
UNION ALL SELECT txn_id, CASE WHEN is_test THEN 'val' ELSE 'train' END FROM s2"""

_FOLDS = TXN_SQL + """,
folds AS (SELECT txn_id, "Class", CAST((row_number() OVER (PARTITION BY "Class"
          ORDER BY md5(concat_ws(':', txn_id, '42', 'fold'))) - 1) % 5 AS BIGINT) AS fold FROM transactions)"""

ORACLE["kfold_members"] = "WITH " + _FOLDS + "\nSELECT txn_id, fold FROM folds"
ORACLE["kfold_sizes"] = "WITH " + _FOLDS + "\nSELECT fold, \"Class\", CAST(count(*) AS BIGINT) AS n FROM folds GROUP BY ALL"

ORACLE["undersample"] = "WITH " + TXN_SQL + """,
neg AS (SELECT txn_id, "Class", row_number() OVER (ORDER BY md5(concat_ws(':', txn_id, '42', 'under'))) AS r
        FROM transactions WHERE "Class" = 0)
SELECT txn_id, "Class" FROM transactions WHERE "Class" = 1
UNION ALL SELECT txn_id, "Class" FROM neg WHERE r <= (SELECT count(*) FROM transactions WHERE "Class" = 1)"""

ORACLE["batches"] = "WITH " + TXN_SQL + """
SELECT txn_id, CAST((row_number() OVER (ORDER BY txn_id) - 1) // 200 AS BIGINT) AS batch_id FROM transactions"""

_NUM = "CAST('0x' || substr(txn_id, 18, 15) AS BIGINT)"
ORACLE["batches_by_int_key"] = "WITH " + TXN_SQL + f"""
SELECT txn_id, CAST((row_number() OVER (ORDER BY {_NUM}) - 1) // 200 AS BIGINT) AS batch_id FROM transactions"""
ORACLE["batches_by_text_key"] = "WITH " + TXN_SQL + f"""
SELECT txn_id, CAST((row_number() OVER (ORDER BY 'T' || CAST({_NUM} AS VARCHAR)) - 1) // 200 AS BIGINT) AS batch_id FROM transactions"""

_SCALERS = _SPLIT + """,
q AS (SELECT 'Amount' AS "column", quantile_cont("Amount", [0.25, 0.5, 0.75]) AS v FROM train
      UNION ALL SELECT 'Time', quantile_cont("Time", [0.25, 0.5, 0.75]) FROM train),
params AS (SELECT "column", v[2] AS center, CASE WHEN v[3] - v[1] = 0 THEN 1.0 ELSE v[3] - v[1] END AS scale FROM q)"""

ORACLE["scaler_params"] = "WITH " + _SCALERS + """
SELECT "column", round(center, 6) AS center, round(scale, 6) AS scale FROM params"""

ORACLE["scaled_stats"] = "WITH " + _SCALERS + """,
sc AS (SELECT 'Amount' AS "column", ("Amount" - (SELECT center FROM params WHERE "column" = 'Amount'))
              / (SELECT scale FROM params WHERE "column" = 'Amount') AS value FROM train
       UNION ALL SELECT 'Time', ("Time" - (SELECT center FROM params WHERE "column" = 'Time'))
              / (SELECT scale FROM params WHERE "column" = 'Time') FROM train)
SELECT "column", round(avg(value), 6) AS mean, round(min(value), 6) AS min, round(max(value), 6) AS max
FROM sc GROUP BY 1"""

ORACLE["class_weight"] = "WITH " + _SPLIT + """
SELECT CAST(count(*) FILTER (WHERE "Class" = 1) AS BIGINT) AS n_pos,
       CAST(count(*) FILTER (WHERE "Class" = 0) AS BIGINT) AS n_neg,
       round(count(*) FILTER (WHERE "Class" = 0) / greatest(count(*) FILTER (WHERE "Class" = 1), 1), 6) AS weight
FROM train"""


# --- classifier metrics -------------------------------------------------------

_SCORED = TXN_SQL + """,
scored AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS pred FROM transactions)"""

_CURVE = _SCORED + """,
cd AS (SELECT score AS thr, count(*) FILTER (WHERE "Class" = 1) AS pos, count(*) FILTER (WHERE "Class" <> 1) AS neg
       FROM transactions WHERE score IS NOT NULL AND NOT isnan(score) GROUP BY score),
cv AS (SELECT thr, pos, neg, sum(pos) OVER (ORDER BY thr DESC) AS tp, sum(neg) OVER (ORDER BY thr DESC) AS fp,
              sum(pos) OVER () AS tot_p, sum(neg) OVER () AS tot_n FROM cd),
pr AS (SELECT thr, tp / (tp + fp) AS prec, CASE WHEN tot_p > 0 THEN tp / tot_p ELSE 1.0 END AS rec FROM cv)"""

_K = """
k AS (SELECT count(*) FILTER (WHERE "Class" = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE "Class" = 0 AND pred = 1) AS fp,
             count(*) FILTER (WHERE "Class" = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE "Class" = 1 AND pred = 1) AS tp,
             count(*) AS n, sum(pred) AS pred_sum FROM scored)"""
_CONF = _SCORED + "," + _K

ORACLE["confusion"] = "WITH " + _CONF + """
SELECT CAST(0 AS BIGINT) AS actual, CAST(0 AS BIGINT) AS predicted, CAST(tn AS BIGINT) AS n FROM k
UNION ALL SELECT 0, 1, fp FROM k UNION ALL SELECT 1, 0, fn FROM k UNION ALL SELECT 1, 1, tp FROM k"""


def _d0(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"


_AUC = "(SELECT CASE WHEN max(tot_p) > 0 AND max(tot_n) > 0 THEN sum(pos * (tot_n - fp + neg / 2.0)) / (max(tot_p) * max(tot_n)) END FROM cv)"
_AP = "(SELECT CASE WHEN max(tot_p) > 0 THEN sum(pos * (tp / (tp + fp))) / max(tot_p) END FROM cv)"

ORACLE["basic_metrics"] = "WITH " + _CURVE + "," + _K + f"""
SELECT 'metrics.accuracy' AS metric, round({_d0('tp + tn', 'n')}, 6) AS value FROM k
UNION ALL SELECT 'metrics.precision', round({_d0('tp', 'tp + fp')}, 6) FROM k
UNION ALL SELECT 'metrics.recall', round({_d0('tp', 'tp + fn')}, 6) FROM k
UNION ALL SELECT 'metrics.f1', round({_d0('2 * tp', '2 * tp + fp + fn')}, 6) FROM k
UNION ALL SELECT 'metrics.alert_rate', round(CASE WHEN n > 0 THEN pred_sum / n END, 6) FROM k
UNION ALL SELECT 'metrics.alert_count', round(CASE WHEN n > 0 THEN CAST(pred_sum AS DOUBLE) END, 6) FROM k
UNION ALL SELECT 'metrics.roc_auc', round({_AUC}, 6)
UNION ALL SELECT 'metrics.pr_auc', round({_AP}, 6)"""

ORACLE["class_report"] = "WITH " + _CONF + f""",
r AS (SELECT {_d0('tp', 'tp + fp')} AS p1, {_d0('tp', 'tp + fn')} AS r1, {_d0('tn', 'tn + fn')} AS p0,
             {_d0('tn', 'tn + fp')} AS r0, {_d0('2 * tp', '2 * tp + fp + fn')} AS f1, {_d0('2 * tn', '2 * tn + fn + fp')} AS f0,
             CAST(tp + fn AS DOUBLE) AS s1, CAST(tn + fp AS DOUBLE) AS s0, CAST(n AS DOUBLE) AS n,
             {_d0('tp + tn', 'n')} AS acc FROM k)
SELECT '0' AS label, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1_score, round(s0, 6) AS support FROM r
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), round(s1, 6) FROM r
UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), round(n, 6) FROM r
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), round(n, 6) FROM r
UNION ALL SELECT 'weighted avg', round({_d0('p0 * s0 + p1 * s1', 'n')}, 6), round({_d0('r0 * s0 + r1 * s1', 'n')}, 6),
                 round({_d0('f0 * s0 + f1 * s1', 'n')}, 6), round(n, 6) FROM r"""

ORACLE["roc_auc"] = "WITH " + _CURVE + f"\nSELECT round({_AUC}, 6) AS roc_auc"
ORACLE["average_precision"] = "WITH " + _CURVE + f"\nSELECT round({_AP}, 6) AS average_precision"
ORACLE["pr_curve"] = "WITH " + _CURVE + """
SELECT round(thr, 6) AS threshold, round(prec, 6) AS precision, round(rec, 6) AS recall FROM pr
UNION ALL SELECT NULL, 1.0, 0.0"""
ORACLE["best_f1_threshold"] = "WITH " + _CURVE + """,
f AS (SELECT *, 2 * prec * rec / (prec + rec + 1e-12) AS f1 FROM pr)
SELECT round(thr, 6) AS threshold, round(prec, 6) AS precision, round(rec, 6) AS recall, round(f1, 6) AS f1
FROM f ORDER BY f1 DESC, thr ASC LIMIT 1"""
ORACLE["recall_at_precision"] = "WITH " + _CURVE + """,
ok AS (SELECT count(*) FILTER (WHERE prec >= 0.1) AS nok FROM pr),
a AS (SELECT * FROM pr WHERE prec >= 0.1 ORDER BY rec DESC, thr ASC LIMIT 1),
b AS (SELECT * FROM pr ORDER BY prec DESC, thr ASC LIMIT 1),
pick AS (SELECT * FROM a WHERE (SELECT nok FROM ok) > 0 UNION ALL SELECT * FROM b WHERE (SELECT nok FROM ok) = 0)
SELECT round(thr, 6) AS threshold, round(prec, 6) AS precision, round(rec, 6) AS recall,
       (SELECT nok FROM ok) > 0 AS meets_floor FROM pick"""

ORACLE["topk_table"] = "WITH " + TXN_SQL + """,
tot AS (SELECT count(*) AS n, sum("Class") AS tot_p FROM transactions),
rk AS (SELECT row_number() OVER (ORDER BY score DESC, txn_id) AS rnk, "Class" FROM transactions),
cum AS (SELECT rnk, sum("Class") OVER (ORDER BY rnk) AS cum_tp FROM rk),
ks AS (SELECT unnest([50, 100, 200, 500, 1000, 2000]) AS k_req),
kk AS (SELECT k_req, least(k_req, n) AS alerts_k, tot_p FROM ks, tot)
SELECT CAST(k_req AS BIGINT) AS k_req, CAST(alerts_k AS BIGINT) AS alerts_k, CAST(coalesce(cum_tp, 0) AS BIGINT) AS tp,
       CAST(alerts_k - coalesce(cum_tp, 0) AS BIGINT) AS fp,
       round(coalesce(cum_tp, 0) / greatest(alerts_k, 1), 6) AS precision,
       round(coalesce(cum_tp, 0) / greatest(tot_p, 1), 6) AS recall
FROM kk LEFT JOIN cum ON cum.rnk = kk.alerts_k"""

ORACLE["calibration"] = "WITH " + TXN_SQL + f""",
e AS (SELECT quantile_cont(score, {_PROBS10}) AS edges FROM transactions),
b AS (SELECT score, "Class", len(list_filter(edges, lambda x: x < score)) AS bin FROM transactions, e)
SELECT CAST(bin AS BIGINT) AS bin, round(avg(score), 6) AS mean_pred, round(avg("Class"), 6) AS frac_pos,
       CAST(count(*) AS BIGINT) AS n FROM b GROUP BY bin"""

ORACLE["brier"] = "WITH " + TXN_SQL + """
SELECT round(avg(pow(score - "Class", 2)), 6) AS brier FROM transactions"""

ORACLE["feature_ap"] = "WITH " + TXN_SQL + """,
l AS (UNPIVOT (SELECT "Class", "Time", "Amount", "V1", "V2", "V3" FROM transactions)
      ON "Time", "Amount", "V1", "V2", "V3" INTO NAME feature VALUE value),
b AS (SELECT feature, '+' AS sign, value AS v, "Class" AS y FROM l
      UNION ALL SELECT feature, '-', -value, "Class" FROM l),
d AS (SELECT feature, sign, v, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg
      FROM b GROUP BY ALL),
c AS (SELECT *, sum(pos) OVER (PARTITION BY feature, sign ORDER BY v DESC) AS tp,
             sum(neg) OVER (PARTITION BY feature, sign ORDER BY v DESC) AS fp,
             sum(pos) OVER (PARTITION BY feature, sign) AS tot_p FROM d),
ap AS (SELECT feature, sign, CASE WHEN max(tot_p) > 0 THEN sum(pos * (tp / (tp + fp))) / max(tot_p) END AS ap
       FROM c GROUP BY ALL),
w AS (SELECT feature, max(ap) FILTER (WHERE sign = '+') AS ap_pos, max(ap) FILTER (WHERE sign = '-') AS ap_neg
      FROM ap GROUP BY feature)
SELECT feature, round(ap_pos, 6) AS ap_pos, round(ap_neg, 6) AS ap_neg, round(greatest(ap_pos, ap_neg), 6) AS strength,
       CASE WHEN ap_pos >= ap_neg THEN '+' ELSE '-' END AS direction FROM w"""

ORACLE["canonical_metrics"] = "WITH " + _CONF + f""",
views AS (SELECT 'c1' AS view, "Class" AS y, score AS p FROM transactions
          UNION ALL SELECT 'c0', 1 - "Class", 1 - score FROM transactions),
views2 AS (SELECT * FROM views UNION ALL SELECT 'micro', y, p FROM views),
vd AS (SELECT view, p AS thr, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg
       FROM views2 GROUP BY ALL),
vc AS (SELECT *, sum(pos) OVER (PARTITION BY view ORDER BY thr DESC) AS tp, sum(neg) OVER (PARTITION BY view ORDER BY thr DESC) AS fp,
              sum(pos) OVER (PARTITION BY view) AS tot_p, sum(neg) OVER (PARTITION BY view) AS tot_n FROM vd),
rk AS (SELECT view, sum(pos * (tp / (tp + fp))) / max(tot_p) AS ap,
              sum(pos * (tot_n - fp + neg / 2.0)) / (max(tot_p) * max(tot_n)) AS auc FROM vc GROUP BY view),
r AS (SELECT {_d0('tp', 'tp + fp')} AS p1, {_d0('tp', 'tp + fn')} AS r1, {_d0('tn', 'tn + fn')} AS p0,
             {_d0('tn', 'tn + fp')} AS r0, {_d0('2 * tp', '2 * tp + fp + fn')} AS f1, {_d0('2 * tn', '2 * tn + fn + fp')} AS f0,
             CAST(tp + fn AS DOUBLE) AS s1, CAST(tn + fp AS DOUBLE) AS s0, CAST(n AS DOUBLE) AS n,
             {_d0('tp + tn', 'n')} AS acc, CAST(tp AS DOUBLE) AS dtp, CAST(tn AS DOUBLE) AS dtn,
             CAST(fp AS DOUBLE) AS dfp, CAST(fn AS DOUBLE) AS dfn FROM k),
m AS (SELECT *, (r0 + r1) / 2 AS bal,
             sqrt((dtp + dfp) * (dtp + dfn) * (dtn + dfp) * (dtn + dfn)) AS mden,
             (SELECT ap FROM rk WHERE view = 'c0') AS ap0, (SELECT ap FROM rk WHERE view = 'c1') AS ap1,
             (SELECT ap FROM rk WHERE view = 'micro') AS apm, (SELECT auc FROM rk WHERE view = 'c0') AS auc0,
             (SELECT auc FROM rk WHERE view = 'c1') AS auc1, (SELECT auc FROM rk WHERE view = 'micro') AS aucm,
             (SELECT -avg("Class" * ln(least(greatest(score, 1e-15), 1 - 1e-15))
                          + (1 - "Class") * ln(1 - least(greatest(score, 1e-15), 1 - 1e-15))) FROM transactions) AS ll
      FROM r)
SELECT metric, round(value, 6) AS value FROM (
  SELECT 'metrics.weighted_accuracy' AS metric, {_d0('s1 * dtp + s0 * dtn', 's1 * s1 + s0 * s0')} AS value FROM m
  UNION ALL SELECT 'metrics.AUC_micro', aucm FROM m
  UNION ALL SELECT 'metrics.precision_score_weighted', {_d0('p0 * s0 + p1 * s1', 'n')} FROM m
  UNION ALL SELECT 'metrics.f1_score_macro', (f0 + f1) / 2 FROM m
  UNION ALL SELECT 'metrics.norm_macro_recall', (bal - 0.5) / 0.5 FROM m
  UNION ALL SELECT 'metrics.average_precision_score_weighted', {_d0('ap0 * s0 + ap1 * s1', 'n')} FROM m
  UNION ALL SELECT 'metrics.AUC_macro', (auc0 + auc1) / 2 FROM m
  UNION ALL SELECT 'metrics.f1_score_micro', acc FROM m
  UNION ALL SELECT 'metrics.recall_score_macro', bal FROM m
  UNION ALL SELECT 'metrics.recall_score_micro', acc FROM m
  UNION ALL SELECT 'metrics.precision_score_micro', acc FROM m
  UNION ALL SELECT 'metrics.AUC_weighted', {_d0('auc0 * s0 + auc1 * s1', 'n')} FROM m
  UNION ALL SELECT 'metrics.log_loss', ll FROM m
  UNION ALL SELECT 'metrics.average_precision_score_macro', (ap0 + ap1) / 2 FROM m
  UNION ALL SELECT 'metrics.f1_score_weighted', {_d0('f0 * s0 + f1 * s1', 'n')} FROM m
  UNION ALL SELECT 'metrics.precision_score_macro', (p0 + p1) / 2 FROM m
  UNION ALL SELECT 'metrics.average_precision_score_micro', apm FROM m
  UNION ALL SELECT 'metrics.recall_score_weighted', {_d0('r0 * s0 + r1 * s1', 'n')} FROM m
  UNION ALL SELECT 'metrics.matthews_correlation', CASE WHEN mden > 0 THEN (dtp * dtn - dfp * dfn) / mden ELSE 0.0 END FROM m
  UNION ALL SELECT 'metrics.accuracy', acc FROM m
  UNION ALL SELECT 'metrics.balanced_accuracy', bal FROM m)"""

ORACLE["pr_curve_missing"] = "WITH " + TXN_SQL + """
SELECT count(DISTINCT score) + 1 AS points, CAST(1 AS BIGINT) AS with_recall, CAST(NULL AS DOUBLE) AS best_f1, CAST(NULL AS DOUBLE) AS at_precision
FROM transactions WHERE txn_id NOT LIKE '1%'"""
ORACLE["calibration_missing"] = ORACLE["calibration"].replace("FROM transactions", "FROM (SELECT * FROM transactions WHERE txn_id NOT LIKE '1%')")
ORACLE["canonical_missing"] = """SELECT metric, CASE WHEN metric NOT LIKE '%AUC%' AND metric NOT LIKE '%average_precision%' AND metric NOT LIKE '%log_loss' THEN value END AS value
FROM (""" + ORACLE["canonical_metrics"] + ")"

_UNIT = TXN_SQL + """,
u AS (SELECT "Time" / 1e8 AS a, "Amount" / 1e5 AS b, "V1" AS c, "V2" AS d, "V3" / 10.0 AS e FROM transactions),
m AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(d) AS md, avg(e) AS me FROM u)"""
ORACLE["pca_rows"] = "WITH " + _UNIT + """,
z AS (SELECT pow(a - ma, 2) + pow(b - mb, 2) + pow(c - mc, 2) + pow(d - md, 2) + pow(e - me, 2) AS s FROM u, m)
SELECT round((SELECT var_samp(a) + var_samp(b) + var_samp(c) + var_samp(d) + var_samp(e) FROM u), 6) AS variance, round(avg(s * s), 6) AS fourth,
       0.0::DOUBLE AS covariance, count(*) AS n, true AS ordered FROM z"""
ORACLE["svd_rows"] = "WITH " + _UNIT + """,
z AS (SELECT a * a + b * b + c * c + d * d + e * e AS s FROM u)
SELECT round(avg(s), 6) AS second, round(avg(s * s), 6) AS fourth, round(avg(s), 6) AS from_values, 1.0::DOUBLE AS first_share FROM z"""


# --- alerts, runs, registry ---------------------------------------------------------

from vigil.functions.scalars import CANONICAL_METRIC_KEYS, METRIC_ALIASES, MIN_DIRECTION_MARKERS  # noqa: E402
from vigil.sources.fixtures import ASSETS_SQL, RUNS_SQL  # noqa: E402

ORACLE["alerts_topk"] = "WITH " + TXN_SQL + """,
r AS (SELECT txn_id, score, row_number() OVER (ORDER BY score DESC, txn_id) AS rnk FROM transactions),
kk AS (SELECT least(100, count(*)) AS k FROM transactions),
a AS (SELECT txn_id, score, rnk, CAST(rnk <= k AS BIGINT) AS alert, k FROM r, kk)
SELECT txn_id, CAST(rnk AS BIGINT) AS rank, alert, CAST(k AS BIGINT) AS k,
       round(CASE WHEN k > 0 THEN (SELECT min(score) FROM a WHERE alert = 1) ELSE 1.0 END, 6) AS threshold FROM a"""

ORACLE["alerts_by_int_key"] = "WITH " + TXN_SQL + f""",
t AS (SELECT txn_id, {_NUM} AS num FROM transactions),
r AS (SELECT txn_id, num, CASE WHEN num % 5 > 1 THEN row_number() OVER (PARTITION BY num % 5 > 1 ORDER BY num) END AS rank FROM t)
SELECT txn_id, CAST(rank AS BIGINT) AS rank, CAST(coalesce(rank <= 100, false) AS BIGINT) AS alert, CAST(100 AS BIGINT) AS k, 0.5::DOUBLE AS threshold FROM r"""

_PER_BATCH = TXN_SQL + """,
b AS (SELECT *, (row_number() OVER (ORDER BY txn_id) - 1) // 200 AS batch_id FROM transactions),
c AS (SELECT *, count(*) OVER (PARTITION BY batch_id) AS batch_rows FROM b),
d AS (SELECT *, CAST(ceil(CAST(0.1 AS DOUBLE) * batch_rows) AS BIGINT) AS max_alerts FROM c),
e AS (SELECT *, least(max_alerts, batch_rows) AS k,
             row_number() OVER (PARTITION BY batch_id ORDER BY score DESC, txn_id) AS rnk FROM d),
f AS (SELECT *, CAST(rnk <= k AS BIGINT) AS alert FROM e),
g AS (SELECT *, CASE WHEN k > 0 THEN min(CASE WHEN alert = 1 THEN score END) OVER (PARTITION BY batch_id)
                     ELSE 1.0 END AS threshold FROM f)"""

ORACLE["alerts_per_batch"] = "WITH " + _PER_BATCH + """
SELECT txn_id, CAST(batch_id AS BIGINT) AS batch_id, CAST(rnk AS BIGINT) AS rank, alert, CAST(k AS BIGINT) AS k,
       round(threshold, 6) AS threshold FROM g"""

ORACLE["batch_merge"] = "WITH " + _PER_BATCH + """,
s AS (SELECT batch_id, count(*) AS n_predictions, sum(alert) AS num_alerts, min(threshold) AS threshold_used,
             min(max_alerts) AS max_alerts, count(score) = count(*) AS has_p FROM g GROUP BY batch_id)
SELECT CAST(sum(n_predictions) AS BIGINT) AS n_predictions, CAST(sum(num_alerts) AS BIGINT) AS total_alerts,
       bool_and(has_p) AS probabilities_available, round(arg_min(threshold_used, batch_id), 6) AS threshold_used,
       CAST(arg_min(max_alerts, batch_id) AS BIGINT) AS max_alerts, CAST(arg_min(num_alerts, batch_id) AS BIGINT) AS num_alerts,
       CAST(count(*) AS BIGINT) AS n_batches FROM s"""


def norm_metric_sql(x: str) -> tuple[str, str, str, str]:
    """DuckDB twin of scalars.normalize_metric / metric_direction: (bare, full, valid, direction)."""
    raw = f"trim({x})"
    bare = f"(CASE WHEN starts_with({raw}, 'metrics.') THEN substr({raw}, 9) ELSE {raw} END)"
    canon = "(CASE lower(" + bare + ") " + " ".join(
        f"WHEN '{k}' THEN '{v}'" for k, v in METRIC_ALIASES.items()) + " END)"
    bare2 = f"coalesce(substr({canon}, 9), {bare})"
    full = f"('metrics.' || {bare2})"
    keys = ", ".join(f"'{k}'" for k in CANONICAL_METRIC_KEYS)
    valid = f"coalesce({full} IN ({keys}) AND {raw} <> '', false)"
    direction = "(CASE WHEN " + " OR ".join(
        f"contains(lower({bare2}), '{m}')" for m in MIN_DIRECTION_MARKERS) + " THEN 'min' ELSE 'max' END)"
    return bare2, full, valid, direction


_b, _f, _v, _d = norm_metric_sql("primary_metric")
ORACLE["metric_alias"] = "WITH " + RUNS_SQL + f"""
SELECT run_id, primary_metric, {_b} AS bare, {_f} AS full, {_v} AS valid, {_d} AS direction FROM runs"""

ORACLE["run_metrics_long"] = "WITH " + RUNS_SQL + "\nSELECT run_id, key, round(value, 6) AS value FROM run_metrics"


def _best_sql(requested: list[str]) -> str:
    rb, _, _, rd = norm_metric_sql("requested")
    vals = ", ".join(f"('{r}')" for r in requested)
    return f""",
req AS (SELECT requested, {rb} AS metric, {rd} AS direction FROM (VALUES {vals}) t(requested)),
exps AS (SELECT DISTINCT trim(e) AS e FROM (SELECT unnest(string_split('custom_train, automl_train, custom_train', ',')) AS e)),
rr AS (SELECT * FROM runs WHERE experiment_name IN (SELECT e FROM exps WHERE e <> '') AND status = 'FINISHED'),
v AS (SELECT q.requested, q.metric, q.direction, m.run_id, rr.experiment_name, m.value
      FROM run_metrics m JOIN rr USING (run_id) JOIN req q ON m.key = q.metric WHERE m.value IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY requested
           ORDER BY CASE WHEN direction = 'min' THEN value ELSE -value END, run_id) AS rn FROM v),
best AS (SELECT requested, metric, direction, run_id, experiment_name, value AS metric_value FROM ranked WHERE rn = 1)"""


ORACLE["best_run"] = "WITH " + RUNS_SQL + _best_sql(["auc", "metrics.accuracy", "log_loss"]) + """
SELECT requested, metric, direction, run_id, experiment_name, round(metric_value, 6) AS metric_value FROM best"""

_VERS = ASSETS_SQL + r""",
vp AS (SELECT *, CASE WHEN regexp_matches(trim(version), '^[0-9]+(\.[0-9]+)*$')
                      THEN list_transform(string_split(trim(version), '.'), lambda x: CAST(x AS BIGINT)) END AS parts
       FROM assets),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY parts IS NOT NULL DESC,
           parts DESC NULLS LAST, lower(trim(version)) DESC, asset_id DESC) AS rn FROM vp) WHERE rn = 1)"""

ORACLE["latest_version"] = "WITH " + _VERS + "\nSELECT name, version, asset_id FROM latest"

ORACLE["next_version"] = "WITH " + _VERS + """,
mx AS (SELECT name, (SELECT parts FROM vp v2 WHERE v2.name = v1.name AND parts IS NOT NULL
                     ORDER BY parts DESC LIMIT 1) AS v FROM (SELECT DISTINCT name FROM vp) v1)
SELECT name, CASE WHEN v IS NULL THEN '1.0'
                  ELSE array_to_string(list_concat(v[1:len(v) - 1], [v[len(v)] + 1]), '.') END AS next_version FROM mx"""

_PROD = RUNS_SQL + "," + _VERS + """,
prod AS (SELECT l.name, l.version AS prod_version,
                CASE WHEN tag_key IN ('run_id', 'mlflow_run_id', 'best_run_id') THEN tag_run END AS prod_run_id,
                l.dataset_version
         FROM latest l),
prodm AS (SELECT p.name, p.prod_version, p.prod_run_id, m.value AS prod_value, p.dataset_version
          FROM prod p LEFT JOIN run_metrics m ON m.run_id = p.prod_run_id AND m.key = 'AUC_macro')"""

ORACLE["prod_metric"] = "WITH " + _PROD + """
SELECT name, prod_version, prod_run_id, round(prod_value, 6) AS prod_value, dataset_version FROM prodm"""

ORACLE["promotion"] = "WITH " + _PROD + _best_sql(["auc"]) + """,
j AS (SELECT * EXCLUDE (dataset_version) FROM best, prodm),
d AS (SELECT *, metric_value >= 0.6 AS meets, abs(metric_value - prod_value) <= 0.001 AS same,
             CASE WHEN direction = 'min' THEN metric_value < prod_value - 0.001 ELSE metric_value > prod_value + 0.001 END AS better
      FROM j),
e AS (SELECT *, CASE WHEN prod_value IS NULL THEN CASE WHEN meets THEN 'promote' ELSE 'stage' END
                     WHEN same THEN 'skip' WHEN meets AND better THEN 'promote' ELSE 'stage' END AS decision,
                CASE WHEN prod_value IS NULL THEN CASE WHEN meets THEN 'no_prod_model' ELSE 'below_min_threshold' END
                     WHEN same THEN 'equal_metric' WHEN meets AND better THEN 'better_metric'
                     WHEN NOT meets THEN 'below_min_threshold' ELSE 'worse_metric' END AS reason FROM d)
SELECT name, metric, run_id, round(metric_value, 6) AS metric_value, prod_version, prod_run_id,
       round(prod_value, 6) AS prod_value, decision, reason, decision = 'promote' AS should_promote,
       CASE WHEN decision = 'skip' THEN NULL WHEN decision = 'promote' THEN name ELSE 'model_' || run_id END AS model_name
FROM e"""


ORACLE["promotion_ledger"] = ORACLE["promotion"].rsplit("SELECT name, metric", 1)[0] + """,
nv AS (SELECT name, max(parts) AS v FROM vp WHERE parts IS NOT NULL GROUP BY name),
t AS (SELECT *, CASE WHEN decision = 'promote' THEN name ELSE 'model_' || run_id END AS model_name,
             left(sha1(experiment_name || '::' || metric || '::' || run_id || '::abc1234'), 7) AS k FROM e),
g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, model_name ORDER BY name NULLS FIRST) AS rn FROM t) WHERE rn = 1),
f AS (SELECT g.*, coalesce(array_to_string(list_concat(v[1:len(v) - 1], [v[len(v)] + 1]), '.'), '1') AS mv FROM g LEFT JOIN nv ON nv.name = g.model_name)
SELECT metric, direction AS metric_direction, 'custom_train,automl_train' AS experiments, run_id AS best_run_id, experiment_name AS best_experiment_name,
       metric AS best_metric_name, round(metric_value, 6) AS best_metric_value, round(prod_value, 6) AS prod_metric_value, decision, decision = 'promote' AS promote,
       model_name, mv AS model_version, model_name || ':' || mv AS model_id, false AS dry_run, k AS idempotency_key,
       CASE WHEN decision = 'promote' THEN 'production' ELSE 'staging' END AS stage, CASE WHEN experiment_name = 'automl_train' THEN 'automl' ELSE 'custom' END AS model_source,
       CASE WHEN decision = 'promote' THEN 'true' ELSE 'false' END AS promotion, reason, 15 AS n_tags FROM f"""

ORACLE["promotion_first_model"] = "WITH " + _PROD + _best_sql(["auc"]) + """
SELECT metric, run_id, round(metric_value, 6) AS metric_value, CASE WHEN metric_value >= 0.6 THEN 'promote' ELSE 'stage' END AS decision,
       CASE WHEN metric_value >= 0.6 THEN 'no_prod_model' ELSE 'below_min_threshold' END AS reason, metric_value >= 0.6 AS should_promote
FROM best"""

ORACLE["incomplete_scores"] = "WITH " + TXN_SQL + """,
t AS (SELECT CAST("Class" = 1 AS INTEGER) AS y, CAST(score >= 0.5 AS INTEGER) AS p FROM transactions),
c AS (SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
             count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 0 AND p = 0) AS tn, count(*) AS n FROM t)
SELECT m.metric, round(m.value, 6) AS value FROM c, LATERAL (VALUES
  ('metrics.accuracy', (tp + tn) / n), ('metrics.precision', CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END),
  ('metrics.recall', CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END), ('metrics.f1', CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END),
  ('metrics.alert_rate', (tp + fp) / n), ('metrics.alert_count', CAST(tp + fp AS DOUBLE)), ('metrics.roc_auc', NULL), ('metrics.pr_auc', NULL)) AS m(metric, value)"""


# --- exploratory statistics ------------------------------------------------------

_EDA = ["Time", "Amount", "V1", "V2", "V3", "Class"]


def _q(c: str) -> str:
    return '"' + c + '"'


ORACLE["describe"] = "WITH " + TXN_SQL + "\n" + "\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(count({_q(c)}) AS BIGINT) AS count,
       CAST(count(*) FILTER (WHERE {_q(c)} IS NULL) AS BIGINT) AS null_count,
       round(avg({_q(c)}), 5) AS mean, round(stddev_samp({_q(c)}), 6) AS std, round(min({_q(c)}), 6) AS min,
       round(quantile_cont({_q(c)}, 0.25), 6) AS q25, round(quantile_cont({_q(c)}, 0.5), 6) AS q50,
       round(quantile_cont({_q(c)}, 0.75), 6) AS q75, round(max({_q(c)}), 6) AS max FROM transactions"""
    for c in _EDA)

ORACLE["max_null_count"] = "WITH " + DIRTY_SQL + "\nSELECT CAST(greatest(" + ", ".join(
    f"count(*) FILTER (WHERE {_q(c)} IS NULL)" for c in _DIRTY_COLS) + ") AS BIGINT) AS max_null_count FROM dirty"

ORACLE["value_counts"] = "WITH " + TXN_SQL + """
SELECT "Class", CAST(count(*) AS BIGINT) AS count,
       round(round(count(*) / (SELECT count(*) FROM transactions) * 100, 2), 6) AS percentage
FROM transactions GROUP BY "Class\""""

ORACLE["class_summary"] = "WITH " + TXN_SQL + "\n" + "\nUNION ALL ".join(
    f"""SELECT '{c}' AS feature, "Class", round(avg({_q(c)}), 6) AS mean, round(quantile_cont({_q(c)}, 0.5), 6) AS median,
       round(min({_q(c)}), 6) AS min, round(max({_q(c)}), 6) AS max, round(quantile_cont({_q(c)}, 0.95), 6) AS p95,
       round(quantile_cont({_q(c)}, 0.99), 6) AS p99 FROM transactions GROUP BY "Class\""""
    for c in ["Amount", "Time"])

_PROBS11 = "[0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]"


def _qcut_sql(col: str) -> str:
    return f""",
qe AS (SELECT list_sort(list_distinct(quantile_cont({_q(col)}, {_PROBS11}))) AS edges FROM transactions),
qb AS (SELECT t.*, len(list_filter(edges[2:len(edges) - 1], lambda v: v < t.{_q(col)})) AS bin, edges
       FROM transactions t, qe),
qbb AS (SELECT *, edges[bin + 1] AS lo, edges[bin + 2] AS hi FROM qb)"""


ORACLE["qcut_rate"] = "WITH " + TXN_SQL + _qcut_sql("Time") + """
SELECT CAST(bin AS BIGINT) AS bin, round(lo, 6) AS lo, round(hi, 6) AS hi, CAST(count(*) AS BIGINT) AS n,
       round(avg("Class") * 100, 6) AS rate_pct FROM qbb GROUP BY bin, lo, hi"""

ORACLE["corr_pairs"] = "WITH " + TXN_SQL + "\n" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({_q(a)}, {_q(b)}), 6) AS r FROM transactions"
    for i, a in enumerate(_EDA) for b in _EDA[i + 1:])

ORACLE["target_corr"] = "WITH " + TXN_SQL + "\n" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS feature, round(corr({_q(a)}, \"Class\"), 6) AS r FROM transactions"
    for a in ["Time", "Amount", "V1", "V2", "V3"])

ORACLE["histogram"] = "WITH " + TXN_SQL + """,
mm AS (SELECT min(score) AS lo0, max(score) AS hi0, count(score) AS nn FROM transactions),
b AS (SELECT CAST(CASE WHEN hi0 = lo0 THEN 0 ELSE least(floor((score - lo0) / (hi0 - lo0) * 10), 9) END AS BIGINT) AS bin
      FROM transactions, mm WHERE score IS NOT NULL),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin),
allb AS (SELECT CAST(unnest(range(0, 10)) AS BIGINT) AS bin, lo0, hi0, nn FROM mm)
SELECT a.bin, round(lo0 + a.bin * ((hi0 - lo0) / 10), 6) AS lo, round(lo0 + (a.bin + 1) * ((hi0 - lo0) / 10), 6) AS hi,
       CAST(coalesce(n, 0) AS BIGINT) AS n, round(coalesce(n, 0) / (nn * ((hi0 - lo0) / 10)), 6) AS density
FROM allb a LEFT JOIN c USING (bin)"""

ORACLE["box_stats"] = "WITH " + TXN_SQL + """,
l AS (UNPIVOT (SELECT "Class", "Amount", "V3" FROM transactions) ON "Amount", "V3" INTO NAME feature VALUE value),
q AS (SELECT feature, "Class", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM l GROUP BY ALL),
j AS (SELECT l.*, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS hf FROM l JOIN q USING (feature, "Class"))
SELECT feature, "Class", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(min(value) FILTER (WHERE value >= lf AND value <= hf), 6) AS whisker_lo,
       round(max(value) FILTER (WHERE value >= lf AND value <= hf), 6) AS whisker_hi,
       CAST(count(*) FILTER (WHERE NOT (value >= lf AND value <= hf)) AS BIGINT) AS n_outliers
FROM j GROUP BY feature, "Class", q1, median, q3"""

ORACLE["error_by_decile"] = "WITH " + TXN_SQL + _qcut_sql("Amount") + """,
e AS (SELECT bin, "Class" AS y, CAST(score >= 0.5 AS INTEGER) AS p FROM qbb)
SELECT CAST(bin AS BIGINT) AS bin, CAST(count(*) AS BIGINT) AS n, round(avg(y), 6) AS fraud_rate,
       round(count(*) FILTER (WHERE p = 1 AND y = 1) / greatest(count(*) FILTER (WHERE p = 1), 1), 6) AS precision,
       round(count(*) FILTER (WHERE p = 1 AND y = 1) / greatest(count(*) FILTER (WHERE y = 1), 1), 6) AS recall,
       CAST(count(*) FILTER (WHERE p = 1 AND y = 0) AS BIGINT) AS fp,
       CAST(count(*) FILTER (WHERE p = 0 AND y = 1) AS BIGINT) AS fn FROM e GROUP BY bin"""

ORACLE["score_summary"] = "WITH " + TXN_SQL + """
SELECT round(min(score), 6) AS score_min, round(max(score), 6) AS score_max, round(avg(score), 6) AS score_mean,
       round(avg("Class"), 6) AS base_rate FROM transactions"""


# --- payloads ------------------------------------------------------------------------

from vigil.sources.fixtures import REQUEST_ID_SPELLINGS  # noqa: E402

_REQ = """
li AS (SELECT l.*, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
              l_extendedprice, l_discount, l_tax, l_quantity) - 1 AS idx
       FROM lineitem l WHERE l_orderkey IN (SELECT o_orderkey FROM orders))"""

ORACLE["parse_requests"] = "WITH " + _REQ + """
SELECT l_orderkey AS request_key, CAST(idx AS BIGINT) AS record_idx, round(CAST(l_linenumber AS DOUBLE), 6) AS row_id,
       round(l_extendedprice, 6) AS "Amount", round(l_discount, 6) AS "V1", round(l_tax, 6) AS "V2",
       round(l_quantity, 6) AS "V3",
       CAST(CASE l_orderkey % 6 WHEN 0 THEN coalesce(nullif(l_orderkey % 3, 0), 3) WHEN 1 THEN l_orderkey % 4
                                WHEN 2 THEN 2 END AS DOUBLE) AS max_alerts
FROM li"""

ORACLE["request_responses"] = "WITH " + _REQ + """,
s AS (SELECT l_orderkey AS k, idx AS pos, CAST(l_linenumber AS DOUBLE) AS row_id, (CAST(floor(l_extendedprice) AS BIGINT) % 1000) / 1000 AS p,
             greatest(coalesce(CASE l_orderkey % 6 WHEN 0 THEN coalesce(nullif(l_orderkey % 3, 0), 3) WHEN 1 THEN l_orderkey % 4 WHEN 2 THEN 2 END, 100), 0) AS cap,
             count(*) OVER (PARTITION BY l_orderkey) AS n FROM li),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY p DESC, pos) AS rnk, least(cap, n) AS kk FROM s)
SELECT k AS request_key, CAST(pos AS BIGINT) AS pos, CAST(rnk <= kk AS BIGINT) AS predicted_label, round(p, 6) AS probability, CAST(rnk AS BIGINT) AS rank,
       row_id, round(coalesce(min(p) FILTER (WHERE rnk <= kk) OVER (PARTITION BY k), 1.0), 6) AS threshold_used, CAST(cap AS BIGINT) AS max_alerts,
       CAST(kk AS BIGINT) AS num_alerts FROM r"""

ORACLE["request_states"] = """
WITH o AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
t(m, state, max_alerts, record_idx, row_id, amount, v1) AS (VALUES
  (0, 'not_json', NULL, NULL, NULL, NULL, NULL), (1, 'bad_shape', NULL, NULL, NULL, NULL, NULL), (2, 'bad_cap', NULL, NULL, NULL, NULL, NULL),
  (3, 'ok', NULL, 0, 'x1', 7.0, NULL), (4, 'ok', NULL, 0, 'y', 1.5, NULL), (4, 'ok', NULL, 1, NULL, 2.0, NULL), (5, 'empty', NULL, NULL, NULL, NULL, NULL),
  (6, 'ok', NULL, 0, 'u', 1.0, 9.0), (6, 'ok', NULL, 1, '2', 4.0, 9.0))
SELECT k AS request_key, state, CAST(max_alerts AS DOUBLE) AS max_alerts, CAST(record_idx AS BIGINT) AS record_idx, row_id,
       CAST(amount AS DOUBLE) AS amount, CAST(v1 AS DOUBLE) AS v1 FROM o JOIN t ON t.m = k % 7"""

ORACLE["request_id"] = """
SELECT o_orderkey AS request_key,
       CASE WHEN o_orderkey % 6 <= 2 AND o_orderkey % 5 < 4 THEN 'req-' || CAST(o_orderkey AS VARCHAR)
            ELSE md5(CAST(o_orderkey AS VARCHAR) || ':request') END AS request_id
FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)"""

_RESP = _PER_BATCH + """,
rp AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY txn_id) - 1 AS pos, batch_id % 5 AS shape FROM g)"""

ORACLE["parse_responses"] = "WITH " + _RESP + """
SELECT CAST(batch_id AS BIGINT) AS batch_id, CAST(pos AS BIGINT) AS pos, CAST(alert AS BIGINT) AS prediction,
       round(CASE WHEN shape = 1 THEN NULL ELSE score END, 6) AS probability,
       round(CASE WHEN shape IN (2, 3, 4) THEN threshold END, 6) AS threshold_used,
       CAST(CASE WHEN shape IN (2, 4) THEN max_alerts END AS DOUBLE) AS max_alerts,
       CAST(CASE WHEN shape IN (2, 4) THEN sum(alert) OVER (PARTITION BY batch_id) END AS DOUBLE) AS num_alerts
FROM rp"""

ORACLE["response_merge"] = "WITH " + _RESP + """,
pb AS (SELECT batch_id, count(*) AS n, sum(alert) AS alerts, bool_and(shape <> 1) AS hp,
              min(CASE WHEN shape IN (2, 3, 4) THEN threshold END) AS t,
              min(CASE WHEN shape IN (2, 4) THEN max_alerts END) AS m,
              CASE WHEN min(shape) IN (2, 4) THEN sum(alert) END AS c FROM rp GROUP BY batch_id)
SELECT CAST(sum(n) AS BIGINT) AS n_predictions, CAST(sum(alerts) AS BIGINT) AS total_alerts,
       bool_and(hp) AS probabilities_available,
       round(arg_min(t, batch_id) FILTER (WHERE t IS NOT NULL), 6) AS threshold_used,
       CAST(arg_min(m, batch_id) FILTER (WHERE m IS NOT NULL) AS BIGINT) AS max_alerts,
       CAST(arg_min(c, batch_id) FILTER (WHERE c IS NOT NULL) AS BIGINT) AS num_alerts FROM pb"""


# --- scans ------------------------------------------------------------------------------

ORACLE["csv_scan"] = "WITH " + TXN_SQL + """
SELECT txn_id, round("Time", 6) AS "Time", round("Amount", 6) AS "Amount", round("V1", 6) AS "V1",
       round("V2", 6) AS "V2", round("V3", 6) AS "V3", "Class", round(score, 6) AS score FROM transactions"""

ORACLE["file_union"] = "WITH " + TXN_SQL + """
SELECT txn_id, round("Amount", 6) AS "Amount",
       round(CASE WHEN txn_id >= '8' AND "Class" = 0 THEN NULL ELSE "V3" END, 6) AS "V3", "Class" FROM transactions"""

ORACLE["head_sample"] = "WITH " + TXN_SQL + """
SELECT txn_id, round("Amount", 6) AS "Amount" FROM transactions ORDER BY txn_id LIMIT 1000"""

ORACLE["descriptor_scan"] = "WITH " + TXN_SQL + """
SELECT txn_id, round("Amount", 6) AS "Amount", "Class" FROM transactions"""

ORACLE["asset_lookup"] = "WITH " + TXN_SQL + """
SELECT txn_id, round("Amount", 6) AS "Amount" FROM transactions WHERE txn_id < '8'"""


# --- streaming and pipelines --------------------------------------------------------------

ORACLE["stream_alerts"] = """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS window_day, event_id, round(value, 6) AS value,
       CAST(rn AS BIGINT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY date_trunc('day', ts) ORDER BY value DESC, event_id) AS rn
      FROM events WHERE value IS NOT NULL) WHERE rn <= 5"""

ORACLE["stream_drift"] = f"""
WITH evf AS (SELECT ts, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
evl AS (SELECT ts, feature, v FROM (UNPIVOT evf ON value, k INTO NAME feature VALUE v)
        WHERE v IS NOT NULL AND NOT isnan(v)),
refl AS (SELECT * FROM evl WHERE ts < TIMESTAMP '2024-01-08 00:00:00'),
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, {_PROBS10}))) AS e FROM refl GROUP BY feature),
bl AS (SELECT l.ts, l.feature, len(list_filter(g.e, lambda x: x <= l.v)) AS bin FROM evl l JOIN edges g USING (feature)),
refc AS (SELECT feature, bin, count(*) AS nr FROM bl WHERE ts < TIMESTAMP '2024-01-08 00:00:00' GROUP BY ALL),
curc AS (SELECT date_trunc('day', ts) AS d, feature, bin, count(*) AS nc FROM bl GROUP BY ALL),
grid AS (SELECT d, feature, unnest(range(0, len(e) + 1)) AS bin FROM (SELECT DISTINCT d FROM curc), edges),
fullb AS (SELECT g.d, g.feature, g.bin, coalesce(nr, 0) AS nr, coalesce(nc, 0) AS nc
          FROM grid g LEFT JOIN refc r USING (feature, bin) LEFT JOIN curc c USING (d, feature, bin)),
sh AS (SELECT *, greatest(nr / sum(nr) OVER (PARTITION BY d, feature), 1e-6) AS rs,
              greatest(nc / sum(nc) OVER (PARTITION BY d, feature), 1e-6) AS cs FROM fullb),
nm AS (SELECT *, rs / sum(rs) OVER (PARTITION BY d, feature) AS rn, cs / sum(cs) OVER (PARTITION BY d, feature) AS cn
       FROM sh)
SELECT strftime(d, '%Y-%m-%d') AS window_day, feature, round(sum((rn - cn) * ln(rn / cn)), 6) AS psi,
       CAST(sum(nc) AS BIGINT) AS n FROM nm GROUP BY d, feature"""

ORACLE["data_pipeline"] = "WITH " + _SPLIT + """
SELECT CAST(count(*) FILTER (WHERE NOT is_test) AS BIGINT) AS train_rows,
       CAST(count(*) FILTER (WHERE is_test) AS BIGINT) AS test_rows, 'Class' AS label_column,
       CAST(42 AS BIGINT) AS seed, 0.1::DOUBLE AS test_ratio, true AS validation_passed, 'completed' AS status FROM sp"""


def per_batch_cte(src: str) -> str:
    return f""",
b AS (SELECT *, (row_number() OVER (ORDER BY txn_id) - 1) // 200 AS batch_id FROM {src}),
c AS (SELECT *, count(*) OVER (PARTITION BY batch_id) AS batch_rows FROM b),
d AS (SELECT *, CAST(ceil(CAST(0.1 AS DOUBLE) * batch_rows) AS BIGINT) AS max_alerts FROM c),
e AS (SELECT *, least(max_alerts, batch_rows) AS k,
             row_number() OVER (PARTITION BY batch_id ORDER BY score DESC, txn_id) AS rnk FROM d),
f AS (SELECT *, CAST(rnk <= k AS BIGINT) AS alert FROM e),
g AS (SELECT *, CASE WHEN k > 0 THEN min(CASE WHEN alert = 1 THEN score END) OVER (PARTITION BY batch_id)
                     ELSE 1.0 END AS threshold FROM f)"""


_EVAL_SQL = """,
ek AS (SELECT count(*) FILTER (WHERE "Class" = 0 AND alert = 0) AS tn, count(*) FILTER (WHERE "Class" = 0 AND alert = 1) AS fp,
              count(*) FILTER (WHERE "Class" = 1 AND alert = 0) AS fn, count(*) FILTER (WHERE "Class" = 1 AND alert = 1) AS tp,
              count(*) AS n, sum(alert) AS pred_sum FROM g),
ecd AS (SELECT score AS thr, count(*) FILTER (WHERE "Class" = 1) AS pos, count(*) FILTER (WHERE "Class" <> 1) AS neg
        FROM g GROUP BY score),
ecv AS (SELECT pos, neg, sum(pos) OVER (ORDER BY thr DESC) AS tp, sum(neg) OVER (ORDER BY thr DESC) AS fp,
               sum(pos) OVER () AS tot_p, sum(neg) OVER () AS tot_n FROM ecd),
evals AS (
  SELECT 'metrics.accuracy' AS metric, """ + _d0('tp + tn', 'n') + """ AS value FROM ek
  UNION ALL SELECT 'metrics.precision', """ + _d0('tp', 'tp + fp') + """ FROM ek
  UNION ALL SELECT 'metrics.recall', """ + _d0('tp', 'tp + fn') + """ FROM ek
  UNION ALL SELECT 'metrics.f1', """ + _d0('2 * tp', '2 * tp + fp + fn') + """ FROM ek
  UNION ALL SELECT 'metrics.alert_rate', CASE WHEN n > 0 THEN pred_sum / n END FROM ek
  UNION ALL SELECT 'metrics.alert_count', CASE WHEN n > 0 THEN CAST(pred_sum AS DOUBLE) END FROM ek
  UNION ALL SELECT 'metrics.roc_auc', (SELECT sum(pos * (tot_n - fp + neg / 2.0)) / (max(tot_p) * max(tot_n)) FROM ecv)
  UNION ALL SELECT 'metrics.pr_auc', (SELECT sum(pos * (tp / (tp + fp))) / max(tot_p) FROM ecv))"""

ORACLE["evaluation"] = "WITH " + TXN_SQL + per_batch_cte("transactions") + _EVAL_SQL + """
SELECT metric, round(value, 6) AS value FROM evals"""

ORACLE["monitor"] = "WITH " + _REPORT_CTE + per_batch_cte("cur") + _EVAL_SQL + """,
b0 AS (SELECT min(threshold) AS t, min(max_alerts) AS m, sum(alert) AS c FROM g WHERE batch_id = 0),
summ AS (SELECT max(psi) AS psi_max, avg(psi) AS psi_mean, count(*) FILTER (WHERE psi_exceeds) AS pe,
                max(ks) AS ks_max, avg(ks) AS ks_mean, count(*) FILTER (WHERE ks_exceeds) AS ke FROM report),
allm AS (
  SELECT metric, value FROM evals
  UNION ALL SELECT 'metrics.threshold_used', t FROM b0
  UNION ALL SELECT 'metrics.max_alerts', CAST(m AS DOUBLE) FROM b0
  UNION ALL SELECT 'metrics.num_alerts', CAST(c AS DOUBLE) FROM b0
  UNION ALL SELECT 'drift.psi_max', psi_max FROM summ
  UNION ALL SELECT 'drift.psi_mean', psi_mean FROM summ
  UNION ALL SELECT 'drift.psi_exceeded_count', CAST(pe AS DOUBLE) FROM summ
  UNION ALL SELECT 'drift.ks_max', ks_max FROM summ
  UNION ALL SELECT 'drift.ks_mean', ks_mean FROM summ
  UNION ALL SELECT 'drift.ks_exceeded_count', CAST(ke AS DOUBLE) FROM summ
  UNION ALL SELECT 'drift.detected', CASE WHEN pe > 0 OR ke > 0 THEN 1.0 ELSE 0.0 END FROM summ)
SELECT metric, round(value, 6) AS value FROM allm WHERE value IS NOT NULL"""

ORACLE["promote_pipeline"] = ORACLE["promotion"].rsplit("SELECT name, metric", 1)[0] + """
SELECT decision, reason, CAST(count(*) AS BIGINT) AS n FROM e GROUP BY decision, reason"""


ORACLE["eval_at_threshold"] = "WITH " + _SPLIT + """,
cd AS (SELECT score AS thr, count(*) FILTER (WHERE "Class" = 1) AS pos, count(*) FILTER (WHERE "Class" <> 1) AS neg
       FROM sp WHERE NOT is_test GROUP BY score),
cv AS (SELECT thr, sum(pos) OVER (ORDER BY thr DESC) AS tp, sum(neg) OVER (ORDER BY thr DESC) AS fp,
              sum(pos) OVER () AS tot_p FROM cd),
pr AS (SELECT thr, tp / (tp + fp) AS prec, CASE WHEN tot_p > 0 THEN tp / tot_p ELSE 1.0 END AS rec FROM cv),
best AS (SELECT thr FROM (SELECT thr, 2 * prec * rec / (prec + rec + 1e-12) AS f1 FROM pr) ORDER BY f1 DESC, thr LIMIT 1),
scored AS (SELECT "Class", CAST(score >= (SELECT thr FROM best) AS INTEGER) AS pred FROM sp WHERE is_test),""" + _K + f""",
r AS (SELECT {_d0('tp', 'tp + fp')} AS p1, {_d0('tp', 'tp + fn')} AS r1, {_d0('tn', 'tn + fn')} AS p0,
             {_d0('tn', 'tn + fp')} AS r0, {_d0('2 * tp', '2 * tp + fp + fn')} AS f1, {_d0('2 * tn', '2 * tn + fn + fp')} AS f0,
             CAST(tp + fn AS DOUBLE) AS s1, CAST(tn + fp AS DOUBLE) AS s0, CAST(n AS DOUBLE) AS n,
             {_d0('tp + tn', 'n')} AS acc, round((SELECT thr FROM best), 6) AS threshold FROM k)
SELECT '0' AS label, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1_score, round(s0, 6) AS support, threshold FROM r
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), round(s1, 6), threshold FROM r
UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), round(n, 6), threshold FROM r
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), round(n, 6), threshold FROM r
UNION ALL SELECT 'weighted avg', round({_d0('p0 * s0 + p1 * s1', 'n')}, 6), round({_d0('r0 * s0 + r1 * s1', 'n')}, 6),
                 round({_d0('f0 * s0 + f1 * s1', 'n')}, 6), round(n, 6), threshold FROM r"""

ORACLE["kernel_density"] = "WITH " + TXN_SQL + """,
st AS (SELECT min("Amount") AS lo, max("Amount") AS hi, stddev_samp("Amount") AS sd, count(*) AS n,
              stddev_samp("Amount") * pow(count(*), -1.0 / 5) AS h FROM transactions),
g AS (SELECT i AS point, lo + i * ((hi - lo) / 49) AS x FROM st, range(0, 50) r(i)),
k AS (SELECT g.point, g.x, sum(exp(-0.5 * pow((g.x - t."Amount") / st.h, 2))) AS s
      FROM g, transactions t, st GROUP BY g.point, g.x)
SELECT CAST(point AS BIGINT) AS point, round(x, 6) AS x,
       round(s / ((SELECT n FROM st) * (SELECT h FROM st) * sqrt(2 * pi())) * 1e6, 6) AS density_e6 FROM k"""

ORACLE["drift_job"] = "WITH " + _REPORT_CTE + """,
summ AS (SELECT max(psi) AS psi_max, avg(psi) AS psi_mean, count(*) FILTER (WHERE psi_exceeds) AS pe,
                max(ks) AS ks_max, avg(ks) AS ks_mean, count(*) FILTER (WHERE ks_exceeds) AS ke FROM report),
allm AS (
  SELECT 'drift.psi_max' AS metric, psi_max AS value FROM summ
  UNION ALL SELECT 'drift.psi_mean', psi_mean FROM summ
  UNION ALL SELECT 'drift.psi_exceeded_count', CAST(pe AS DOUBLE) FROM summ
  UNION ALL SELECT 'drift.ks_max', ks_max FROM summ
  UNION ALL SELECT 'drift.ks_mean', ks_mean FROM summ
  UNION ALL SELECT 'drift.ks_exceeded_count', CAST(ke AS DOUBLE) FROM summ
  UNION ALL SELECT 'drift.detected', CASE WHEN pe > 0 OR ke > 0 THEN 1.0 ELSE 0.0 END FROM summ)
SELECT 'drift-run' AS run_id, metric, round(value, 6) AS value FROM allm WHERE value IS NOT NULL"""

ORACLE["corr_head_tail"] = "WITH " + TXN_SQL + ",\ntc AS (" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS feature, corr({_q(a)}, \"Class\") AS r FROM transactions"
    for a in ["Time", "Amount", "V1", "V2", "V3"]) + """),
h AS (SELECT 'head' AS "end", row_number() OVER (ORDER BY r DESC, feature) AS position, feature, r FROM tc),
t AS (SELECT 'tail' AS "end", row_number() OVER (ORDER BY r ASC, feature) AS position, feature, r FROM tc)
SELECT "end", CAST(position AS BIGINT) AS position, feature, round(r, 6) AS r FROM h WHERE position <= 2
UNION ALL SELECT "end", CAST(position AS BIGINT), feature, round(r, 6) FROM t WHERE position <= 2"""
