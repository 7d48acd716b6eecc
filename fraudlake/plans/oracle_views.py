"""More DuckDB views for the oracle: scoring chain, splits, evaluation."""

from __future__ import annotations

from fraudlake.operators.score import SCORECARD_METADATA, SCORECARD_WEIGHTS, scorecard_sql
from fraudlake.plans.oracle import add_view

D = "CAST({} AS DOUBLE)".format

add_view(
    "scorable",
    "SELECT * FROM bronze WHERE type IN ('CASH_OUT','TRANSFER')",
    ["bronze"],
)

# brute force: earlier arrivals of the destination with step in [step-24, step]
add_view(
    "fan_arrival",
    """SELECT s.*, CAST((SELECT count(*) FROM scorable p
        WHERE p.nameDest = s.nameDest AND p.step BETWEEN s.step - 24 AND s.step AND p.seq < s.seq) AS BIGINT)
        AS fan_in_dest_count_24h
       FROM scorable s""",
    ["scorable"],
)

FEATURE_SQL = """amount,
  CAST(oldbalanceOrg > 0 AS DOUBLE) AS has_balance_orig,
  oldbalanceOrg - newbalanceOrig AS balance_delta_orig,
  oldbalanceOrg - newbalanceOrig - amount AS error_balance_orig,
  CAST(oldbalanceDest > 0 AS DOUBLE) AS has_balance_dest,
  newbalanceDest - oldbalanceDest AS balance_delta_dest,
  oldbalanceDest + amount - newbalanceDest AS error_balance_dest,
  CAST(coalesce(isFlaggedFraud, 0) AS DOUBLE) AS is_flagged_fraud"""

add_view(
    "scored_live",
    f"""SELECT *, {scorecard_sql()} AS fraud_probability FROM (
          SELECT seq, step, type, nameOrig, nameDest, oldbalanceOrg, newbalanceOrig, oldbalanceDest,
                 newbalanceDest, isFraud, isFlaggedFraud, ingested_at, {FEATURE_SQL},
                 CAST(coalesce(fan_in_dest_count_24h, 0) AS DOUBLE) AS fan_in_dest_count_24h,
                 fan_in_dest_count_24h AS fan_in_raw
          FROM fan_arrival)""",
    ["fan_arrival"],
)

THR = SCORECARD_METADATA["decision_threshold"]
VERSION = f"{SCORECARD_METADATA['phase']}-t{SCORECARD_METADATA['num_trees']}"

add_view(
    "chain",
    f"""SELECT seq, type, step, nameDest, status,
          CASE WHEN status IN ('scored','score_error') THEN fan_in_dest_count_24h END AS fan_in_dest_count_24h,
          fraud_probability,
          coalesce(fraud_probability >= {D(THR)}, false) AS is_alert,
          CASE WHEN status IN ('scored','score_error') THEN {D(THR)} END AS threshold,
          CASE WHEN status IN ('scored','score_error') THEN '{VERSION}' END AS model_version
        FROM (
          SELECT seq, type, step, nameDest, fan_in_dest_count_24h, fraud_probability,
                 CASE WHEN fraud_probability IS NULL THEN 'score_error' ELSE 'scored' END AS status
          FROM scored_live
          UNION ALL
          SELECT seq, type, step, nameDest, NULL, NULL,
                 CASE WHEN len(reasons) > 0 THEN 'dq_rejected' ELSE 'skipped' END
          FROM reasoned WHERE len(reasons) > 0 OR type NOT IN ('CASH_OUT','TRANSFER'))""",
    ["scored_live", "reasoned"],
)

# --- training extract, split, scored test set ------------------------------------

add_view(
    "extract",
    """SELECT amount, has_balance_orig, balance_delta_orig, error_balance_orig, has_balance_dest,
          balance_delta_dest, error_balance_dest, is_flagged_fraud, fan_in_dest_count_24h, step, is_fraud, seq
       FROM gold WHERE type IN ('CASH_OUT','TRANSFER')""",
    ["gold"],
)
add_view("cut", "SELECT quantile_cont(step, 0.8) AS split_step FROM extract", ["extract"])
add_view(
    "labelled",
    "SELECT e.*, CASE WHEN e.step <= c.split_step THEN 'train' ELSE 'test' END AS split FROM extract e, cut c",
    ["extract", "cut"],
)


add_view(
    "valid_cut",
    "SELECT quantile_cont(step, 0.8) AS valid_step FROM extract WHERE step <= (SELECT split_step FROM cut)",
    ["extract", "cut"],
)


def scored_test_sql(weights=SCORECARD_WEIGHTS) -> str:
    return f"SELECT *, {scorecard_sql(weights)} AS score, is_fraud AS label FROM labelled WHERE split = 'test'"


def counts_sql(rows: str) -> str:
    return f"""SELECT score, CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
          CAST(sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS BIGINT) AS fp
       FROM {rows} GROUP BY score"""


def curve_sql(counts: str) -> str:
    return f"""SELECT score, tp, fp,
          CAST(sum(tp) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_tp,
          CAST(sum(fp) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_fp,
          (SELECT CAST(sum(tp) AS BIGINT) FROM {counts}) AS P,
          (SELECT CAST(sum(fp) AS BIGINT) FROM {counts}) AS N,
          (SELECT coalesce(sum(tp * fp), 0) FROM {counts} WHERE score IS NULL) AS U
       FROM {counts} WHERE score IS NOT NULL"""


PR_SQL = """SELECT score AS threshold,
          CAST(cum_tp AS DOUBLE) / CAST(cum_tp + cum_fp AS DOUBLE) AS precision,
          CAST(cum_tp AS DOUBLE) / CAST(P AS DOUBLE) AS recall, cum_tp, cum_fp
       FROM {}"""

add_view("test_scored", scored_test_sql(), ["labelled"])
add_view("score_counts", counts_sql("test_scored"), ["test_scored"])
add_view("curve", curve_sql("score_counts"), ["score_counts"])
add_view(
    "valid_scored",
    f"SELECT *, {scorecard_sql(SCORECARD_WEIGHTS)} AS score, is_fraud AS label FROM labelled WHERE split = 'train' AND step > (SELECT valid_step FROM valid_cut)",
    ["labelled", "valid_cut"],
)
add_view("valid_counts", counts_sql("valid_scored"), ["valid_scored"])
add_view("valid_curve", curve_sql("valid_counts"), ["valid_counts"])
add_view("valid_pr", PR_SQL.format("valid_curve"), ["valid_curve"])
add_view("pr", PR_SQL.format("curve"), ["curve"])
add_view(
    "best",
    """SELECT threshold, precision, recall,
          (CAST(2 AS DOUBLE) * precision * recall) / (precision + recall + CAST(1e-10 AS DOUBLE)) AS f1
       FROM valid_pr ORDER BY f1 DESC, threshold ASC LIMIT 1""",
    ["valid_pr"],
)
add_view(
    "cm",
    """SELECT CAST(sum(CASE WHEN NOT coalesce(score >= b.threshold, false) AND label <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
          CAST(sum(CASE WHEN score >= b.threshold AND label <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
          CAST(sum(CASE WHEN NOT coalesce(score >= b.threshold, false) AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
          CAST(sum(CASE WHEN score >= b.threshold AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp
       FROM test_scored, best b""",
    ["test_scored", "best"],
)
add_view(
    "metric_points",
    """SELECT ts, CASE event_type WHEN 'error' THEN 'ScorerErrorCount' WHEN 'purchase' THEN 'FraudAlertCount'
          WHEN 'view' THEN 'ConsumerHeartbeat' WHEN 'click' THEN 'ScoredTransactions' ELSE event_type END AS metric,
          CAST(1 AS BIGINT) AS value
       FROM events""",
    [],
)
