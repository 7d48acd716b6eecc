"""DuckDB SQL twins of the fixture views and registered queries.

These strings are the independent oracle: they are written in plain SQL over
the driver's tables and never call into the Spark code.
"""

from __future__ import annotations

from fraudlake.functions.alias import account_alias_duckdb
from fraudlake.sources.fixtures import FIXTURE_PEPPER

VIEWS: dict[str, str] = {}

VIEWS["transactions"] = """
SELECT event_id AS seq,
  CAST((day(ts)-1)*24 + hour(ts) + 1 AS INTEGER) AS step,
  CASE event_type WHEN 'purchase' THEN 'CASH_OUT' WHEN 'error' THEN 'TRANSFER'
       WHEN 'view' THEN 'PAYMENT' WHEN 'click' THEN 'CASH_IN' ELSE 'DEBIT' END AS type,
  CASE WHEN event_id%103=0 THEN NULL WHEN event_id%101=0 THEN -value ELSE value END AS amount,
  'C'||lpad(CAST(event_id AS VARCHAR),9,'0') AS nameOrig,
  CASE WHEN event_id%3=0 THEN CAST(0 AS DOUBLE) ELSE value*(event_id%7+1) END AS oldbalanceOrg,
  CASE WHEN event_id%3=0 OR event_id%13=0 THEN CAST(0 AS DOUBLE) ELSE value*(event_id%7) END AS newbalanceOrig,
  CASE WHEN event_id%107=0 THEN NULL ELSE 'C'||lpad(CAST(user_id AS VARCHAR),9,'0') END AS nameDest,
  CASE WHEN event_id%113=0 THEN NULL ELSE value*(event_id%5) END AS oldbalanceDest,
  CASE WHEN event_id%109=0 THEN CAST(-1 AS DOUBLE) WHEN event_id%13=0 THEN CAST(0 AS DOUBLE)
       ELSE value*(event_id%5+1) END AS newbalanceDest,
  CAST(CASE WHEN event_type IN ('purchase','error') AND event_id%13=0 THEN 1 ELSE 0 END AS INTEGER) AS isFraud,
  CAST(CASE WHEN event_id%997=0 THEN 1 ELSE 0 END AS INTEGER) AS isFlaggedFraud,
  ts AS ingested_at
FROM events
"""

REJECTED_PREDICATE = """(step IS NULL OR type IS NULL OR amount IS NULL OR nameOrig IS NULL OR nameDest IS NULL
 OR coalesce(amount<0,false) OR coalesce(oldbalanceOrg<0,false) OR coalesce(newbalanceOrig<0,false)
 OR coalesce(oldbalanceDest<0,false) OR coalesce(newbalanceDest<0,false))"""

VIEWS["reasoned"] = """
SELECT *, list_filter([
  CASE WHEN step IS NULL THEN 'missing or null required field: step' END,
  CASE WHEN type IS NULL THEN 'missing or null required field: type' END,
  CASE WHEN amount IS NULL THEN 'missing or null required field: amount' END,
  CASE WHEN nameOrig IS NULL THEN 'missing or null required field: nameOrig' END,
  CASE WHEN nameDest IS NULL THEN 'missing or null required field: nameDest' END,
  CASE WHEN coalesce(amount<0,false) THEN 'negative amount' END,
  CASE WHEN coalesce(oldbalanceOrg<0,false) THEN 'negative balance: oldbalanceOrg' END,
  CASE WHEN coalesce(newbalanceOrig<0,false) THEN 'negative balance: newbalanceOrig' END,
  CASE WHEN coalesce(oldbalanceDest<0,false) THEN 'negative balance: oldbalanceDest' END,
  CASE WHEN coalesce(newbalanceDest<0,false) THEN 'negative balance: newbalanceDest' END
], lambda x: x IS NOT NULL) AS reasons
FROM transactions
"""

VIEWS["bronze"] = f"SELECT * FROM transactions WHERE NOT {REJECTED_PREDICATE}"

VIEWS["erasure_requests"] = """
SELECT 'C'||lpad(CAST(user_id AS VARCHAR),9,'0') AS account_id,
       'req-'||CAST(min(event_id) AS VARCHAR) AS request_id,
       min(ts) AS requested_ts
FROM events WHERE user_id%10=0 GROUP BY user_id
UNION ALL
SELECT 'C'||lpad(CAST(user_id AS VARCHAR),9,'0'), 'req-dup-'||CAST(min(event_id) AS VARCHAR),
       min(ts) + INTERVAL 1 HOUR
FROM events WHERE user_id%20=0 GROUP BY user_id
"""

ISO_SQL = "strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"

VIEWS["registry"] = f"""
SELECT account_id, {account_alias_duckdb('account_id', FIXTURE_PEPPER)} AS account_alias,
       request_id, {ISO_SQL.format(ts='requested_ts')} AS requested_at
FROM erasure_requests
WHERE regexp_full_match(account_id, '^[A-Za-z][0-9]{{2,31}}$')
"""

VIEWS["alias_map"] = "SELECT account_id, min(account_alias) AS account_alias FROM registry GROUP BY account_id"

VIEWS["masked"] = """
SELECT t.*, coalesce(g1.account_alias, t.nameOrig) AS name_orig, coalesce(g2.account_alias, t.nameDest) AS name_dest
FROM bronze t
LEFT JOIN alias_map g1 ON t.nameOrig = g1.account_id
LEFT JOIN alias_map g2 ON t.nameDest = g2.account_id
"""

VIEWS["silver"] = """
SELECT step, type, amount, name_orig,
  oldbalanceOrg AS old_balance_orig, newbalanceOrig AS new_balance_orig, name_dest,
  oldbalanceDest AS old_balance_dest, newbalanceDest AS new_balance_dest,
  isFraud AS is_fraud, isFlaggedFraud AS is_flagged_fraud, ingested_at,
  oldbalanceOrg - newbalanceOrig AS balance_delta_orig,
  newbalanceDest - oldbalanceDest AS balance_delta_dest,
  oldbalanceOrg - newbalanceOrig - amount AS error_balance_orig,
  oldbalanceDest + amount - newbalanceDest AS error_balance_dest,
  CAST(oldbalanceOrg > 0 AS INTEGER) AS has_balance_orig,
  CAST(oldbalanceDest > 0 AS INTEGER) AS has_balance_dest,
  COUNT(*) OVER (PARTITION BY name_dest ORDER BY step RANGE BETWEEN 24 PRECEDING AND CURRENT ROW) - 1
    AS fan_in_dest_count_24h,
  seq
FROM masked
"""

VIEWS["gold"] = """
SELECT amount, has_balance_orig, balance_delta_orig, error_balance_orig, has_balance_dest,
  balance_delta_dest, error_balance_dest, is_flagged_fraud, fan_in_dest_count_24h, step, is_fraud, type, seq
FROM silver
"""

def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies included)."""
    needed: list[str] = []
    deps = {
        "reasoned": ["transactions"],
        "bronze": ["transactions"],
        "registry": ["erasure_requests"],
        "alias_map": ["registry"],
        "masked": ["bronze", "alias_map"],
        "silver": ["masked"],
        "gold": ["silver"],
    }
    deps.update(EXTRA_DEPS)

    def add(n: str) -> None:
        for d in deps.get(n, []):
            add(d)
        if n not in needed:
            needed.append(n)

    for n in names:
        add(n)
    if not needed:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed)
    return f"WITH {ctes}\n{body}"


EXTRA_DEPS: dict[str, list[str]] = {}


def add_view(name: str, sql: str, deps: list[str]) -> None:
    VIEWS[name] = sql
    EXTRA_DEPS[name] = deps
