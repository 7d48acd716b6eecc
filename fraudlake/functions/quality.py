"""Quality rules and message contracts as column expressions.

Every rule is (name, condition, message); rule sets fold into one boolean or
one ordered array of messages, evaluated in a single projection. JSON contract
checks parse each raw message once into a VARIANT and read field kinds from it,
so the checks stay inside the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.schemas import (
    ACCOUNT_ID_PATTERN,
    ALERT_KINDS,
    BALANCE_FIELDS,
    CONTRACT_KINDS,
    MSG_MISSING,
    MSG_MISSING_FIELD,
    MSG_NEGATIVE_AMOUNT,
    MSG_NEGATIVE_BALANCE,
    MSG_NOT_OBJECT_ALERT,
    MSG_NOT_OBJECT_TXN,
    MSG_UNKNOWN_TYPE,
    MSG_WRONG_KIND,
    REQUIRED_FIELDS,
    TXN_TYPES,
)


def compact(items: list[Column]) -> Column:
    """Array of the non-NULL items, in order.

    The messages of one rule set are distinct, so ``array_except`` against
    ``[NULL]`` equals a null filter, and unlike a lambda ``filter`` it stays in
    whole-stage codegen."""
    return F.array_except(F.array(*items), F.array(F.lit(None).cast("string")))


def _negative(field: str) -> Column:
    # a null value is not a violation of the sign rule (it is not negative)
    return F.coalesce(F.col(field) < F.lit(0), F.lit(False))


def dq_rules(
    required=REQUIRED_FIELDS, balances=BALANCE_FIELDS
) -> list[tuple[str, Column, str]]:
    """Ordered (name, violated, message) rules of the Bronze quality gate."""
    rules = [(f"null_{f}", F.col(f).isNull(), MSG_MISSING.format(field=f)) for f in required]
    rules.append(("negative_amount", _negative("amount"), MSG_NEGATIVE_AMOUNT))
    rules += [(f"negative_{f}", _negative(f), MSG_NEGATIVE_BALANCE.format(field=f)) for f in balances]
    return rules


def dq_rules_sql(required=REQUIRED_FIELDS, balances=BALANCE_FIELDS) -> list[tuple[str, str]]:
    """The same rules as (SQL condition, message): one ``F.expr`` builds the
    whole rule set in the JVM instead of one Python-to-JVM call per node."""
    rules = [(f"`{f}` IS NULL", MSG_MISSING.format(field=f)) for f in required]
    rules.append(("coalesce(`amount` < 0, false)", MSG_NEGATIVE_AMOUNT))
    rules += [(f"coalesce(`{f}` < 0, false)", MSG_NEGATIVE_BALANCE.format(field=f)) for f in balances]
    return rules


def dq_rejected(rules=None) -> Column:
    """True when any rule is violated; never NULL (null balances pass)."""
    if rules is None:
        return F.expr(" OR ".join(f"({cond})" for cond, _ in dq_rules_sql()))
    return reduce(lambda a, b: a | b, [cond for _, cond, _ in rules], F.lit(False))


def dq_reasons(rules=None) -> Column:
    """All violated rules' messages, in rule order; empty when clean."""
    if rules is None:
        items = ", ".join(f"CASE WHEN {cond} THEN '{msg}' END" for cond, msg in dq_rules_sql())
        return F.expr(f"array_except(array({items}), array(CAST(NULL AS STRING)))")
    return compact([F.when(cond, F.lit(msg)) for _, cond, msg in rules])


def with_dq(df: DataFrame, reasons_col: str = "reasons") -> DataFrame:
    """Attach the reasons array; ``size(reasons) = 0`` means accepted."""
    return df.withColumn(reasons_col, dq_reasons())


def accepted(df: DataFrame, reasons_col: str = "reasons") -> DataFrame:
    return df.where(F.size(reasons_col) == 0)


def rejected(df: DataFrame, reasons_col: str = "reasons") -> DataFrame:
    return df.where(F.size(reasons_col) > 0)


# --- JSON contracts -------------------------------------------------------

def kind_from_schema(s: Column) -> Column:
    """Python type name for a ``schema_of_variant`` string (NULL = absent).

    The parser keeps integer tokens as BIGINT and normalizes decimal tokens
    (``181.0`` -> ``DECIMAL(3,0)``); only integers beyond the long range come
    out as scale-0 decimals of 19+ digits (``DECIMAL(19,0)`` .. ``(38,0)``).
    """
    wide_int = s.startswith("DECIMAL(") & s.endswith(",0)") & (F.length(s) == 13) & (F.substring(s, 9, 2) >= "19")
    return (
        F.when(s.isNull(), F.lit(None).cast("string"))
        .when(s == "VOID", "NoneType")
        .when(s == "BOOLEAN", "bool")
        .when(s.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "int")
        .when(wide_int, "int")
        .when(s.startswith("DECIMAL") | s.isin("DOUBLE", "FLOAT"), "float")
        .when(s == "STRING", "str")
        .when(s.startswith("OBJECT"), "dict")
        .when(s.startswith("ARRAY"), "list")
        .otherwise(s)
    )


def json_kind(v: Column) -> Column:
    """Python type name of a VARIANT value as ``json.loads`` would give it.

    NULL for an absent value; ``NoneType`` for JSON null.
    """
    return kind_from_schema(F.schema_of_variant(v))


def _is_object(raw: Column, v: Column) -> Column:
    """Parsed JSON whose first non-blank character is ``{`` is an object.

    (Cheaper than ``schema_of_variant`` on the whole message, which builds the
    full nested schema.)"""
    return F.coalesce(v.isNotNull() & raw.rlike(r"^\s*\{"), F.lit(False))


def _accepts(expected: str, kind: Column, nullable: bool) -> Column:
    ok = kind == F.lit(expected)
    if expected == "int":
        ok = ok | (kind == "bool")  # a JSON boolean is an int subclass in Python
    if nullable:
        ok = ok | (kind == "NoneType")
    return ok


def _contract(
    raw: Column | str,
    kinds,
    not_object_msg: str,
    nullable: bool,
    check_type_values: bool,
) -> Column:
    raw_c = F.col(raw) if isinstance(raw, str) else raw
    v = F.try_parse_json(raw_c)
    is_object = _is_object(raw_c, v)
    items = []
    for field, expected in kinds:
        sub = F.try_variant_get(v, f"$.{field}", "variant")
        kind = json_kind(sub)
        items.append(F.when(kind.isNull(), F.lit(MSG_MISSING_FIELD.format(field=field))))
        items.append(
            F.when(
                kind.isNotNull() & ~_accepts(expected, kind, nullable),
                F.concat(F.lit(MSG_WRONG_KIND.format(field=field, expected=expected, got="")), kind),
            )
        )
    if check_type_values:
        tv = F.try_variant_get(v, "$.type", "variant")
        tkind = json_kind(tv)
        as_text = F.try_variant_get(v, "$.type", "string")
        shown = F.when(tkind == "str", F.concat(F.lit("'"), as_text, F.lit("'"))).otherwise(
            F.to_json(tv)
        )
        unknown = tkind.isNotNull() & (tkind != "NoneType") & ~(
            (tkind == "str") & as_text.isin(*TXN_TYPES)
        )
        items.append(F.when(unknown, F.concat(F.lit(MSG_UNKNOWN_TYPE.format(value="")), shown)))
    problems = compact(items)
    return F.when(is_object, problems).otherwise(F.array(F.lit(not_object_msg)))


def with_contract(
    df: DataFrame,
    raw: str,
    out: str = "problems",
    kinds=CONTRACT_KINDS,
    not_object_msg: str = MSG_NOT_OBJECT_TXN,
    nullable: bool = True,
    check_type_values: bool = True,
) -> DataFrame:
    """Frame form of the contract check: parse once, one kind column per
    field, then the message array. Staged projections keep each generated
    method small (whole-stage codegen stays on) and compute every kind once."""
    staged = df.withColumn("_v", F.try_parse_json(F.col(raw)))
    # one schema string per field in its own projection (evaluated once), then
    # kinds by plain string comparisons
    staged = staged.withColumns(
        {f"_s_{f}": F.schema_of_variant(F.try_variant_get(F.col("_v"), f"$.{f}", "variant")) for f, _ in kinds}
    )
    kind_cols = {f"_k_{f}": kind_from_schema(F.col(f"_s_{f}")) for f, _ in kinds}
    kind_cols["_obj"] = _is_object(F.col(raw), F.col("_v"))
    if check_type_values:
        kind_cols["_ttext"] = F.try_variant_get(F.col("_v"), "$.type", "string")
    staged = staged.withColumns(kind_cols)
    items = []
    for field, expected in kinds:
        kind = F.col(f"_k_{field}")
        items.append(F.when(kind.isNull(), F.lit(MSG_MISSING_FIELD.format(field=field))))
        items.append(
            F.when(
                kind.isNotNull() & ~_accepts(expected, kind, nullable),
                F.concat(F.lit(MSG_WRONG_KIND.format(field=field, expected=expected, got="")), kind),
            )
        )
    if check_type_values:
        tkind, text = F.col("_k_type"), F.col("_ttext")
        # JSON text of a non-string type value: only evaluated in that (rare) branch
        shown = F.when(tkind == "str", F.concat(F.lit("'"), text, F.lit("'"))).otherwise(
            F.to_json(F.try_variant_get(F.col("_v"), "$.type", "variant"))
        )
        unknown = tkind.isNotNull() & (tkind != "NoneType") & ~((tkind == "str") & text.isin(*TXN_TYPES))
        items.append(F.when(unknown, F.concat(F.lit(MSG_UNKNOWN_TYPE.format(value="")), shown)))
    problems = compact(items)
    result = staged.withColumn(out, F.when(F.col("_obj"), problems).otherwise(F.array(F.lit(not_object_msg))))
    return result.drop("_v", "_obj", "_ttext", *[f"_k_{f}" for f, _ in kinds], *[f"_s_{f}" for f, _ in kinds])


def txn_contract(raw: Column | str) -> Column:
    """Contract problems of a raw transaction message (empty = valid).

    Missing field, wrong JSON kind (null allowed), unknown ``type``. A message
    that is not a JSON object (including unparseable text) gets one problem.
    """
    return _contract(raw, CONTRACT_KINDS, MSG_NOT_OBJECT_TXN, nullable=True, check_type_values=True)


def alert_contract(raw: Column | str) -> Column:
    """Contract problems of a raw alert message; null values are not allowed."""
    return _contract(raw, ALERT_KINDS, MSG_NOT_OBJECT_ALERT, nullable=False, check_type_values=False)


def account_id_valid(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.rlike(ACCOUNT_ID_PATTERN), F.lit(False))


def erasure_payload_bad(raw: Column | str) -> Column:
    """Not a JSON object, or ``account_id`` missing / null / empty / zero / false."""
    raw_c = F.col(raw) if isinstance(raw, str) else raw
    v = F.try_parse_json(raw_c)
    is_object = _is_object(raw_c, v)
    acct = F.try_variant_get(v, "$.account_id", "variant")
    kind = json_kind(acct)
    text = F.try_variant_get(v, "$.account_id", "string")
    falsy = (
        kind.isNull()
        | (kind == "NoneType")
        | ((kind == "str") & (text == ""))
        | (kind.isin("int", "float") & (F.try_variant_get(v, "$.account_id", "double") == 0))
        | ((kind == "bool") & (text == "false"))
        | ((kind == "list") & (text == "[]"))
        | ((kind == "dict") & (text == "{}"))
    )
    return ~is_object | F.coalesce(falsy, F.lit(True))


# --- Declarative expectations ------------------------------------------------

def expectation_counts(df: DataFrame, not_null=(), accepted_values=None) -> DataFrame:
    """One pass: failing-row count per expectation, as (expectation, column, failures)."""
    accepted_values = accepted_values or {}
    aggs, names = [], []
    for c in not_null:
        aggs.append(F.sum(F.col(c).isNull().cast("long")).alias(f"nn_{c}"))
        names.append(("not_null", c, f"nn_{c}"))
    for c, values in accepted_values.items():
        aggs.append(F.sum((F.col(c).isNotNull() & ~F.col(c).isin(*values)).cast("long")).alias(f"av_{c}"))
        names.append(("accepted_values", c, f"av_{c}"))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{e}', '{c}', coalesce({a}, 0L)" for e, c, a in names)
    return wide.selectExpr(f"stack({len(names)}, {stack}) as (expectation, column_name, failures)")
