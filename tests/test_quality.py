"""Quality rules, contracts, id format and erasure payload checks."""

import json

from pyspark.sql import functions as F

from fraudlake.functions import quality
from fraudlake.schemas import TXN


def _clean():
    return dict(step=1, type="CASH_OUT", amount=181.0, nameOrig="C0000000001", oldbalanceOrg=181.0,
                newbalanceOrig=0.0, nameDest="C0000000002", oldbalanceDest=0.0, newbalanceDest=181.0,
                isFraud=0, isFlaggedFraud=0)


def _reasons(spark, rows):
    df = spark.createDataFrame([tuple(r[f.name] for f in TXN.fields) for r in rows], TXN)
    return [r.reasons for r in quality.with_dq(df).collect()]


def test_clean_row_has_no_reasons(spark):
    assert _reasons(spark, [_clean()]) == [[]]


def test_each_rule_and_all_reasons_collected(spark):
    a = _clean(); a["amount"] = -10.0
    b = _clean(); b["nameDest"] = None; b["oldbalanceDest"] = -1.0
    c = _clean(); c["step"] = None
    got = _reasons(spark, [a, b, c])
    assert got[0] == ["negative amount"]
    assert got[1] == ["missing or null required field: nameDest", "negative balance: oldbalanceDest"]
    assert got[2] == ["missing or null required field: step"]


def test_null_balance_is_accepted_not_dropped(spark):
    r = _clean(); r["oldbalanceOrg"] = None
    df = spark.createDataFrame([tuple(r[f.name] for f in TXN.fields)], TXN)
    out = df.select(quality.dq_rejected().alias("rej")).first()
    assert out.rej is False  # never NULL: the row lands in exactly one fork
    assert quality.accepted(quality.with_dq(df)).count() == 1
    assert quality.rejected(quality.with_dq(df)).count() == 0


def _contract(spark, payloads):
    df = spark.createDataFrame([(p,) for p in payloads], "raw string")
    return [r.p for r in quality.with_contract(df, "raw", out="p").collect()]


def test_contract_flags_drift(spark):
    ok = json.dumps(_clean())
    renamed = _clean(); renamed["oldbalanceOrig"] = renamed.pop("oldbalanceOrg")
    string_amount = _clean(); string_amount["amount"] = "large"
    unknown = _clean(); unknown["type"] = "CASH_OUT2"
    missing = _clean(); missing.pop("nameDest")
    got = _contract(spark, [ok, json.dumps(renamed), json.dumps(string_amount), json.dumps(unknown),
                            json.dumps(missing), "not json", '"a string"'])
    assert got[0] == []
    assert got[1] == ["missing field: oldbalanceOrg"]
    assert got[2] == ["field amount: expected float, got str"]
    assert got[3] == ["unknown type: 'CASH_OUT2'"]
    assert got[4] == ["missing field: nameDest"]
    assert got[5] == ["transaction is not a dict"]
    assert got[6] == ["transaction is not a dict"]


def test_contract_integer_amount_is_drift_and_null_allowed(spark):
    r = _clean(); r["amount"] = 181; r["isFraud"] = None
    assert _contract(spark, [json.dumps(r)]) == [["field amount: expected float, got int"]]


def test_alert_contract(spark):
    df = spark.createDataFrame([(json.dumps({"txn": {}, "fraud_probability": 0.9999}),), ("not-a-dict",)], "raw string")
    rows = df.select(quality.alert_contract("raw").alias("p")).collect()
    assert any("threshold" in p for p in rows[0].p) and any("model_version" in p for p in rows[0].p)
    assert rows[1].p == ["alert is not a dict"]


def test_account_id_format(spark):
    bad = ["", "123456789", "C12$3", "  C123456789", "C"]
    good = ["C123456789", "M12"]
    df = spark.createDataFrame([(x,) for x in bad + good], "id string")
    got = [r.v for r in df.select(quality.account_id_valid("id").alias("v")).collect()]
    assert got == [False] * len(bad) + [True] * len(good)


def test_erasure_payload_check(spark):
    payloads = [json.dumps({"account_id": "C1", "request_id": "r"}), json.dumps({"request_id": "r"}),
                json.dumps("C1"), json.dumps({"account_id": None}), json.dumps({"account_id": ""}), "{broken"]
    df = spark.createDataFrame([(p,) for p in payloads], "raw string")
    got = [r.bad for r in df.select(quality.erasure_payload_bad("raw").alias("bad")).collect()]
    assert got == [False, True, True, True, True, True]


def test_expectations_one_pass(spark):
    df = spark.createDataFrame([("CASH_OUT", 1.0), (None, 2.0), ("REFUND", None)], "type string, amount double")
    out = {(r.expectation, r.column_name): r.failures for r in quality.expectation_counts(
        df, not_null=["type", "amount"], accepted_values={"type": ["CASH_OUT"]}).collect()}
    assert out == {("not_null", "type"): 1, ("not_null", "amount"): 1, ("accepted_values", "type"): 1}
