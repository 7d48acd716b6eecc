"""Streaming scorer: quality gate -> type guard -> fan-in state -> score -> alert.

One streaming DataFrame chain; the scoring step is the same scorer function
the batch twin uses, so batch and stream score identically. Counters are
attached with ``observe`` and read from the query's progress.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.functions import quality
from fraudlake.functions.features import scoring_features
from fraudlake.operators.score import SCORECARD_METADATA, Scorer, model_version, scorecard_scorer
from fraudlake.schemas import SCORABLE_TYPES, TXN_FIELDS
from fraudlake.streaming.fanin_state import control_stream, fan_in_state


#: Arrival order over topics and partitions.
ARRIVAL = ("arrived_at", "arrived_topic", "arrived_partition", "arrived_offset")


def score_stream(
    txn: DataFrame,
    purges: DataFrame | None = None,
    scorer: Scorer | None = None,
    metadata: dict | None = None,
    lateness: int = 0,
    order=("seq",),
    control_rows: bool = False,
    idle: str | None = None,
) -> DataFrame:
    """Decoded transactions (with ``seq``) [+ erasure messages] -> every
    transaction once with ``status``, fan-in, probability, alert flag.

    ``order``: the columns of arrival order that transactions and erasures share
    (``dispatch_topics`` names them). ``idle``: how long a live query keeps a
    destination without traffic, see ``fan_in_state``. Erasures marked ``bad`` do not reach the
    state. With ``control_rows`` each erasure is a row of its own, with status
    ``gdpr_purge`` (and ``purged``) or ``gdpr_bad_payload``, for the live counters.
    """
    scorer = scorer or scorecard_scorer()
    metadata = metadata or SCORECARD_METADATA
    thr = float(metadata["decision_threshold"])
    reasoned = quality.with_dq(txn)
    ok = (F.size("reasons") == 0) & F.col("type").isin(*SCORABLE_TYPES)
    carry = [c for c in TXN_FIELDS if c not in ("step",)]
    bad = None
    if purges is not None and "bad" in purges.columns:
        purges, bad = purges.where(~F.col("bad")), purges.where(F.col("bad"))
    control = control_stream(reasoned.where(ok), purges, carry=carry, order=order)
    stateful = fan_in_state(control, lateness=lateness, order=order, idle=idle)
    # one stateful operator a query: purges, if wanted, pass through the same branch
    rows = stateful if control_rows else stateful.where(F.col("kind") == "txn").drop("purged")
    txn_rows = rows.drop("key")
    no_reasons = F.when(F.col("kind") == "txn", F.array().cast("array<string>"))  # the state gets accepted rows only
    txn_rows = txn_rows.withColumns({"reasons": no_reasons, "fan_in_count": F.col("fan_in_dest_count_24h")})
    scored = scorer(scoring_features(txn_rows)).withColumn(
        "status",
        F.when(F.col("kind") == "purge", "gdpr_purge").when(F.col("fraud_probability").isNull(), "score_error").otherwise("scored"),
    ).drop("kind")
    rest = reasoned.where(~ok).withColumn(
        "status", F.when(F.size("reasons") > 0, "dq_rejected").otherwise("skipped")
    )
    both = scored.unionByName(rest, allowMissingColumns=True)
    if control_rows and bad is not None:
        both = both.unionByName(bad.select("seq", F.lit("gdpr_bad_payload").alias("status")), allowMissingColumns=True)
    out = both.withColumns(
        {
            "threshold": F.when(F.col("status").isin("scored", "score_error"), F.lit(thr)),
            "model_version": F.when(F.col("status").isin("scored", "score_error"), F.lit(model_version(metadata))),
            "is_alert": F.coalesce(F.col("fraud_probability") >= F.lit(thr), F.lit(False)),
        }
    )
    return out


def purge_results(txn: DataFrame, purges: DataFrame, lateness: int = 0) -> DataFrame:
    """Purge rows of the keyed state (``purged`` = the key had state)."""
    control = control_stream(txn, purges)
    return fan_in_state(control, lateness=lateness).where(F.col("kind") == "purge").select("key", "seq", "purged")


def with_counters(chain: DataFrame, name: str = "counters") -> DataFrame:
    """Attach the live counters as observed metrics (read from progress)."""
    s = F.col("status")
    return chain.observe(
        name,
        F.sum((s == "scored").cast("long")).alias("scored"),
        F.sum(F.col("is_alert").cast("long")).alias("alerts"),
        F.sum((s == "score_error").cast("long")).alias("score_errors"),
        F.sum((s == "skipped").cast("long")).alias("skipped"),
        F.sum((s == "dq_rejected").cast("long")).alias("dq_rejected"),
        F.sum(s.isin("scored", "score_error").cast("long")).alias("fan_in_events"),
        F.sum(((s == "gdpr_purge") & (F.col("purged") if "purged" in chain.columns else F.lit(False))).cast("long")).alias("gdpr_purges"),
        F.sum((s == "gdpr_bad_payload").cast("long")).alias("gdpr_bad_payloads"),
    )


def start_alert_sink(chain: DataFrame, path: str, checkpoint: str, trigger: str | None = None, registry: DataFrame | None = None):
    """Alerts as JSON messages to a file sink (a Kafka sink takes the same
    ``key``/``value`` frame with ``format("kafka")``). Ids of accounts in the
    erasure ``registry`` leave only as aliases (None: no registry exists yet)."""
    from fraudlake.operators.score import alert_messages

    alerts = chain.where(F.col("is_alert"))
    msgs = alert_messages(alerts, registry)
    w = msgs.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if trigger in (None, "availableNow") else w.trigger(processingTime=trigger)
    return w.start()


def dispatch_topics(
    records: DataFrame,
    txn_topic: str = "transactions-raw",
    erasure_topic: str = "gdpr-deletion-requests",
    seq_col: str = "offset",
) -> tuple[DataFrame, DataFrame]:
    """One subscription of both topics -> (decoded transactions, erasure rows).

    ``records`` has the topic-source columns ``topic``, ``value`` and an
    arrival order column. Offsets of different topics and partitions do not
    compare, so both results also carry those of ``ARRIVAL`` that the source
    has; pass them to ``score_stream(order=...)``. Erasure rows carry ``account_id``, ``request_id``
    and ``bad`` (not an object, or no usable account id); only good ones
    should reach the state as purges.
    """
    from fraudlake.sources.txn import decode_txn

    has = dict(zip(ARRIVAL, ("timestamp", "topic", "partition", "offset"), strict=True))
    more = {c: F.col(src) for c, src in has.items() if src in records.columns}
    ordered = records.withColumns({"seq": F.col(seq_col).cast("long"), **more})
    txn = decode_txn(ordered.where(F.col("topic") == txn_topic), keep=("seq", *more))
    er = ordered.where(F.col("topic") == erasure_topic).select(
        "seq", *more,
        F.col("value").cast("string").alias("raw"),
    )
    er = er.select(
        "seq", *more,
        F.get_json_object("raw", "$.account_id").alias("account_id"),
        F.get_json_object("raw", "$.request_id").alias("request_id"),
        quality.erasure_payload_bad("raw").alias("bad"),
    )
    return txn, er
