"""Registered queries that run a stream to its end and read its sink back.

The input of each is staged as files in the shared folder, in several waves that
become several micro-batches; the sink's table is the query's result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fraudlake.operators.fanin import fan_in_any_order, steps_never_decrease
from fraudlake.paths import LakePaths
from fraudlake.plans import pipeline as P
from fraudlake.plans.catalog import register
from fraudlake.plans.oracle import with_views
from fraudlake.schemas import TXN
from fraudlake.session import shared_path
from fraudlake.streaming.bronze import json_file_stream, replay_table, start_bronze
from fraudlake.streaming.fanin_batches import results, start_fan_in
from fraudlake.streaming.fanin_state import fan_in_state

WAVES = 4
#: Control rows in a file of the staged stream; the number of files follows from the rows.
ROWS_PER_FILE = 100_000
CHUNK_ROWS = 50_000


def _folder(spark, name: str) -> str:
    return shared_path(spark, "fraudlake-streams", f"{name}-{uuid.uuid4().hex}")


def _control(spark, sf, hot: bool = False):
    """Arrivals of scorable rows: every 50th comes a third of the data later, and
    every 97th row's destination is purged right behind it. With ``hot`` every third
    row goes to one destination."""
    key = F.when(F.lit(hot) & (F.col("seq") % 3 == 0), F.lit("HOT")).otherwise(F.col("nameDest")).alias("key")
    rows = P.bronze(spark, sf).where(F.col("type").isin("CASH_OUT", "TRANSFER")).select("seq", "step", key)
    lim = rows.agg(F.min("seq").alias("lo"), F.max("seq").alias("hi")).first()
    shift = ((lim.hi or 0) - (lim.lo or 0)) // 3
    late = F.col("seq") % 50 == 7
    txn = rows.select(
        "key", F.when(late, 4 * (F.col("seq") + shift) + 1).otherwise(4 * F.col("seq")).alias("seq"), F.lit("txn").alias("kind"),
        F.col("step").cast("int").alias("step"), F.col("seq").alias("row"),
    )
    purges = rows.where(F.col("seq") % 97 == 5).select(
        "key", (4 * F.col("seq") + 2).alias("seq"), F.lit("purge").alias("kind"), F.lit(None).cast("int").alias("step"), F.col("seq").alias("row")
    )
    return txn.unionByName(purges), 4 * (lim.lo or 0), 4 * ((lim.hi or 0) + shift) + 2


def _staged_waves(spark, sf, hot: bool = False):
    """(folder with the control rows in waves of files, files a wave, schema)."""
    control, lo, hi = _control(spark, sf, hot)
    src, staged = _folder(spark, "fan-in-src"), _folder(spark, "fan-in-control")
    control.withColumn("wave", F.least(F.floor((F.col("seq") - lo) * WAVES / (hi - lo + 1)), F.lit(WAVES - 1)).cast("int")).write.partitionBy("wave").parquet(staged)
    table = spark.read.parquet(staged)
    files = max(1, min(512, -(-table.count() // (WAVES * ROWS_PER_FILE))))
    for wave in range(WAVES):
        # no key: a hot destination's rows are dealt over all files of the wave
        table.where(F.col("wave") == wave).drop("wave").repartition(files).write.mode("append").parquet(src)
    return src, files, control.schema


FAN_IN_SQL = """SELECT "row", kind, fan_in_dest_count_24h, late FROM (
             WITH lim AS (SELECT min(seq) AS lo, max(seq) AS hi FROM bronze WHERE type IN ('CASH_OUT','TRANSFER')),
             t AS (SELECT seq, step, {key} AS nameDest FROM bronze WHERE type IN ('CASH_OUT','TRANSFER')),
             c AS (SELECT nameDest AS k, seq AS "row", 'txn' AS kind, step, CASE WHEN seq % 50 = 7 THEN 4 * (seq + (hi - lo) // 3) + 1 ELSE 4 * seq END AS a FROM t, lim
                   UNION ALL SELECT nameDest, seq, 'purge', NULL, 4 * seq + 2 FROM t WHERE seq % 97 = 5),
             p AS (SELECT *, coalesce(max(CASE WHEN kind = 'purge' THEN a END) OVER (PARTITION BY k ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS lp FROM c),
             m AS (SELECT *, max(step) OVER (PARTITION BY k, lp ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM p)
             SELECT m."row", m.kind, CASE WHEN m.kind = 'txn' THEN count(j."row") END AS fan_in_dest_count_24h,
                    m.kind = 'txn' AND coalesce(m.step < m.top - 24, false) AS late
             FROM m LEFT JOIN m j ON m.kind = 'txn' AND j.kind = 'txn' AND j.k = m.k AND j.lp = m.lp AND j.a < m.a
                  AND j.step BETWEEN m.step - 24 AND m.step AND j.step >= m.top - 24
             GROUP BY m."row", m.kind, m.step, m.top)"""
HOT_SQL = "CASE WHEN seq % 3 = 0 THEN 'HOT' ELSE nameDest END"


@register("X1_X2_fan_in_stream", with_views(FAN_IN_SQL.format(key="nameDest"), "bronze"))
def q_x1(spark, sf):
    """The keyed state over four waves of files: late rows are flagged, none is lost."""
    src, files, schema = _staged_waves(spark, sf)
    out = _folder(spark, "fan-in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(src)
    query = (
        fan_in_state(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", _folder(spark, "fan-in-ck"))
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(out).select("row", "kind", "fan_in_dest_count_24h", "late")


@register("X1_X2_hot_destination", with_views(FAN_IN_SQL.format(key=HOT_SQL), "bronze"))
def q_x1_hot(spark, sf):
    """The state table over the same waves, with a third of all rows on one destination."""
    src, files, schema = _staged_waves(spark, sf, hot=True)
    root = _folder(spark, "fan-in-table")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(src)
    start_fan_in(stream, root, _folder(spark, "fan-in-table-ck"), trigger="availableNow", chunk_rows=CHUNK_ROWS, merge_every=3).awaitTermination()
    added = "fan_in_dest_count_24h long, late boolean, purged boolean"
    found = results(spark, root, StructType([*schema.fields, *StructType.fromDDL(added).fields]))
    return found.select("row", "kind", "fan_in_dest_count_24h", "late")


@register("W2_fan_in_any_order", with_views(FAN_IN_SQL.format(key=HOT_SQL), "bronze"))
def q_w2_any(spark, sf):
    """The batch form over the same arrivals, whose steps decrease; erasures in between."""
    control, _, _ = _control(spark, sf, hot=True)
    staged = _folder(spark, "any-order")
    control.write.parquet(staged)
    found, _ = fan_in_any_order(spark.read.schema(control.schema).parquet(staged), chunk_rows=CHUNK_ROWS)
    return found.select("row", "kind", "fan_in_dest_count_24h", "late")


@register(
    "W2_steps_never_decrease",
    with_views(
        """SELECT 'as they came' AS rows, NOT EXISTS (SELECT 1 FROM (SELECT step < max(step) OVER (PARTITION BY nameDest ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bad
                  FROM bronze WHERE type IN ('CASH_OUT','TRANSFER')) WHERE bad) AS short_form_allowed
           UNION ALL SELECT 'every 50th later', NOT EXISTS (SELECT 1 FROM (SELECT step < max(step) OVER (PARTITION BY nameDest ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bad
                  FROM (SELECT step, nameDest, CASE WHEN seq % 50 = 7 THEN 4 * (seq + ((SELECT max(seq) - min(seq) FROM bronze WHERE type IN ('CASH_OUT','TRANSFER')) // 3)) + 1 ELSE 4 * seq END AS a
                        FROM bronze WHERE type IN ('CASH_OUT','TRANSFER'))) WHERE bad)""",
        "bronze",
    ),
)
def q_w2_condition(spark, sf):
    """Whether the short form of the arrival fan-in may be used: on the rows as they came, and on the shifted ones."""
    came = P.bronze(spark, sf).where(F.col("type").isin("CASH_OUT", "TRANSFER"))
    shifted = _control(spark, sf)[0].where("kind = 'txn'")
    rows = [("as they came", steps_never_decrease(came)), ("every 50th later", steps_never_decrease(shifted, key="key"))]
    return spark.createDataFrame(rows, "rows string, short_form_allowed boolean")


@register(
    "K1_K2_S7_bronze_fork",
    with_views(
        """SELECT seq, len(reasons) > 0 AS rejected, CASE WHEN len(reasons) = 0 THEN type END AS type FROM reasoned""",
        "reasoned",
    ),
)
def q_k1(spark, sf):
    """Replay the records as messages, fork the stream, read both sinks back."""
    src = _folder(spark, "replay")
    records = P.transactions(spark, sf).select(*TXN.fieldNames(), "seq")
    replay_table(spark, records, src, rows_per_file=100_000)
    paths = LakePaths(_folder(spark, "lake"))
    raw = json_file_stream(spark, src, max_files_per_trigger=100).select("value", F.get_json_object("value", "$.seq").cast("long").alias("seq"))
    for query in start_bronze(raw, paths, trigger="availableNow", keep=("seq",)):
        query.awaitTermination()
    accepted = spark.read.parquet(paths.bronze).select("seq", F.lit(False).alias("rejected"), "type")
    rejected = spark.read.schema("seq long").parquet(paths.quarantine).select("seq", F.lit(True).alias("rejected"), F.lit(None).cast("string").alias("type"))
    return accepted.unionByName(rejected)
