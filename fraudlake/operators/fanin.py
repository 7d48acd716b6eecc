"""Destination fan-in and originator velocity windows over ``step``.

Plain forms are the textbook RANGE windows. They put every row of one key in
one task, so a destination holding a third of the table would be one task.
The scale forms first reduce to one row per (key, step) with a map-side
combined ``groupBy`` (at most one row per hour per key), run the RANGE window
on that, and join the per-(key, step) result back; AQE splits a skewed join
partition, and the sort-merge join's fact side is the only wide shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.plans.strategies import CHUNK_ROWS_CONF, DEFAULT_CHUNK_ROWS
from fraudlake.schemas import FAN_IN_WINDOW_STEPS


def fan_in_plain(
    df: DataFrame,
    key: str = "name_dest",
    step: str = "step",
    window: int = FAN_IN_WINDOW_STEPS,
    out: str = "fan_in_dest_count_24h",
) -> DataFrame:
    """``COUNT(*) OVER (PARTITION BY key ORDER BY step RANGE window PRECEDING) - 1``."""
    w = Window.partitionBy(key).orderBy(step).rangeBetween(-window, 0)
    return df.withColumn(out, F.count(F.lit(1)).over(w) - F.lit(1))


def _step_counts(df: DataFrame, key: str, step: str) -> DataFrame:
    return df.groupBy(key, step).agg(F.count(F.lit(1)).alias("_n"))


def _join_back(df: DataFrame, per_key_step: DataFrame, key: str, step: str) -> DataFrame:
    right = per_key_step.withColumnsRenamed({key: "_fk", step: "_fs"})
    cond = [F.col(key).eqNullSafe(F.col("_fk")), F.col(step) == F.col("_fs")]
    return df.join(right, cond, "left").drop("_fk", "_fs")


def fan_in(
    df: DataFrame,
    key: str = "name_dest",
    step: str = "step",
    window: int = FAN_IN_WINDOW_STEPS,
    out: str = "fan_in_dest_count_24h",
) -> DataFrame:
    """Scale form of :func:`fan_in_plain` (same result, bounded tasks)."""
    w = Window.partitionBy(key).orderBy(step).rangeBetween(-window, 0)
    per = _step_counts(df, key, step).select(key, step, (F.sum("_n").over(w) - F.lit(1)).alias(out))
    return _join_back(df, per, key, step)


def fan_in_arrival_plain(
    df: DataFrame,
    key: str = "nameDest",
    step: str = "step",
    seq: str = "seq",
    window: int = FAN_IN_WINDOW_STEPS,
    out: str = "fan_in_dest_count_24h",
) -> DataFrame:
    """Earlier arrivals of the key with step in [step - window, step].

    ``range_count - peers_in_step + row_number_in_step(seq) - 1``; valid while
    ``step`` never decreases along ``seq`` (the streaming twin counts exactly
    this).
    """
    rng = Window.partitionBy(key).orderBy(step).rangeBetween(-window, 0)
    peers = Window.partitionBy(key, step)
    order = Window.partitionBy(key, step).orderBy(seq)
    return df.withColumn(
        out,
        F.count(F.lit(1)).over(rng) - F.count(F.lit(1)).over(peers) + F.row_number().over(order) - F.lit(1),
    )


def fan_in_arrival(
    df: DataFrame,
    key: str = "nameDest",
    step: str = "step",
    seq: str = "seq",
    window: int = FAN_IN_WINDOW_STEPS,
    out: str = "fan_in_dest_count_24h",
    chunk_rows: int | None = None,
) -> DataFrame:
    """Scale form of :func:`fan_in_arrival_plain`.

    fan-in = (arrivals of the key in steps [step - window, step - 1])
           + (arrivals earlier in the same step)
    Rows are cut into ``seq`` chunks of at most ``chunk_rows`` rows. Everything
    but the rank inside a chunk is computed on a small table with one row per
    (key, step, chunk): the RANGE sum over earlier steps and the offset of the
    chunk inside its step. The fact rows are shuffled once, by
    (key, step, chunk), for the rank; the join to the small table uses exactly
    those keys, so it needs no second shuffle of the fact side, and no task
    holds more than one chunk of a hot destination-step.
    """
    size = chunk_rows or int(df.sparkSession.conf.get(CHUNK_ROWS_CONF, str(DEFAULT_CHUNK_ROWS)))
    # null-safe keys as plain columns, used alike by the window and the join
    staged = df.withColumns(
        {
            "_fk": F.coalesce(F.col(key).cast("string"), F.lit("")),
            "_fn": F.col(key).isNull(),
            "_chunk": F.floor(F.col(seq) / F.lit(size)),
        }
    )
    keys = ["_fk", "_fn"]
    chunks = staged.groupBy(*keys, step, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    per_step = chunks.groupBy(*keys, step).agg(F.sum("_n").alias("_sn"))
    earlier = Window.partitionBy(*keys).orderBy(step).rangeBetween(-window, -1)
    prior = per_step.select(*keys, step, F.coalesce(F.sum("_sn").over(earlier), F.lit(0)).alias("_prior"))
    before = Window.partitionBy(*keys, step).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.select(*keys, step, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    base = offsets.join(prior, [*keys, step], "inner").select(
        *keys, step, "_chunk", (F.col("_prior") + F.col("_off")).alias("_base")
    )
    rank = Window.partitionBy(*keys, step, "_chunk").orderBy(seq)
    numbered = staged.withColumn("_rn", F.row_number().over(rank))
    # left: a row is never dropped (a NULL step or seq only leaves its fan-in NULL)
    joined = numbered.join(base, [*keys, step, "_chunk"], "left")
    return joined.withColumn(out, F.col("_base") + F.col("_rn") - F.lit(1)).select(*df.columns, out)


def velocity_orig(
    df: DataFrame,
    key: str = "name_orig",
    step: str = "step",
    amount: str = "amount",
    window: int = FAN_IN_WINDOW_STEPS,
) -> DataFrame:
    """Originator 24-step count and amount of other transactions (scale form).

    Adds ``orig_count_24h`` = rows of the key in the frame minus the current
    one, and ``orig_amount_cents_24h`` = their amount in integer cents (exact
    sums: no dependence on summation order).
    """
    cents = F.round(F.col(amount) * 100).cast("long")
    per = df.groupBy(key, step).agg(F.count(F.lit(1)).alias("_n"), F.sum(cents).alias("_c"))
    w = Window.partitionBy(key).orderBy(step).rangeBetween(-window, 0)
    per = per.select(key, step, F.sum("_n").over(w).alias("_wn"), F.sum("_c").over(w).alias("_wc"))
    joined = _join_back(df, per, key, step)
    return joined.withColumns(
        {
            "orig_count_24h": F.col("_wn") - F.lit(1),
            "orig_amount_cents_24h": F.col("_wc") - F.coalesce(cents, F.lit(0)),
        }
    ).drop("_wn", "_wc")


# --- any order of steps, erasures in between ---------------------------------------------


def steps_never_decrease(df: DataFrame, key: str = "nameDest", step: str = "step", seq: str = "seq") -> bool:
    """Whether :func:`fan_in_arrival` may be used: in no key does a later arrival have a smaller step.

    One row a (key, step) is enough: the first arrival of each step must lie behind the
    last arrival of the step before it."""
    per = df.where(F.col(step).isNotNull() & F.col(seq).isNotNull()).groupBy(key, step).agg(F.min(seq).alias("_lo"), F.max(seq).alias("_hi"))
    before = F.max("_hi").over(Window.partitionBy(key).orderBy(step).rowsBetween(Window.unboundedPreceding, -1))
    return per.select((F.col("_lo") < before).alias("_bad")).where("_bad").limit(1).count() == 0


def _earlier_in_group(batches, span: int):
    """Add ``_inside``: the earlier rows of the group with step in [_lo, _step].

    Rows come sorted by group and position; ``_pos`` 1 starts a group. A batch's last
    group is held until it is complete; groups are bounded by the chunk size.
    """
    import numpy as np
    import pyarrow as pa

    def solve(table):
        pos, step, lo = (table.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("_pos", "_step", "_lo"))
        n = len(pos)
        idx = np.arange(n)
        start = np.maximum.accumulate(np.where(pos == 1, idx, 0))
        gid = np.cumsum(pos == 1)
        base = step.min() - span - 1
        width = int(step.max() - base) + 1
        place = gid * width + (step - base)  # ascending where a group's steps never decrease
        falls = np.zeros(n, dtype=bool)
        falls[1:] = (place[1:] < place[:-1]) & (gid[1:] == gid[:-1])
        ordered = ~np.isin(gid, gid[falls])
        out = np.zeros(n, dtype=np.int64)
        if ordered.any():
            at = idx[ordered]
            first = np.searchsorted(place[at], gid[at] * width + np.maximum(lo[at] - base, 0), side="left")
            from_row = np.maximum(at[np.minimum(first, len(at) - 1)], start[at])
            out[at] = np.maximum(at - from_row, 0)  # a late row's window holds nothing
        mixed = idx[~ordered]
        if len(mixed):
            keys = np.sort(place[mixed] * n + mixed)
            total = np.zeros(len(mixed), dtype=np.int64)
            for d in range(span + 1):  # one step of the window at a time
                v = step[mixed] - d
                cell = (gid[mixed] * width + (v - base)) * n
                found = np.searchsorted(keys, cell + mixed) - np.searchsorted(keys, cell)
                total += np.where(v >= lo[mixed], found, 0)
            out[mixed] = total
        return table.append_column("_inside", pa.array(out))

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        starts = np.flatnonzero(held.column("_pos").to_numpy(zero_copy_only=False) == 1)
        if len(starts) and starts[-1] > 0:
            done, held = held.slice(0, starts[-1]), held.slice(starts[-1])
            yield from solve(done).combine_chunks().to_batches()
    if held is not None and held.num_rows:
        yield from solve(held).combine_chunks().to_batches()


def fan_in_any_order(
    control: DataFrame,
    window: int = FAN_IN_WINDOW_STEPS,
    lateness: int = 0,
    chunk_rows: int | None = None,
    initial: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Fan-in of control rows whose steps may decrease, with erasures in between.

    ``control``: key, seq (arrival, unique), kind ('txn' or 'purge'), step, and columns
    that ride along. For each transaction: the number of earlier transactions of its
    key since the key's last purge with step in [step - window, step], as far as the
    live state still holds them (steps from the highest one seen minus window and
    lateness on), and whether it is late (below that). ``initial`` is the state before
    (key, step, n). Returns (control with ``fan_in_dest_count_24h, late, purged``, the
    state behind: key, step, n, fresh). ``fresh`` marks a key purged here (a row with
    null step where nothing followed the purge).

    Rows are cut into chunks of ``chunk_rows`` arrivals; no window, group or Python call
    holds more of a key than one chunk. What a chunk must know of the ones before it are
    the counts of the live steps (window + lateness + 1 at most), summed over a table with
    one row per (key, chunk, step); inside a chunk rows are counted by binary search.
    A row without key counts under the key null; without seq or step it has no fan-in and
    counts nowhere.
    """
    spark = control.sparkSession
    size = chunk_rows or int(spark.conf.get(CHUNK_ROWS_CONF, str(DEFAULT_CHUNK_ROWS)))
    span = window + lateness
    cols = control.columns
    usable = F.col("seq").isNotNull() & ((F.col("kind") == "purge") | F.col("step").isNotNull())
    none = {"fan_in_dest_count_24h": F.lit(None).cast("long"), "late": F.lit(False), "purged": F.lit(False)}
    unusable = control.where(~F.coalesce(usable, F.lit(False))).withColumns(none)
    rows = control.where(usable).withColumns(
        {"_fk": F.coalesce(F.col("key").cast("string"), F.lit("")), "_fn": F.col("key").isNull(), "_chunk": F.floor(F.col("seq") / size)}
    )
    k = ["_fk", "_fn"]
    is_purge = F.col("kind") == "purge"

    # epoch: the key's last purge before the row (-1: none), by chunk and inside the chunk
    per_chunk = rows.groupBy(*k, "_chunk").agg(F.max(F.when(is_purge, F.col("seq"))).alias("_p"))
    earlier = Window.partitionBy(*k).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    entered = per_chunk.select(*k, "_chunk", F.max("_p").over(earlier).alias("_pin"))
    inside = Window.partitionBy(*k, "_chunk").orderBy("seq")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_pown", F.max(F.when(is_purge, F.col("seq"))).over(before)).join(entered, [*k, "_chunk"])
    rows = rows.withColumn("_epoch", F.coalesce("_pown", "_pin", F.lit(-1).cast("long"))).drop("_pown", "_pin")

    # counts by (key, epoch, chunk, step); the state before is chunk -1 of epoch -1
    e = [*k, "_epoch"]
    counts = rows.where(~is_purge).groupBy(*e, "_chunk", F.col("step").alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
    if initial is not None:
        counts = counts.unionByName(initial.select(
            F.coalesce(F.col("key").cast("string"), F.lit("")).alias("_fk"), F.col("key").isNull().alias("_fn"), F.lit(-1).cast("long").alias("_epoch"),
            F.lit(-(1 << 62)).cast("long").alias("_chunk"), F.col("step").alias("_t"), F.col("n").alias("_n"),
        ))
    so_far = Window.partitionBy(*e).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    tops = counts.groupBy(*e, "_chunk").agg(F.max("_t").alias("_m")).withColumn("_top", F.max("_m").over(so_far))
    asked = tops.where("_top IS NOT NULL").select(*e, "_chunk", "_top", F.explode(F.sequence(F.col("_top") - span, F.col("_top"))).alias("_t"))
    both = counts.select(*e, "_chunk", "_t", "_n", F.lit(None).cast("int").alias("_top")).unionByName(asked.withColumn("_n", F.lit(0).cast("long")))
    by_step = Window.partitionBy(*e, "_t").orderBy("_chunk").rangeBetween(Window.unboundedPreceding, -1)
    known = both.withColumn("_sum", F.coalesce(F.sum("_n").over(by_step), F.lit(0))).where("_top IS NOT NULL")
    entry = known.groupBy(*e, "_chunk").agg(  # span + 1 counts at most, in order of step
        F.first("_top").alias("_top"), F.transform(F.sort_array(F.collect_list(F.struct("_t", "_sum"))), lambda x: x["_sum"]).alias("_counts")
    )

    # inside a chunk
    g = Window.partitionBy(*e, "_chunk").orderBy("seq")
    txn = rows.where(~is_purge).withColumns({"_pos": F.row_number().over(g), "_high": F.max("step").over(g.rowsBetween(Window.unboundedPreceding, -1))})
    txn = txn.join(entry, [*e, "_chunk"], "left")
    high = F.greatest("_high", "_top")  # nulls are skipped
    txn = txn.withColumns({"_step": F.col("step"), "_lo": F.greatest(F.col("step") - window, high - span), "late": F.coalesce(F.col("step") < high - span, F.lit(False))})
    # counts start at step _top - span: take those of [_lo, _step]
    skip = F.greatest(F.lit(0), F.col("_lo") - (F.col("_top") - span))
    many = F.greatest(F.lit(0), F.least(F.col("_step"), F.col("_top")) - (F.col("_top") - span) - skip + 1)
    before_chunk = F.when(F.col("_counts").isNull() | (many == 0), F.lit(0).cast("long")).otherwise(
        F.aggregate(F.slice("_counts", skip + 1, F.greatest(many, F.lit(1))), F.lit(0).cast("long"), lambda a, x: a + x)
    )
    txn = txn.withColumn("_before", before_chunk).select(*e, "_chunk", *cols, "late", "_pos", "_step", "_lo", "_before")
    # the join may have moved rows: groups whole and in order again for the scan
    txn = txn.repartition(*e, "_chunk").sortWithinPartitions(*e, "_chunk", "_pos")
    solve = _earlier_in_group
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in txn.schema.fields) + ", _inside long"
    counted = txn.mapInArrow(lambda batches: solve(batches, span), schema)
    done = counted.select(*cols, (F.col("_before") + F.col("_inside")).alias("fan_in_dest_count_24h"), "late", F.lit(False).alias("purged"))

    # a purge had something to forget when its own epoch has counts
    own = counts.select(*e).distinct().withColumn("purged", F.lit(True))
    purged = rows.where(is_purge).join(own, e, "left").select(*cols, none["fan_in_dest_count_24h"].alias("fan_in_dest_count_24h"), F.lit(False).alias("late"), F.coalesce("purged", F.lit(False)).alias("purged"))

    # the state behind: live counts of each key's last epoch
    last = rows.groupBy(*k).agg(F.max(F.when(is_purge, F.col("seq"))).alias("_e"), F.first("key").alias("key"))
    if initial is None:
        heirs = last
    else:
        heirs = last.unionByName(
            initial.select(F.coalesce(F.col("key").cast("string"), F.lit("")).alias("_fk"), F.col("key").isNull().alias("_fn"), F.lit(None).cast("long").alias("_e"), "key").distinct()
        ).groupBy(*k).agg(F.max("_e").alias("_e"), F.first("key", ignorenulls=True).alias("key"))
    heirs = heirs.select(*k, F.coalesce("_e", F.lit(-1).cast("long")).alias("_epoch"), "key")
    live = counts.groupBy(*e, "_t").agg(F.sum("_n").alias("n")).withColumn("_top", F.max("_t").over(Window.partitionBy(*e))).where(F.col("_t") >= F.col("_top") - span)
    state = heirs.join(live, e, "left").where((F.col("_epoch") >= 0) | F.col("_t").isNotNull())
    return done.unionByName(purged).unionByName(unusable), state.select("key", F.col("_t").cast("int").alias("step"), "n", (F.col("_epoch") >= 0).alias("fresh"))
