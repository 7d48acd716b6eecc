"""Streaming destination fan-in with erasure purge (keyed state).

Transactions and erasure messages arrive as one tagged stream (``kind`` =
``txn`` or ``purge``), with state by account key. Per key the state is a
small map step -> count of events seen (at most window + lateness + 1 live
entries), so state size is bounded by the window, not the traffic:

* ``txn``: emit the number of earlier arrivals with step in
  ``[step - window, step]``, then record the event.
* ``purge``: forget the key (later events restart at 0); an unknown key is a
  no-op; other keys are untouched.

Eviction drops steps below ``max_step - window - lateness``; an event older
than that is still counted against what is left and flagged ``late``. The stream
carries no watermark, so no row is ever dropped: rows out equal rows in. With
``idle`` (for queries with a processing-time trigger) a key that gets no row for
so long is forgotten; without it keys stay, which suits runs over stored data
(a query that processes what is available would never end with such a timeout).

A Python call costs milliseconds whatever it does, so without ``idle`` it gets the
keys of one of ``BUCKETS`` hash buckets and counts them together; the bucket's state
holds each key's map. With ``idle`` the groups are single keys, each with its timeout.

Rows of one key are sorted by ``order`` (arrival: by default ``seq``) inside the
micro-batch before they are applied, so arrival order, not chunk order, decides
same-step counts. Where transactions and erasures come from different topics,
offsets do not compare: ``order`` then starts with the record's timestamp.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fraudlake.schemas import FAN_IN_WINDOW_STEPS

RESULT_FIELDS = "fan_in_dest_count_24h long, late boolean, purged boolean"
#: Keys (a JSON list) and 64-bit numbers: entries and highest step of each key, step and count of each entry.
STATE_SCHEMA = "keys string, sizes binary, tops binary, steps binary, counts binary"
#: Part of what a checkpoint holds: another number needs a new checkpoint.
BUCKETS = 1024


def _more(order) -> list[str]:
    return [c for c in order if c != "seq"]


def tag_transactions(txn: DataFrame, key: str = "nameDest", carry=(), order=("seq",)) -> DataFrame:
    """Transactions as control rows; ``carry`` columns ride along to the output."""
    return txn.select(
        F.col(key).alias("key"), F.col("seq").cast("long"), F.lit("txn").alias("kind"), F.col("step").cast("int"),
        *_more(order), *carry,
    )


def tag_purges(purges: DataFrame, key: str = "account_id", seq: str = "seq", order=("seq",)) -> DataFrame:
    """Erasure messages as control rows."""
    return purges.select(
        F.col(key).alias("key"), F.col(seq).cast("long").alias("seq"), F.lit("purge").alias("kind"),
        F.lit(None).cast("int").alias("step"), *_more(order),
    )


def control_stream(txn: DataFrame, purges: DataFrame | None = None, carry=(), order=("seq",)) -> DataFrame:
    """One ordered control flow of transactions and purges."""
    t = tag_transactions(txn, carry=carry, order=order)
    return t if purges is None else t.unionByName(tag_purges(purges, order=order), allowMissingColumns=True)


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<i8")


def _load(state: GroupState) -> dict:
    """key -> (its live steps ascending, their counts, highest step)."""
    if not state.exists:
        return {}
    keys, sizes, tops, steps, counts = state.get
    sizes, tops, steps, counts = (_numbers(x) for x in (sizes, tops, steps, counts))
    ends = np.cumsum(sizes)
    return {k: (steps[e - n : e], counts[e - n : e], t) for k, n, e, t in zip(json.loads(keys), sizes.tolist(), ends.tolist(), tops.tolist(), strict=True)}


def _save(state: GroupState, kept: dict) -> None:
    if not kept:
        state.remove()
        return
    one = lambda i: np.concatenate([v[i] for v in kept.values()]).astype("<i8").tobytes()
    sizes, tops = ([len(v[0]) for v in kept.values()], [v[2] for v in kept.values()])
    state.update((json.dumps(list(kept)), np.array(sizes, "<i8").tobytes(), np.array(tops, "<i8").tobytes(), one(0), one(1)))


def _in_order(code, step, n_keys, old, window, lateness):
    """Fan-in of rows whose steps never decrease inside a key and start at or after every
    step in its state. Eviction then only removes steps below every row's window, so each
    row counts the state entries and the earlier rows of its key with step >= its step - window.

    ``code``: the key's number of each row, ascending; ``old``: the state of each number
    or None. Returns (fan-in, the state of each number)."""
    n = len(code)
    held = [(i, o) for i, o in enumerate(old) if o is not None and len(o[0])]
    empty = np.zeros(0, dtype=np.int64)
    s_code = np.repeat([i for i, _ in held], [len(o[0]) for _, o in held]).astype(np.int64)
    s_step = np.concatenate([empty, *[o[0] for _, o in held]])
    s_count = np.concatenate([empty, *[o[1] for _, o in held]])
    steps = np.concatenate([s_step, step])
    base = steps.min() - window - 1
    width = int(steps.max() - base) + 1
    place, s_place = code * width + (step - base), s_code * width + (s_step - base)
    low = place - window
    total = np.concatenate([[0], np.cumsum(s_count)])
    from_state = total[np.searchsorted(s_code, code, side="right")] - total[np.searchsorted(s_place, low, side="left")]
    fans = from_state + np.arange(n) - np.searchsorted(place, low, side="left")

    cells, where = np.unique(np.concatenate([s_place, place]), return_inverse=True)
    counts = np.bincount(where, weights=np.concatenate([s_count, np.ones(n)])).astype(np.int64)
    c_code, c_step = cells // width, cells % width + base
    ends = np.searchsorted(c_code, np.arange(n_keys), side="right")
    tops = c_step[ends - 1]
    live = c_step >= tops[c_code] - window - lateness
    c_code, c_step, counts = c_code[live], c_step[live], counts[live]
    ends = np.searchsorted(c_code, np.arange(n_keys + 1))
    return fans, [(c_step[lo:hi], counts[lo:hi], t) for lo, hi, t in zip(ends[:-1].tolist(), ends[1:].tolist(), tops.tolist(), strict=True)]


def _in_order_run(seg, live, max_step, window, lateness, out_fan, offset):
    """Vectorized fan-in for a run of non-decreasing steps that starts at or
    after every step in the state. Eviction then only removes steps below
    every row's window, so each row counts the state entries and the earlier
    rows of the run with step >= its step - window."""
    if live:
        st = np.array(sorted(live), dtype=np.int64)
        cnt = np.array([live[x] for x in st], dtype=np.int64)
        suffix = np.concatenate([np.cumsum(cnt[::-1])[::-1], [0]])
        from_state = suffix[np.searchsorted(st, seg - window, side="left")]
    else:
        from_state = np.zeros(len(seg), dtype=np.int64)
    idx = np.arange(len(seg))
    from_run = idx - np.searchsorted(seg, seg - window, side="left")
    fans = from_state + from_run
    for k, v in enumerate(fans.tolist()):
        out_fan[offset + k] = v
    values, counts = np.unique(seg, return_counts=True)
    for v, c in zip(values.tolist(), counts.tolist()):
        live[v] = live.get(v, 0) + c
    max_step = int(seg[-1]) if max_step is None else max(max_step, int(seg[-1]))
    floor = max_step - window - lateness
    return {st_: c for st_, c in live.items() if st_ >= floor}, max_step


def _row_by_row(seg, live, max_step, window, lateness, out_fan, out_late, offset):
    """General case (steps out of order): apply events one at a time."""
    for k, s in enumerate(seg.tolist()):
        late = max_step is not None and s < max_step - window - lateness
        out_fan[offset + k] = sum(c for st_, c in live.items() if s - window <= st_ <= s)
        out_late[offset + k] = bool(late)
        live[s] = live.get(s, 0) + 1
        max_step = s if max_step is None else max(max_step, s)
        floor = max_step - window - lateness
        live = {st_: c for st_, c in live.items() if st_ >= floor}
    return live, max_step


def _one_key(steps, is_purge, old, window, lateness):
    """Rows of one key in arrival order, with purges and steps in any order: (fan-in, late, purged, state or None)."""
    n = len(steps)
    fan, late, purged = [0] * n, [False] * n, [False] * n
    live, max_step = (dict(zip(old[0].tolist(), old[1].tolist(), strict=True)), old[2]) if old else ({}, None)
    i = 0
    while i < n:
        if is_purge[i]:
            purged[i] = max_step is not None
            live, max_step = {}, None
            i += 1
            continue
        j = i
        while j < n and not is_purge[j]:
            j += 1
        seg = steps[i:j]
        if (max_step is None or seg[0] >= max_step) and bool(np.all(seg[1:] >= seg[:-1])):
            live, max_step = _in_order_run(seg, live, max_step, window, lateness, fan, i)
        else:
            live, max_step = _row_by_row(seg, live, max_step, window, lateness, fan, late, i)
        i = j
    if max_step is None:
        return fan, late, purged, None
    items = sorted(live.items())
    return fan, late, purged, (np.array([s for s, _ in items], dtype=np.int64), np.array([c for _, c in items], dtype=np.int64), max_step)


def _make_fn(window: int, lateness: int, order=("seq",), idle: str | None = None):
    def fan_in_fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        batch = pd.concat(list(pdfs), ignore_index=True).sort_values(list(order), kind="stable", ignore_index=True)
        kept, n = _load(state), len(batch)
        # rows by key, in arrival order inside a key
        code, names = pd.factorize(batch["_key"], use_na_sentinel=False)
        names = [None if pd.isna(k) else k for k in names]
        rows = np.argsort(code, kind="stable")
        code = code[rows].astype(np.int64)
        is_purge = (batch["kind"] == "purge").to_numpy()[rows]
        unknown = batch["step"].isna().to_numpy()[rows]
        step = batch["step"].to_numpy(dtype="float64", na_value=np.nan)[rows]
        with np.errstate(invalid="ignore"):
            step = step.astype(np.int64)
        fan, late, purged = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)

        old = [kept.get(k) for k in names]
        starts = np.searchsorted(code, np.arange(len(names) + 1))
        mixed = np.zeros(len(names), dtype=bool)
        mixed[code[is_purge | unknown]] = True
        mixed[code[1:][(code[1:] == code[:-1]) & (step[1:] < step[:-1])]] = True
        mixed |= [o is not None and s < o[2] for o, s in zip(old, step[starts[:-1]].tolist(), strict=True)]
        plain = ~mixed[code]
        if plain.any():
            number = np.cumsum(~mixed) - 1
            whose = np.flatnonzero(~mixed).tolist()
            fan[plain], found = _in_order(number[code[plain]], step[plain], len(whose), [old[i] for i in whose], window, lateness)
            kept.update(zip([names[i] for i in whose], found, strict=True))
        for i in np.flatnonzero(mixed).tolist():
            at = slice(starts[i], starts[i + 1])
            fan[at], late[at], purged[at], now = _one_key(step[at], is_purge[at], old[i], window, lateness)
            kept.pop(names[i], None)
            if now is not None:
                kept[names[i]] = now
        _save(state, kept)
        if idle and kept:
            state.setTimeoutDuration(int(pd.Timedelta(idle).total_seconds() * 1000))
        back = np.empty(n, dtype=np.int64)
        back[rows] = np.arange(n)
        out = batch.drop(columns=["_key", "_bucket"], errors="ignore")
        out["fan_in_dest_count_24h"] = pd.arrays.IntegerArray(fan[back], is_purge[back])
        out["late"] = late[back]
        out["purged"] = purged[back]
        yield out

    return fan_in_fn


def fan_in_state(
    control: DataFrame,
    window: int = FAN_IN_WINDOW_STEPS,
    lateness: int = 0,
    order=("seq",),
    idle: str | None = None,
) -> DataFrame:
    """Apply the keyed fan-in state to a tagged control stream.

    Output: one row per input row (``txn`` rows carry ``fan_in_dest_count_24h``
    and ``late``; ``purge`` rows carry ``purged``).
    """
    if not control.isStreaming:
        raise ValueError("keyed fan-in state runs on streams; batch frames use operators.fanin.fan_in_arrival")
    out_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in control.schema.fields)
    keyed = control.withColumn("_key", F.col("key").cast("string"))
    if not idle:
        keyed = keyed.withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(BUCKETS)))
    return keyed.groupBy("_key" if idle else "_bucket").applyInPandasWithState(
        _make_fn(window, lateness, tuple(order), idle),
        outputStructType=f"{out_schema}, {RESULT_FIELDS}",
        stateStructType=STATE_SCHEMA,
        outputMode="append",
        timeoutConf=GroupStateTimeout.ProcessingTimeTimeout if idle else GroupStateTimeout.NoTimeout,
    )
