"""Right-to-erasure jobs: registry, masking rewrite, cascade, audits.

All of them are batch jobs over a DataFrame of requests: a batch of requests
is matched against each table in one join (both id columns), never one pass
per account.
"""

from __future__ import annotations

import json
import logging
import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fraudlake.functions.alias import account_alias
from fraudlake.functions.quality import account_id_valid
from fraudlake.paths import create_if_absent, delete_path, fingerprint, list_names, path_exists, read_text, rename_path
from fraudlake.schemas import AUDIT, REGISTRY, REQUEST_ID_HEX_CHARS, REQUEST_ID_PREFIX
from fraudlake.session import checkpoint_root
from fraudlake.sinks import append_log

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ID_COLUMNS = ("name_orig", "name_dest")
_COUNTS = "account_id string, _c long"


def iso_utc(ts_col) -> F.Column:
    """ISO-8601 text of a UTC timestamp, with the ``+00:00`` offset."""
    c = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    return F.concat(F.date_format(c.cast("timestamp_ntz"), ISO_FORMAT), F.lit("+00:00"))


def default_request_id(account_col="account_id", requested_at_col="requested_at") -> F.Column:
    """``req-`` + 8 hex of sha256(account || requested_at): a retry is idempotent."""
    digest = F.sha2(F.concat(F.col(account_col), F.col(requested_at_col)), 256)
    return F.concat(F.lit(REQUEST_ID_PREFIX), F.substring(digest, 1, REQUEST_ID_HEX_CHARS))


def build_registry(
    requests: DataFrame,
    pepper: str,
    requested_ts_col: str | None = "requested_ts",
) -> tuple[DataFrame, DataFrame]:
    """Requests -> (registry rows, rejected requests).

    Rows with an invalid account id go to the rejected set; valid ones get the
    keyed alias, a request id when none was supplied, and the ISO time.
    """
    ts = F.col(requested_ts_col) if requested_ts_col and requested_ts_col in requests.columns else F.current_timestamp()
    staged = requests.withColumn("requested_at", iso_utc(ts))
    valid = account_id_valid("account_id")
    good = staged.where(valid).select(
        "account_id",
        account_alias("account_id", pepper).alias("account_alias"),
        F.coalesce(F.col("request_id"), default_request_id()).alias("request_id"),
        "requested_at",
    )
    bad = staged.where(~valid).select("account_id", "request_id", F.lit("invalid account_id").alias("reason"))
    return good, bad


def registry_new_rows(new_rows: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Rows to append: one per request id (the earliest, then the smallest
    account; :func:`registry_conflicts` has the others), only ids not yet present."""
    cols = [c for c in REGISTRY.fieldNames() if c != "request_id"]
    first = F.min(F.struct("requested_at", "account_id", *[c for c in cols if c not in ("requested_at", "account_id")]))
    dedup = new_rows.groupBy("request_id").agg(first.alias("_r")).select("request_id", *[F.col(f"_r.{c}").alias(c) for c in cols])
    dedup = dedup.select(*REGISTRY.fieldNames())
    if existing is None:
        return dedup
    return dedup.join(existing.select("request_id"), "request_id", "left_anti").select(*REGISTRY.fieldNames())


def registry_conflicts(new_rows: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Requests rejected because their request id already names another account,
    in the batch or in the stored registry."""
    kept = registry_new_rows(new_rows, existing)
    holders = (kept if existing is None else kept.unionByName(existing.select(*REGISTRY.fieldNames()))).select("request_id", "account_id")
    other = new_rows.join(holders, ["request_id", "account_id"], "left_anti")
    return other.select("account_id", "request_id", F.lit("request_id names another account").alias("reason")).distinct()


def read_registry(spark: SparkSession, path: str) -> DataFrame | None:
    """The registry table, or None when it has never been written.

    Any other read error propagates: an unreadable registry must not be
    mistaken for an empty one.
    """
    return append_log.read(spark, path, REGISTRY)


def register_requests(spark: SparkSession, rows: DataFrame, path: str, on_step=lambda step: None) -> tuple[int, DataFrame]:
    """Append the new registry rows; returns (rows appended, rejected requests).

    Several writers may append at once: each request id is stored once, and the
    requests that lost their id to another account are rejected by the registry they
    were checked against."""
    n, before = append_log.append(spark, path, REGISTRY, lambda table: registry_new_rows(rows, table), on_step=on_step)
    return n, registry_conflicts(rows, before)


def append_registry(spark: SparkSession, rows: DataFrame, path: str) -> int:
    """Append-only write of the new registry rows; returns rows appended."""
    return register_requests(spark, rows, path)[0]


def register_external(spark: SparkSession, name: str, path: str, partitioned: bool = False) -> None:
    """External table over an existing parquet location, partitions discovered."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def ordered_registry(registry: DataFrame) -> DataFrame:
    return registry.select("request_id", "account_alias", "requested_at").orderBy("requested_at", "request_id")


def _alias_map(requests: DataFrame, pepper: str | None) -> DataFrame:
    """Account and alias of the valid requests; registry rows bring their alias, so no pepper is needed."""
    valid = requests.where(account_id_valid("account_id"))
    if "account_alias" in requests.columns:
        return valid.groupBy("account_id").agg(F.min("account_alias").alias("account_alias"))
    if pepper is None:
        raise ValueError("requests without an alias need a pepper")
    return valid.select("account_id").distinct().select("account_id", account_alias("account_id", pepper).alias("account_alias"))


def erased_cells(table: DataFrame, requests: DataFrame, pepper: str | None = None, id_columns=ID_COLUMNS) -> DataFrame:
    """Cells holding an erased raw id, counted per account.

    Each present id column is unpivoted to (account, 1) and matched against the
    request batch in one join; partial aggregation before the shuffle keeps a
    hot account cheap.
    """
    cols = [c for c in id_columns if c in table.columns]
    amap = _alias_map(requests, pepper)
    if not cols:
        return amap.select("account_id", "account_alias", F.lit(0).cast("long").alias("cells"))
    cells = table.select(F.explode(F.array(*[F.col(c) for c in cols])).alias("account_id"))
    hits = cells.join(amap.select("account_id"), "account_id", "left_semi").groupBy("account_id").agg(
        F.count(F.lit(1)).alias("cells")
    )
    return amap.join(hits, "account_id", "left").select(
        "account_id", "account_alias", F.coalesce(F.col("cells"), F.lit(0)).cast("long").alias("cells")
    )


def rows_and_cells(table: DataFrame, amap: DataFrame, id_columns=ID_COLUMNS) -> tuple[int, int]:
    """(rows, cells holding an erased raw id) of a table with id columns, from one pass."""
    cols = [c for c in id_columns if c in table.columns]
    cells = table.select(F.explode(F.array(*[F.col(c) for c in cols])).alias("account_id"))
    known = amap.select("account_id", F.lit(1).alias("_hit"))  # unique per account
    found = cells.join(known, "account_id", "left").agg(F.count(F.lit(1)).alias("n"), F.count("_hit").alias("cells")).first()
    return found["n"] // len(cols), found["cells"]


def anonymize(table: DataFrame, amap: DataFrame, id_columns=ID_COLUMNS) -> DataFrame:
    """Project each erased raw id to its alias (columns that exist only).

    The alias map is joined once per id column under a different alias, so
    its broadcast is built once and reused."""
    cols = [c for c in id_columns if c in table.columns]
    out = table
    for i, c in enumerate(cols):
        out = out.join(amap.alias(f"_m{i}"), F.col(c) == F.col(f"_m{i}.account_id"), "left")
    return out.select(
        *[
            F.coalesce(F.col(f"_m{cols.index(c)}.account_alias"), table[c]).alias(c) if c in cols else table[c]
            for c in table.columns
        ]
    )


# --- crash-safe rewrite ----------------------------------------------------------------
# Beside a table that is being rewritten lies ``<table>.__erase__`` with
#   copy          the rewritten rows (all, or those of the partitions with hits)
#   counts-<id>   cells replaced per account (and partition, where the table has them)
#   intent        written in one step when copy and counts are complete and verified
#   old           the table, once moved aside (tables without partitions)
#   done-<id>     the counts of finished rewrites, kept until the caller has used them
# Without an intent nothing has been touched; with one a rerun completes the swap.


def _job(path: str) -> str:
    return f"{path.rstrip('/')}.__erase__"


def _staged_rewrite(spark: SparkSession, path: str, amap: DataFrame, parts: list[str], on_step) -> bool:
    """Write and verify the rewritten copy and its intent; False where the table holds no requested id."""
    job, run = _job(path), uuid.uuid4().hex
    state = fingerprint(spark, path)
    df = spark.read.parquet(path)
    cols = [c for c in ID_COLUMNS if c in df.columns]
    if not cols:
        return False
    counts_path = f"{job}/counts-{run}"
    hits = [F.col(c).alias(f"_hit_{c}") for c in parts]
    found = df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias("account_id"), *hits).join(amap.select("account_id"), "account_id", "left_semi")
    found.groupBy("account_id", *[f"_hit_{c}" for c in parts]).agg(F.count(F.lit(1)).alias("_c")).write.parquet(counts_path)
    n_cells = spark.read.schema(_COUNTS).parquet(counts_path).agg(F.sum("_c")).first()[0] or 0
    if n_cells == 0:
        delete_path(spark, counts_path)
        return False
    scope = df
    if parts:
        # null-safe: rows may lack a partition value
        on = [df[c].eqNullSafe(F.col(f"_hit_{c}")) for c in parts]
        hit_parts = spark.read.parquet(counts_path).select(*[f"_hit_{c}" for c in parts]).distinct()
        scope = df.join(hit_parts, on, "left_semi")
    expected, in_scope = rows_and_cells(scope, amap)
    anonymize(scope, amap).write.mode("overwrite").parquet(f"{job}/copy")
    copied, left = rows_and_cells(spark.read.schema(df.schema).parquet(f"{job}/copy"), amap)
    if copied != expected:
        raise RuntimeError(f"staging row count mismatch for {path}; table left unchanged")
    if left or in_scope != n_cells:
        raise RuntimeError(f"the staged copy for {path} does not replace every requested id; table left unchanged")
    if fingerprint(spark, path) != state:
        raise RuntimeError(f"{path} was written to during its rewrite; table left unchanged")
    intent = {"run": run, "parts": parts, "state": state, "schema": df.schema.json()}
    if not create_if_absent(spark, f"{job}/intent", json.dumps(intent)):
        raise RuntimeError(f"another rewrite of {path} is under way")
    on_step("staged")
    return True


def _complete_rewrite(spark: SparkSession, path: str, on_step=lambda step: None) -> None:
    """Carry out an intent from wherever it stopped."""
    job = _job(path)
    intent = json.loads(read_text(spark, f"{job}/intent"))
    copy, old = f"{job}/copy", f"{job}/old"
    if intent["parts"]:
        # Spark swaps the partitions in at job commit; doing it again gives the same table
        schema = StructType.fromJson(json.loads(intent["schema"]))
        staged = spark.read.schema(schema).parquet(copy)
        staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*intent["parts"]).parquet(path)
        on_step("moved in")
    else:
        if path_exists(spark, copy):
            if not path_exists(spark, old):
                if not rename_path(spark, path, old):
                    raise RuntimeError(f"could not move {path} aside; table left unchanged")
                on_step("moved aside")
            if path_exists(spark, path):
                raise RuntimeError(f"{path} was written anew while its rewrite was under way: {old} and {copy} are left for inspection")
            if not rename_path(spark, copy, path):
                raise RuntimeError(f"could not move the rewritten copy into {path}; run again to complete it")
        on_step("moved in")
    run = intent["run"]
    if path_exists(spark, f"{job}/counts-{run}") and not rename_path(spark, f"{job}/counts-{run}", f"{job}/done-{run}"):
        raise RuntimeError(f"could not keep the counts of {path}")
    delete_path(spark, f"{job}/intent")
    delete_path(spark, copy)
    delete_path(spark, old)
    on_step("done")


def recover_table(spark: SparkSession, path: str) -> str:
    """Bring a table whose rewrite was interrupted back to one whole state.

    Returns "clean" (nothing to do), "dropped" (an unfinished copy was deleted, the table
    is as it was) or "completed" (the rewritten table is in place). Call it with no other
    rewrite of the table running.
    """
    job = _job(path)
    names = list_names(spark, job)
    if "intent" in names:
        intent = json.loads(read_text(spark, f"{job}/intent"))
        untouched = "old" not in names and not intent["parts"] and path_exists(spark, path) and "copy" in names
        if not untouched or fingerprint(spark, path) == intent["state"]:
            _complete_rewrite(spark, path)
            return "completed"
        delete_path(spark, f"{job}/intent")  # the table has grown since: rewrite it anew
    left = [n for n in list_names(spark, job) if not n.startswith("done-")]
    for n in left:
        delete_path(spark, f"{job}/{n}")
    return "dropped" if left else "clean"


def forget_rewrites(spark: SparkSession, table_paths: list[str]) -> None:
    """Drop the kept counts of finished rewrites."""
    for path in table_paths:
        delete_path(spark, _job(path))


def erase_tables(
    spark: SparkSession,
    table_paths: list[str],
    requests: DataFrame,
    pepper: str | None = None,
    partition_cols: dict[str, list[str]] | None = None,
    keep_counts: bool = False,
    on_step=lambda path, step: None,
) -> DataFrame:
    """Rewrite each table with erased ids replaced by their alias.

    Returns one row per requested account: ``account_id, account_alias,
    rows_anonymized`` (cells replaced over all tables). Requests with an invalid
    account id change nothing; registry rows may be passed as requests (their
    alias is used). A listed table that does not exist raises.

    Each table is first written to a copy beside it (Spark cannot overwrite what it
    reads), which must have as many rows and hold no requested id; an intent then makes
    the swap certain. A run that dies anywhere is completed by calling again with the
    same requests: unfinished copies are dropped, intents carried out, and the cells
    that the dead run has replaced are counted. While the two folders of a table
    without partitions change places, readers find none at its path for a moment; in a
    partitioned table only the partitions with a hit are replaced. One rewrite of a
    table at a time, and no appends to it meanwhile. ``keep_counts`` keeps what a rerun
    must count until :func:`forget_rewrites`. ``on_step(path, step)`` is called behind
    "staged", "moved aside", "moved in" and "done".
    """
    partition_cols = partition_cols or {}
    amap = _alias_map(requests, pepper)
    checkpoint_root(spark)
    amap = amap.checkpoint(eager=True)  # the requests may be read from a table that is rewritten
    done = []
    for path in table_paths:
        recover_table(spark, path)
        if not path_exists(spark, path):
            raise FileNotFoundError(f"table {path} does not exist")
        step = partial(on_step, path)
        if _staged_rewrite(spark, path, amap, partition_cols.get(path, []), step):
            _complete_rewrite(spark, path, step)
        done += [f"{_job(path)}/{n}" for n in list_names(spark, _job(path)) if n.startswith("done-")]
    out = amap.select("account_id", "account_alias", F.lit(0).cast("long").alias("rows_anonymized"))
    if done:
        summed = spark.read.schema(_COUNTS).parquet(*done).groupBy("account_id").agg(F.sum("_c").alias("_n"))
        out = amap.join(summed, "account_id", "left").select("account_id", "account_alias", F.coalesce("_n", F.lit(0)).cast("long").alias("rows_anonymized"))
    if not keep_counts:
        out = out.checkpoint(eager=True)  # its source is dropped here
        forget_rewrites(spark, table_paths)
    return out


def erasure_results(
    requests: DataFrame,
    cells_per_account: DataFrame,
    published: bool | F.Column = True,
    requested_ts_col: str = "requested_ts",
) -> DataFrame:
    """Cascade response rows: ``request_id, account_alias, status,
    streaming_purge_published, rows_anonymized, timestamp``.

    Invalid account ids get status ``rejected`` and no alias.
    """
    ts = F.col(requested_ts_col) if requested_ts_col in requests.columns else F.current_timestamp()
    staged = requests.withColumn("_iso", iso_utc(ts)).withColumn("_valid", account_id_valid("account_id"))
    joined = staged.join(cells_per_account.select("account_id", "account_alias", "cells"), "account_id", "left")
    pub = published if isinstance(published, F.Column) else F.lit(bool(published))
    return joined.select(
        F.coalesce(F.col("request_id"), default_request_id("account_id", "_iso")).alias("request_id"),
        F.when(F.col("_valid"), F.col("account_alias")).alias("account_alias"),
        F.when(F.col("_valid"), F.lit("erasure_requested")).otherwise(F.lit("rejected")).alias("status"),
        (F.col("_valid") & pub).alias("streaming_purge_published"),
        F.when(F.col("_valid"), F.coalesce(F.col("cells"), F.lit(0))).otherwise(F.lit(0)).cast("long").alias("rows_anonymized"),
        F.col("_iso").alias("timestamp"),
    )


def purge_messages(requests: DataFrame) -> DataFrame:
    """Control-topic messages that make the streaming state forget an account."""
    valid = requests.where(account_id_valid("account_id"))
    return valid.select(
        F.col("account_id").alias("key"),
        F.to_json(F.struct("account_id", "request_id")).alias("value"),
    )


def submit_erasure(
    spark: SparkSession,
    requests: DataFrame,
    pepper: str,
    registry_path: str,
    table_paths: list[str],
    audit_path: str,
    publish,
    partition_cols: dict[str, list[str]] | None = None,
    on_step=lambda path, step: None,
) -> DataFrame:
    """The cascade: registry, purge messages, table rewrite, audit.

    ``publish(messages)`` sends the control-topic frame; if it raises, the cascade
    goes on and the results say ``streaming_purge_published = false``, so the same
    requests can be submitted again (each step is idempotent). Invalid requests and
    requests whose id names another account, in the batch or in the stored registry, are
    ``rejected``: the registry decides before anything is published or rewritten. A
    cascade that dies is completed by submitting again; cells replaced by the dead run
    are counted in the audit.
    """
    ts = F.coalesce(F.col("requested_ts"), F.current_timestamp()) if "requested_ts" in requests.columns else F.current_timestamp()
    staged = requests.withColumn("requested_ts", ts).withColumn("_iso", iso_utc("requested_ts"))
    staged = staged.withColumn("request_id", F.coalesce("request_id", default_request_id("account_id", "_iso"))).drop("_iso")
    checkpoint_root(spark)
    staged = staged.checkpoint(eager=True)
    rows, _ = build_registry(staged, pepper)
    _, clash = register_requests(spark, rows, registry_path)
    clash = clash.select("account_id", "request_id").checkpoint(eager=True)
    try:
        publish(purge_messages(staged.join(clash, ["account_id", "request_id"], "left_anti")))
        published = True
    except Exception as e:  # the other steps must still run; the result tells
        published = False
        logging.getLogger("fraudlake").warning("purge messages not published: %s", e)
    aliases = rows.join(clash, ["account_id", "request_id"], "left_anti").select("account_id", "account_alias")
    done = erase_tables(spark, table_paths, aliases, None, partition_cols, keep_counts=True, on_step=on_step)
    cells = done.select("account_id", "account_alias", F.col("rows_anonymized").alias("cells"))
    marked = staged.join(clash.withColumn("_clash", F.lit(True)), ["account_id", "request_id"], "left")
    # an account may have a good request and a rejected one: the request decides
    good = erasure_results(marked.where("_clash IS NULL").drop("_clash"), cells, published)
    bad = erasure_results(marked.where("_clash").drop("_clash"), cells, published).withColumns(
        {"status": F.lit("rejected"), "account_alias": F.lit(None).cast("string"), "streaming_purge_published": F.lit(False), "rows_anonymized": F.lit(0).cast("long")}
    )
    results = good.unionByName(bad).checkpoint(eager=True)
    append_audit(audit_rows(results), audit_path)
    forget_rewrites(spark, table_paths)
    return results


def audit_rows(results: DataFrame) -> DataFrame:
    """Alias-only audit rows (never the raw id)."""
    return results.where(F.col("status") == "erasure_requested").select(
        "timestamp", "request_id", "account_alias", "streaming_purge_published", "rows_anonymized"
    )


def append_audit(rows: DataFrame, path: str) -> None:
    """Append the rows of one execution; several writers may append at once."""
    append_log.append(rows.sparkSession, path, AUDIT, lambda table: rows)


def read_audit(spark: SparkSession, path: str) -> DataFrame | None:
    return append_log.read(spark, path, AUDIT)


def duplicate_audit(df: DataFrame, keys: list[str]) -> DataFrame:
    """``rows``, ``distinct_keys`` and ``duplicate_rows`` (= rows - distinct)."""
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(
        F.sum("_n").cast("long").alias("rows"),
        F.count(F.lit(1)).cast("long").alias("distinct_keys"),
        (F.sum("_n") - F.count(F.lit(1))).cast("long").alias("duplicate_rows"),
    )


def duplicate_offenders(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def leak_audit(layers: dict[str, tuple[DataFrame, list[str]]], registry: DataFrame, allowed=("bronze",)) -> DataFrame:
    """Rows per (layer, column) still holding a registered raw id.

    Each layer is read once: its id columns are unpivoted to (column, id)
    pairs and matched against the registry in one semi join."""
    spark = registry.sparkSession
    ids = registry.select("account_id").distinct()
    expected, found = [], None
    for layer, (df, cols) in layers.items():
        cols = [c for c in cols if c in df.columns]
        if not cols:
            continue
        expected += [(layer, c, layer in allowed) for c in cols]
        pairs = df.select(
            F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("account_id")) for c in cols])).alias("p")
        ).select("p.column_name", "p.account_id")
        hits = pairs.join(ids, "account_id", "left_semi").groupBy("column_name").agg(
            F.count(F.lit(1)).cast("long").alias("leaked_rows")
        ).withColumn("layer", F.lit(layer))
        found = hits if found is None else found.unionByName(hits)
    frame = spark.createDataFrame(expected, "layer string, column_name string, allowed boolean")
    if found is None:
        return frame.select("layer", "column_name", F.lit(0).cast("long").alias("leaked_rows"), "allowed")
    # one row per expected (layer, column): a literal table of a few rows
    return frame.join(found, ["layer", "column_name"], "left").select(
        "layer", "column_name", F.coalesce(F.col("leaked_rows"), F.lit(0)).cast("long").alias("leaked_rows"), "allowed"
    )
