"""Appends to a parquet table by several writers at once.

A table is a folder of parquet files. Next to them ``_log`` holds one numbered entry
per append, written if absent: of two writers that want the same number one wins, the
other reads the table again and retries. A writer

1. notes the last number, reads the table and decides which rows are new,
2. writes them to ``_staged/<id>`` (folders with ``_`` are not read as data),
3. claims the next number with an entry that names the folder,
4. moves the files into the table.

A crash before 3 leaves nothing visible; after 3 the next reader or writer moves the
files in, so a claimed append is never lost and never doubled (file names come from
the folder, so moving twice is moving once).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fraudlake.paths import create_if_absent, delete_path, list_names, path_exists, read_text, rename_path


class TooManyWriters(RuntimeError):
    """Every attempt found its number taken."""


def last_number(spark: SparkSession, path: str) -> int:
    return max((int(n) for n in list_names(spark, f"{path}/_log") if n.isdigit()), default=0)


def _publish(spark: SparkSession, path: str, folder: str) -> None:
    staged = f"{path}/_staged/{folder}"
    for name in list_names(spark, staged):
        if name.endswith(".parquet"):
            target = f"{path}/{folder}-{name}"
            if not rename_path(spark, f"{staged}/{name}", target) and not path_exists(spark, target):
                raise RuntimeError(f"could not move {staged}/{name} into the table")
    delete_path(spark, staged)


def settle(spark: SparkSession, path: str) -> int:
    """Move in what claimed appends left behind; returns the last number."""
    last = last_number(spark, path)
    waiting = {f for f in list_names(spark, f"{path}/_staged") if any(n.endswith(".parquet") for n in list_names(spark, f"{path}/_staged/{f}"))}
    if waiting:
        for n in range(1, last + 1):
            folder = json.loads(read_text(spark, f"{path}/_log/{n}"))["folder"]
            if folder in waiting:
                _publish(spark, path, folder)
    return last


def read(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The table's rows, or None when it has never been written.

    Any other read error propagates: an unreadable table must not be mistaken for an
    empty one.
    """
    if not path_exists(spark, path):
        return None
    settle(spark, path)
    return spark.read.schema(schema).parquet(path)


def append(
    spark: SparkSession,
    path: str,
    schema,
    rows_for: Callable[[DataFrame | None], DataFrame],
    attempts: int = 50,
    on_step: Callable[[str], None] = lambda step: None,
) -> tuple[int, DataFrame | None]:
    """Append ``rows_for(table)``; returns (rows appended, the table they were checked against).

    ``rows_for`` gets the table as it is (None: never written) and is called again, on
    the newer table, whenever another writer was faster. ``on_step`` is called behind
    "staged" and "claimed" (tests stop a writer there).
    """
    for _ in range(attempts):
        number = settle(spark, path) + 1 if path_exists(spark, path) else 1
        before = read(spark, path, schema)
        folder = uuid.uuid4().hex
        staged = f"{path}/_staged/{folder}"
        rows_for(before).write.parquet(staged)
        n = spark.read.schema(schema).parquet(staged).count()
        on_step("staged")
        if not n:
            delete_path(spark, staged)
            if last_number(spark, path) + 1 == number:
                return 0, before
            continue
        if create_if_absent(spark, f"{path}/_log/{number}", json.dumps({"folder": folder, "rows": n})):
            on_step("claimed")
            _publish(spark, path, folder)
            return n, before
        delete_path(spark, staged)
    raise TooManyWriters(f"{attempts} appends to {path} found their number taken")
