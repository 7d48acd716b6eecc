"""Gold mart: the nine features, ``step``, label and ``type``; no ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.operators.silver import silver
from fraudlake.paths import delete_path, guard_output, list_names
from fraudlake.schemas import FAN_IN_WINDOW_STEPS, GOLD_COLUMNS


def gold(silver_df: DataFrame) -> DataFrame:
    return silver_df.select(*GOLD_COLUMNS)


def write_gold(
    gold_df: DataFrame, path: str, sources: tuple[str, ...] = (), mode: str = "overwrite", keep_other_types: bool = False, by_step: bool = False,
) -> None:
    """Rebuild the mart partitioned by ``type`` (``by_step``: and ``step``, which :func:`refresh_gold` needs).

    The whole mart is replaced: a type that is gone from the new data is gone from the
    mart. With ``keep_other_types`` only the partitions present in the new data are
    replaced (a rebuild of some types). With ``by_step`` the rows of a folder are brought
    together first, so there is about a file a folder, however many tasks there were;
    Spark splits what is too large for one task.
    """
    guard_output(path, sources)
    if by_step:
        gold_df = gold_df.hint("rebalance", "type", "step")
    (
        gold_df.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if keep_other_types else "static")
        .partitionBy("type", *["step"] * by_step)
        .parquet(path)
    )


def intervals(steps) -> list[tuple[int, int]]:
    """Runs of consecutive numbers."""
    out: list[tuple[int, int]] = []
    for s in sorted(set(steps)):
        if out and s <= out[-1][1] + 1:
            out[-1] = (out[-1][0], s)
        else:
            out.append((s, s))
    return out


def _within(runs: list[tuple[int, int]], column: str = "step"):
    found = F.lit(False)
    for lo, hi in runs:
        found = found | F.col(column).between(lo, hi)
    return found


def halo(bronze: DataFrame, runs: list[tuple[int, int]], window: int = FAN_IN_WINDOW_STEPS) -> DataFrame:
    """The Bronze rows that the fan-in of the steps in ``runs`` counts: a range filter that reaches the scan."""
    return bronze.where(_within([(lo - window, hi) for lo, hi in runs]))


def refresh_gold(
    bronze: DataFrame,
    registry: DataFrame | None,
    changed: DataFrame,
    path: str,
    sources: tuple[str, ...] = (),
    keep: tuple[str, ...] = (),
    window: int = FAN_IN_WINDOW_STEPS,
) -> list[tuple[int, int]]:
    """Bring a mart written ``by_step`` up to date after rows of some steps changed in Bronze.

    ``changed`` has a column ``step``: rows were added, removed or altered there. A row's
    fan-in counts its destination's rows up to ``window`` steps back, so the steps up to
    ``window`` behind a changed one are rebuilt, from the Bronze rows of those steps and
    of ``window`` steps before them; nothing else is read or written. Partitions of
    rebuilt steps that have no rows any more are deleted. Running it again gives the same
    mart, so a run that died is repeated. A change of the registry changes ids, not
    features, except where two accounts share an alias: rebuild the mart then. Returns
    the intervals of steps that were rebuilt.
    """
    guard_output(path, sources)
    spark = bronze.sparkSession
    touched = [r["step"] for r in changed.where("step IS NOT NULL").select("step").distinct().collect()]  # hours of the calendar
    runs = intervals(s + d for s in touched for d in range(window + 1))
    if not runs:
        return []
    rows = silver(halo(bronze, runs, window), registry, keep=keep).select(*GOLD_COLUMNS, *keep).where(_within(runs))
    write_gold(rows, path, sources, keep_other_types=True, by_step=True)
    wanted = {(r["type"], r["step"]) for r in halo(bronze, runs, 0).select("type", "step").distinct().collect()}  # types times hours
    for folder in list_names(spark, path):
        if folder.startswith("type="):
            kind = folder.split("=", 1)[1]
            for name in list_names(spark, f"{path}/{folder}"):
                step = int(name.split("=", 1)[1]) if name.startswith("step=") and name[5:].lstrip("-").isdigit() else None
                if step is not None and any(lo <= step <= hi for lo, hi in runs) and (kind, step) not in wanted:
                    delete_path(spark, f"{path}/{folder}/{name}")
    return runs
