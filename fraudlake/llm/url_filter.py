"""URL verdicts: allow and block rules, else a tree of path templates, in DataFrame functions only.

Per host, paths are walked segment by segment. At a node with more than ``KINDS``
different next segments that recur less than ``RECUR`` times on average, the segments
are a variable, and so is any segment with a digit: all but well-supported ones become the
wildcard ``*``. Then sibling
branches (templates that differ in one fixed segment) are merged into a wildcard
where the share of good labels does not differ significantly from that of their
siblings together (two-proportion z-test), the deepest segment first. A template is
rejected when its purity, the share of good labels smoothed towards the share over
all pages, is below ``PURITY``.

Cases: a null URL or one without ``://`` has an empty host and path and belongs to the
template of the empty host; segments beyond ``DEPTH`` are one last segment; pages without
a label count for the tree, not for purity; a template without labels has the purity of
all pages (1 without any labels); repeated page rows count each; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import saved

DEPTH = 6
KINDS, RECUR = 16, 20
SUPPORT, SUPPORT_SHARE = 50, 0.01
Z, WEIGHT, PURITY = 1.96, 10.0, 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What is between the first ``://`` and ``/``, ``?``, ``#`` or the end; A to Z lower-cased."""
    rest = F.substring_index(F.substring_index(F.substring_index(_behind(url), "/", 1), "?", 1), "#", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What is behind the host up to ``?``, ``#`` or the end."""
    rest = F.substring_index(F.substring_index(_behind(url), "?", 1), "#", 1)
    at = F.instr(rest, "/")
    return F.when(at > 0, F.substring(rest, at, F.length(rest))).otherwise(F.lit(""))


def _behind(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule of ``[(verdict, host/path)]``, null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def templates(paths: DataFrame) -> DataFrame:
    """``paths`` (host, path, ...) with ``node``: the path's template, variable segments as ``*``."""
    segments = F.array_remove(F.split("path", "/"), "")
    tail = F.when(F.size("segs") > DEPTH, F.concat(F.slice("segs", 1, DEPTH - 1), F.array(F.array_join(F.expr(f"slice(segs, {DEPTH}, size(segs))"), "/")))).otherwise(F.col("segs"))
    rows = saved(paths.withColumn("segs", segments).withColumn("segs", tail).withColumn("node", F.lit("")), "urls")
    for depth in range(1, DEPTH + 1):
        deeper = rows.where(F.size("segs") >= depth).select("host", "node", F.col("segs")[depth - 1].alias("seg"))
        kinds = saved(deeper.groupBy("host", "node", "seg").agg(F.count("*").alias("n")), "url-kinds")
        if kinds.isEmpty():
            break
        nodes = saved(kinds.groupBy("host", "node").agg(F.sum("n").alias("rows"), F.count("*").alias("kinds")), "url-nodes")
        variable = ((F.col("kinds") > KINDS) & (F.col("rows") < RECUR * F.col("kinds"))) | F.col("seg").rlike("[0-9]")
        backed = (F.col("n") >= SUPPORT) & (F.col("n") >= SUPPORT_SHARE * F.col("rows"))
        fixed = saved(kinds.join(nodes, ["host", "node"]).where(~variable | backed).select("host", "node", "seg"), "url-fixed")
        seg = F.when(F.size("segs") >= depth, F.col("segs")[depth - 1])
        joined = rows.withColumn("seg", seg).join(fixed.withColumn("fixed", F.lit(True)), ["host", "node", "seg"], "left")
        step = F.when(F.col("seg").isNull(), F.lit("")).otherwise(F.concat(F.lit("/"), F.when(F.col("fixed"), F.col("seg")).otherwise("*")))
        rows = saved(joined.withColumn("node", F.concat("node", step)).drop("seg", "fixed"), "urls")
    return rows.drop("segs")


def merged(stats: DataFrame) -> DataFrame:
    """Template rows (host, node, labelled, good) with ``final``: the node after merging similar siblings."""
    rows = stats.withColumn("final", F.col("node"))
    for depth in range(DEPTH, 0, -1):
        parts = F.split("final", "/")  # the first part is empty
        here = F.size(parts) > depth
        if rows.where(here).isEmpty():
            continue
        family = F.concat_ws("/", F.slice(parts, 1, depth), F.lit("*"), F.expr(f"slice(split(final, '/'), {depth + 2}, size(split(final, '/')))"))
        now = saved(rows.withColumn("family", F.when(here, family)), "url-merge")
        nodes = saved(
            now.where("family is not null").groupBy("host", "family", "final").agg(F.sum("labelled").alias("labelled"), F.sum("good").alias("good")), "url-merge"
        )
        pooled = saved(
            nodes.groupBy("host", "family").agg(F.sum("labelled").alias("all_labelled"), F.sum("good").alias("all_good"), F.count("*").alias("nodes")), "url-merge"
        )
        n, m = F.col("labelled").cast("double"), (F.col("all_labelled") - F.col("labelled")).cast("double")
        p = F.col("all_good") / F.greatest("all_labelled", F.lit(1))
        gap = F.col("good") / F.greatest(n, F.lit(1.0)) - (F.col("all_good") - F.col("good")) / F.greatest(m, F.lit(1.0))
        spread = p * (1 - p) * (1 / F.greatest(n, F.lit(1.0)) + 1 / F.greatest(m, F.lit(1.0)))
        alike = (n == 0) | (m == 0) | (gap * gap <= Z * Z * spread)
        moves = nodes.join(pooled, ["host", "family"]).where((F.col("nodes") > 1) & alike).select("host", "final", F.col("family").alias("to"))
        rows = saved(now.join(saved(moves, "url-merge"), ["host", "final"], "left").withColumn("final", F.coalesce("to", "final")).drop("to", "family"), "url-merge")
    return rows


def judge(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Verdicts of rows (page_id, url, label 1 good / 0 bad / null).

    (page_id, host, path, rule, verdict, template, purity).
    """
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("label").cast("int").alias("label"))
    rows = templates(parts)
    stats = saved(rows.groupBy("host", "node").agg(F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).alias("good")), "url-stats")
    total = stats.agg(F.sum("labelled").alias("n"), F.sum("good").alias("g")).first()
    base = total.g / total.n if total.n else 1.0
    final = merged(stats)
    purity = (F.col("good") + WEIGHT * base) / (F.col("labelled") + WEIGHT)
    pure = final.groupBy("host", "final").agg(F.sum("labelled").alias("labelled"), F.sum("good").alias("good")).select("host", "final", purity.alias("purity"))
    table = saved(final.select("host", "node", "final").join(saved(pure, "url-pure"), ["host", "final"]), "url-verdicts")
    verdict = F.coalesce(said, F.when(F.col("purity") >= PURITY, "allow").otherwise("block"))
    return rows.join(table, ["host", "node"]).select(
        "page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), F.concat("host", "final").alias("template"), F.round("purity", 9).alias("purity")
    )
