"""The medallion chain over the fixture tables, as reusable lazy frames.

ingest -> quality fork -> mask + features -> mart. Everything is lazy: each
function returns a DataFrame plan, Catalyst prunes what a query does not use.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from fraudlake.functions import quality
from fraudlake.operators import erasure
from fraudlake.operators import evaluate as ev
from fraudlake.operators.gold import gold as gold_projection
from fraudlake.operators.silver import silver as silver_layer
from pyspark.sql import functions as F

from fraudlake.schemas import GOLD_COLUMNS, SCORABLE_TYPES
from fraudlake.sources import fixtures
from fraudlake.session import checkpoint_root
from fraudlake.sources.fixtures import FIXTURE_PEPPER


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.transactions(spark, sf_dir)


def reasoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_dq(transactions(spark, sf_dir))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted rows (the Bronze table)."""
    return quality.accepted(reasoned(spark, sf_dir)).drop("reasons")


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rejected(reasoned(spark, sf_dir))


def registry(spark: SparkSession, sf_dir: str, pepper: str = FIXTURE_PEPPER) -> DataFrame:
    rows, _ = erasure.build_registry(fixtures.erasure_requests(spark, sf_dir), pepper)
    return rows


def silver(spark: SparkSession, sf_dir: str, scale_form: bool = True) -> DataFrame:
    return silver_layer(bronze(spark, sf_dir), registry(spark, sf_dir), scale_form=scale_form, keep=("seq",))


def gold(spark: SparkSession, sf_dir: str, scale_form: bool = True) -> DataFrame:
    return silver(spark, sf_dir, scale_form).select(*GOLD_COLUMNS, "seq")


def gold_of(bronze_rows: DataFrame, registry_rows: DataFrame) -> DataFrame:
    """Gold (+ seq) of any Bronze rows."""
    return silver_layer(bronze_rows, registry_rows, keep=("seq",)).select(*GOLD_COLUMNS, "seq")


def gold_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_projection(silver(spark, sf_dir))


# --- scoring chain and evaluation inputs -------------------------------------------

def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch twin of the live scorer over every transaction."""
    from fraudlake.operators.score import score_chain

    return score_chain(transactions(spark, sf_dir))


def extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fraudlake.operators.split import extract_training

    return extract_training(silver(spark, sf_dir), keep=("seq",))


def labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, float]:
    from fraudlake.operators.split import split_cut, with_split

    ex = extract(spark, sf_dir)
    # Silver keeps Bronze's rows one to one (the registry is unique per
    # account, fan-in joins back on a unique key) and never changes ``step``,
    # so the cut is taken from Bronze's scorable rows: no joins or windows.
    scorable_steps = bronze(spark, sf_dir).where(F.col("type").isin(*SCORABLE_TYPES)).select("step")
    cut = split_cut(scorable_steps)
    return with_split(ex, cut), cut


class Evaluation:
    """The scorecard judged: the threshold comes from the validation slice (the end of the
    training period), curves and statistics from the test window. Parts are built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, weights=None):
        self.spark, self.sf_dir, self.weights = spark, sf_dir, weights

    @cached_property
    def judged(self) -> DataFrame:
        """Scored rows of both parts: columns ``part``, ``score`` and ``label``."""
        from fraudlake.operators.score import SCORECARD_WEIGHTS, scorecard_probability
        from fraudlake.operators.split import nested_cuts

        # the cuts are taken from Bronze's scorable rows, as in ``labelled``
        steps = bronze(self.spark, self.sf_dir).where(F.col("type").isin(*SCORABLE_TYPES)).select("step")
        cut, valid_cut = nested_cuts(steps)
        part = F.when(F.col("step") > F.lit(cut), "test").otherwise("validation")
        rows = extract(self.spark, self.sf_dir).where(F.col("step") > F.lit(valid_cut)).withColumn("part", part)
        return rows.withColumns({"score": scorecard_probability(self.weights or SCORECARD_WEIGHTS), "label": F.col("is_fraud")})

    @property
    def scored(self) -> DataFrame:
        """The test rows."""
        return self.judged.where(F.col("part") == "test").drop("part")

    @cached_property
    def counts_by_part(self) -> DataFrame:
        # one pass over the scored rows; all that follows reads the small per-score
        # aggregate from the shared checkpoint
        checkpoint_root(self.spark)
        return ev.score_counts(self.judged, by=("part",)).checkpoint(eager=True)

    def _counts(self, part: str) -> DataFrame:
        return self.counts_by_part.where(F.col("part") == part).drop("part")

    @property
    def counts(self) -> DataFrame:
        return self._counts("test")

    @cached_property
    def points(self) -> DataFrame:
        return ev.curve_points(self.counts)

    @cached_property
    def best(self) -> DataFrame:
        return ev.best_threshold(ev.pr_curve(ev.curve_points(self._counts("validation"))))

    @cached_property
    def threshold(self) -> float:
        return ev.threshold_of(self.best)


def metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monitoring data points derived from ``events`` (metric name per type)."""
    from pyspark.sql import functions as F

    et = F.col("event_type")
    metric = (
        F.when(et == "error", "ScorerErrorCount")
        .when(et == "purchase", "FraudAlertCount")
        .when(et == "view", "ConsumerHeartbeat")
        .when(et == "click", "ScoredTransactions")
        .otherwise(et)
    )
    return fixtures.table(spark, sf_dir, "events").select("ts", metric.alias("metric"), F.lit(1).cast("long").alias("value"))
