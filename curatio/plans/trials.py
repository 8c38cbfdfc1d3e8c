"""Trial-block summary of the voice symbol-substitution test.

Plan: crosswalk (distinct) -> left join onto trials -> one ``groupBy``
(participant, block) with all aggregates -> projection for the derived
ratios -> study-start HAVING -> two null-safe anti joins -> semi join with
the released baseline cohort.  The aggregation shuffles once on its key
(partial aggregation first); the crosswalk, lists and cohort join as
broadcasts when Spark's size check allows, otherwise as shuffle joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatio.functions.expr import c, half_even
from curatio.functions.rules import START_DATE
from curatio.operators.aggregates import strict
from curatio.operators.filters import since
from curatio.operators.joins import exclude, left_lookup, natural_keys, retain


def attach_participant(trials: DataFrame, crosswalk: DataFrame, key: str = "externalId",
                       participant: str = "healthCode") -> DataFrame:
    """``merge(trials, unique(crosswalk), all.x = TRUE)``.

    As R's ``merge`` without ``by``, the join uses every column the two share
    (the external id, plus the participant when the trials carry it too), on
    NA-matching keys.  Fans out when one external id maps to several
    participants; trials without a match are kept.
    """
    cw = crosswalk.select(c(key), c(participant)).distinct()
    return left_lookup(trials, cw, natural_keys(trials, cw))


def block_summary(
    trials: DataFrame,
    participant: str = "healthCode",
    block: str = "blockId",
    created: str = "createdOn",
    accuracy: str = "accuracy",
    duration_ms: str = "durationMS",
    na_strict: bool = True,
) -> DataFrame:
    """Per (participant, block): counts, accuracy and timing statistics.

    ``na_strict`` keeps R's default for ``min`` and ``sum(accuracy == 'y')``:
    one NULL input makes the block's value NULL (S8).  Mean and sd ignore
    NULLs; the mean of no values is NULL here (R gives NaN).
    """
    secs = c(duration_ms) / F.lit(1000.0)
    first_seen = F.min(c(created))
    n_correct = F.count_if(c(accuracy) == F.lit("y"))
    if na_strict:
        first_seen = strict(first_seen, created)
        n_correct = strict(n_correct, accuracy)
    agg = trials.groupBy(c(participant), c(block)).agg(
        F.count(F.lit(1)).alias("numDigits"),
        first_seen.alias("activityStartTime_GMT"),
        n_correct.alias("numCorrect"),
        half_even(F.avg(secs), 3).alias("avgTime"),
        half_even(F.stddev_samp(secs), 3).alias("sdTime"),
        F.coalesce(F.sum(secs), F.lit(0.0)).alias("totalTime"),
    )
    pct = F.lit(100.0) * half_even(c("numCorrect") / c("numDigits"), 2)
    cols = agg.columns
    pos = cols.index("numCorrect") + 1
    ordered = cols[:pos] + ["percentCorrect"] + cols[pos:]
    return agg.withColumn("percentCorrect", pct).select(*ordered)


def trial_summary(
    trials: DataFrame,
    crosswalk: DataFrame | None,
    excluded: DataFrame,
    withdrew: DataFrame,
    cohort: DataFrame,
    start: str = START_DATE,
    participant: str = "healthCode",
    na_strict: bool = True,
    **cols,
) -> DataFrame:
    """The whole P16 job."""
    if crosswalk is not None:
        trials = attach_participant(trials, crosswalk, participant=participant)
    summary = block_summary(trials, participant=participant, na_strict=na_strict, **cols)
    summary = since(summary, "activityStartTime_GMT", start)
    summary = exclude(summary, excluded, participant, "healthCode")
    summary = exclude(summary, withdrew, participant, "healthCode")
    return retain(summary, cohort, participant, "healthCode")
