"""Engagement measures of one event and of a group of events."""

from pyspark.sql import Column, functions as F

# Weights of the composite score (fixed values).
EVENT_WEIGHT, USER_WEIGHT, COMPLETION_WEIGHT = 0.3, 0.4, 0.3


def engagement_seconds(duration_ms: Column) -> Column:
    return duration_ms / F.lit(1000.0)


def pct_hundredths(duration_ms: Column, length_seconds: Column) -> Column:
    """Share of the item consumed, as whole hundredths of a percent, halves rounded away from zero.

    Whole numbers all through, so ties round the same way on every machine and sums of the result
    do not depend on the order of the rows. Null where either side is missing or the length is not
    positive.
    """
    ms, length = duration_ms.cast("bigint"), length_seconds.cast("bigint")
    size = F.call_function("div", F.abs(ms) * 20 + length, length * 2)
    return F.when(length > 0, F.when(ms < 0, -size).otherwise(size))


def engagement_pct(duration_ms: Column, length_seconds: Column) -> Column:
    return pct_hundredths(duration_ms, length_seconds) / F.lit(100.0)


def completion_rate(plays: Column, finishes: Column) -> Column:
    """Finishes per play; 0.0 where nothing was played. More finishes than plays gives above 1."""
    return F.when(plays > 0, finishes / plays).otherwise(F.lit(0.0))


def engagement_score(events: Column, users: Column, completion: Column) -> Column:
    return (
        events * F.lit(EVENT_WEIGHT)
        + users * F.lit(USER_WEIGHT)
        + completion * F.lit(100) * F.lit(COMPLETION_WEIGHT)
    )
