"""Counts, rates, ratios and percentiles.

Everything here aggregates before the shuffle, so a hot level, status, source or time
bucket costs one row per task and not one task for all its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.time import Moment, before, bucket, from_epoch_seconds, moment
from .filters import select_events

# The four counted levels and the default look-back of the statistics.
LEVELS = ["ERROR", "WARN", "INFO", "DEBUG"]
STATS_HOURS = 24


def count_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def organization_level_counts(df: DataFrame) -> DataFrame:
    return count_by(df, "organization_id", "level")


def level_counts_after(df: DataFrame, after: Moment) -> DataFrame:
    return count_by(select_events(df, after=after), "level")


def level_stats(df: DataFrame, as_of: Moment, since: Moment | None = None) -> DataFrame:
    """Counts of the four levels in one pass. ``total_logs`` adds those four; ``all_levels`` counts every row."""
    start = since if since is not None else before(as_of, hours=STATS_HOURS)
    counted = select_events(df, after=start).agg(
        *[F.count_if(F.col("level") == level).alias(f"{level.lower()}_count") for level in LEVELS],
        F.count(F.lit(1)).alias("all_levels"),
    )
    total = sum((F.col(f"{level.lower()}_count") for level in LEVELS[1:]), F.col(f"{LEVELS[0].lower()}_count"))
    return counted.withColumns({
        "total_logs": total, "since": moment(start), "generated_at": moment(as_of)})


def status_counts(df: DataFrame) -> DataFrame:
    """Requests per status code; rows without status form a group of their own."""
    return count_by(df, "status_code")


def hourly_counts(df: DataFrame, as_of: Moment, by_date: bool = False) -> DataFrame:
    """Requests of the last 24 hours per hour of day, or per calendar hour with ``by_date``.

    Per hour of day the partial first and last hour fall into one group.
    """
    recent = select_events(df, start=before(as_of, hours=24))
    hour = F.date_trunc("hour", "timestamp").cast("timestamp_ntz") if by_date else F.hour("timestamp")
    return recent.groupBy(hour.alias("hour")).agg(F.count(F.lit(1)).alias("count")).orderBy("hour")


def format_counts(df: DataFrame, as_of: Moment | None = None) -> DataFrame:
    """Lines per recognized format, optionally of the last 24 hours only."""
    if as_of is not None:
        df = select_events(df, start=before(as_of, hours=24))
    return count_by(df, "log_format")


def parse_success_rate(parsed: DataFrame, width_seconds: int = 300, ts: str = "timestamp") -> DataFrame:
    """Good and failed lines per time window, and the good share in percent."""
    good = F.col("log_format") != "failed"
    counted = parsed.groupBy(bucket(F.col(ts), width_seconds).alias("_b")).agg(
        F.count_if(good).alias("parsed"), F.count_if(~good).alias("failed"))
    return counted.select(
        from_epoch_seconds(F.col("_b") * width_seconds).alias("window_start"), "parsed", "failed",
        (F.lit(100.0) * F.col("parsed") / F.nullif(F.col("parsed") + F.col("failed"), F.lit(0)))
        .alias("success_percent"),
    )


def outcome_counts(df: DataFrame, outcomes: dict[str, Column], weight: str | None = None) -> DataFrame:
    """Named counters in one pass: rows that meet each condition, or the sum of ``weight`` over them."""
    if weight is None:
        counters = [F.count_if(condition).alias(name) for name, condition in outcomes.items()]
    else:
        counters = [
            F.coalesce(F.sum(F.when(condition, F.col(weight))), F.lit(0)).cast("bigint").alias(name)
            for name, condition in outcomes.items()
        ]
    return df.agg(*counters)


def parse_pipeline_stats(parsed: DataFrame) -> DataFrame:
    """Lines received, processed and sent to the dead-letter table."""
    failed = F.col("log_format") == "failed"
    return outcome_counts(parsed, {"received": F.lit(True), "processed": ~failed, "sent_to_dlq": failed})


def event_rate(df: DataFrame, width_seconds: int = 300, ts: str = "timestamp") -> DataFrame:
    """Events per second in back-to-back windows."""
    counted = df.filter(F.col(ts).isNotNull()).groupBy(bucket(F.col(ts), width_seconds).alias("_b")).agg(
        F.count(F.lit(1)).alias("events"))
    return counted.select(
        from_epoch_seconds(F.col("_b") * width_seconds).alias("window_start"), "events",
        (F.col("events") / F.lit(float(width_seconds))).alias("per_second"))


def sliding_event_rate(df: DataFrame, width_seconds: int = 300, slide_seconds: int = 60,
                       ts: str = "timestamp") -> DataFrame:
    """Events per second in overlapping windows.

    Rows are first counted per slide; only those counts are copied into the windows
    they belong to, instead of every row.
    """
    if width_seconds % slide_seconds:
        raise ValueError("the window must be a whole number of slides")
    copies = width_seconds // slide_seconds
    per_slide = df.filter(F.col(ts).isNotNull()).groupBy(bucket(F.col(ts), slide_seconds).alias("_s")).agg(
        F.count(F.lit(1)).alias("_n"))
    windows = per_slide.select(
        F.explode(F.sequence(F.col("_s") - (copies - 1), F.col("_s"))).alias("_w"), "_n")
    counted = windows.groupBy("_w").agg(F.sum("_n").alias("events"))
    return counted.select(
        from_epoch_seconds(F.col("_w") * slide_seconds).alias("window_start"), "events",
        (F.col("events") / F.lit(float(width_seconds))).alias("per_second"))


def duration_stats(df: DataFrame, duration: str, keys: list[str] | None = None,
                   scale: int = 6) -> DataFrame:
    """Count, sum, max and mean of a duration. The sum is exact, whatever the order of partial sums."""
    exact = F.col(duration).cast(f"decimal(24,{scale})")
    grouped = df.groupBy(*(keys or [])).agg(
        F.count(duration).alias("calls"),
        F.sum(exact).cast("double").alias("total_time"),
        F.max(duration).alias("max_time"),
    )
    return grouped.withColumn("mean_time", F.col("total_time") / F.nullif(F.col("calls"), F.lit(0)))


def latency_percentiles(df: DataFrame, duration: str = "response_time", width_seconds: int = 300,
                        percents: tuple[float, ...] = (0.5, 0.95), ts: str = "timestamp") -> DataFrame:
    """Exact percentiles per window.

    Equal durations are counted first, so what reaches the percentile is one row per
    distinct duration of a window: for millisecond durations at most the slowest call
    in milliseconds. For durations of unlimited resolution use the approximate form.
    """
    measured = df.filter(F.col(duration).isNotNull())
    distinct = measured.groupBy(bucket(F.col(ts), width_seconds).alias("_b"), F.col(duration).alias("_d")).agg(
        F.count(F.lit(1)).alias("_n"))
    per_window = distinct.groupBy("_b").agg(
        F.sum("_n").alias("calls"),
        F.percentile("_d", [float(p) for p in percents], F.col("_n")).alias("_p"))
    return per_window.select(
        from_epoch_seconds(F.col("_b") * width_seconds).alias("window_start"), "calls",
        *[F.col("_p")[i].alias(f"p{p * 100:g}".replace(".", "_")) for i, p in enumerate(percents)])


def latency_percentiles_approx(df: DataFrame, duration: str = "response_time", width_seconds: int = 300,
                               percents: tuple[float, ...] = (0.5, 0.95), ts: str = "timestamp",
                               accuracy: int = 10000) -> DataFrame:
    """Percentiles per window from mergeable sketches of fixed size."""
    measured = df.filter(F.col(duration).isNotNull())
    per_window = measured.groupBy(bucket(F.col(ts), width_seconds).alias("_b")).agg(
        F.count(F.lit(1)).alias("calls"),
        F.percentile_approx(duration, [float(p) for p in percents], accuracy).alias("_p"))
    return per_window.select(
        from_epoch_seconds(F.col("_b") * width_seconds).alias("window_start"), "calls",
        *[F.col("_p")[i].alias(f"p{p * 100:g}".replace(".", "_")) for i, p in enumerate(percents)])


def histogram_quantiles(df: DataFrame, bounds: list[float], quantiles: tuple[float, ...] = (0.5, 0.95),
                        duration: str = "response_time", width_seconds: int = 300,
                        ts: str = "timestamp") -> DataFrame:
    """Quantiles per window as a dashboard gets them: from bucket counts, linear inside a bucket.

    ``bounds`` are ascending upper bounds, the last bucket is open and answers with the
    highest bound. One pass, a fixed number of counters per window.
    """
    measured = df.filter(F.col(duration).isNotNull())
    upper = [float(b) for b in bounds]
    counted = measured.groupBy(bucket(F.col(ts), width_seconds).alias("_b")).agg(
        F.count(F.lit(1)).alias("calls"),
        *[F.count_if(F.col(duration) <= b).alias(f"_le{i}") for i, b in enumerate(upper)])

    def quantile(q: float) -> Column:
        rank = F.lit(q) * F.col("calls")
        answer = F.lit(upper[-1])
        for i in reversed(range(len(upper))):
            low, below = (upper[i - 1], F.col(f"_le{i - 1}")) if i else (0.0, F.lit(0))
            inside = F.lit(low) + F.lit(upper[i] - low) * (rank - below) / F.nullif(
                F.col(f"_le{i}") - below, F.lit(0))
            answer = F.when(F.col(f"_le{i}") >= rank, F.coalesce(inside, F.lit(upper[i]))).otherwise(answer)
        return answer

    return counted.select(
        from_epoch_seconds(F.col("_b") * width_seconds).alias("window_start"), "calls",
        *[quantile(q).alias(f"p{q * 100:g}".replace(".", "_")) for q in quantiles])


def cumulative(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """Running total of a pre-aggregated series (one row per key and time step)."""
    running = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return df.withColumn(out, F.sum(value).over(running))
