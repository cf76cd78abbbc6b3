"""Windowed counts, rates, drift and held alerts on event time."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ticketloom.functions.statistics import safe_ratio, xlogx_ratio
from ticketloom.session import fresh_path

DELAY = "15 minutes"


def event_time(df: DataFrame, ts: str = "ts", delay: str = DELAY) -> DataFrame:
    """A zoned timestamp with a watermark; rows later than ``delay`` are dropped."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


#: A time after all event times. Its own windows never close, so they never come out.
END = "2200-01-01 00:00:00"


def end_rows(like: DataFrame, ts: str) -> DataFrame:
    """One row with the columns of ``like``: the end time, and nothing else."""
    fields = [
        F.lit(END).cast(f.dataType).alias(f.name) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name)
        for f in like.schema
    ]
    return like.sparkSession.range(1).select(*fields)


def end_marker(like: DataFrame, ts: str) -> DataFrame:
    """``end_rows`` as a stream, for a union with a source that ends.

    A watermark stands behind the latest row, so the last windows of a source that has
    ended would stay open for good. The marker moves it past all of them.
    """
    spark = like.sparkSession
    path = fresh_path(spark, "end")
    end_rows(like, ts).write.parquet(path)
    return spark.readStream.schema(like.schema).parquet(path)


def windowed_rate(stream: DataFrame, ts: str, flagged: Column, length: str, slide: str | None = None) -> DataFrame:
    """Total, flagged and rate per window, emitted once the watermark closes it.

    Sliding windows are two chained aggregations: rows are counted once per slide step,
    and only closed steps are spread over the windows they belong to.
    """
    counts = stream.groupBy(F.window(ts, slide or length).alias("window")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(flagged).alias("flagged")
    )
    if slide:
        steps = counts.select(F.window_time("window").alias("_at"), "total", "flagged")
        counts = steps.groupBy(F.window("_at", length, slide).alias("window")).agg(
            F.sum("total").alias("total"), F.sum("flagged").alias("flagged")
        )
    return counts.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "total",
        "flagged",
        safe_ratio(F.col("flagged"), F.col("total")).alias("rate"),
    )


def windowed_counts(stream: DataFrame, ts: str, label: str, length: str) -> DataFrame:
    counts = stream.groupBy(F.window(ts, length).alias("window"), F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "label", "n"
    )


def windowed_drift(stream: DataFrame, ts: str, label: str, reference: DataFrame, length: str) -> DataFrame:
    """(window_start, window_end, rows, distance): Jensen-Shannon distance (natural log) of each window from ``reference``.

    ``reference`` holds (label, share) and is joined as a table. Windows come out once
    closed: labels are counted per window first, and what the second aggregation holds
    of a window is a count for each of its labels. A label that the window lacks adds
    ln(2)/2 times its share; NULL is a label.
    """
    counts = stream.groupBy(F.window(ts, length).alias("window"), F.col(label).cast("string").alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )
    shares = reference.select(F.col("label").alias("_label"), F.col("share").alias("p"))
    known = counts.select(F.window_time("window").alias("_at"), "label", "n").join(
        shares, F.col("label").eqNullSafe(F.col("_label")), "left"
    )
    cell = F.struct("n", F.coalesce("p", F.lit(0.0)).alias("p"))
    closed = known.groupBy(F.window("_at", length).alias("window")).agg(
        F.sum("n").alias("rows"), F.array_sort(F.collect_list(cell)).alias("_cells")
    )

    def added(total: Column, c: Column) -> Column:
        q = c["n"] / F.col("rows")
        middle = (c["p"] + q) / 2
        met = (xlogx_ratio(c["p"], middle) + xlogx_ratio(q, middle)) / 2
        return total + met - c["p"] * F.lit(math.log(2) / 2)

    divergence = F.aggregate("_cells", F.lit(math.log(2) / 2), added)
    return closed.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "rows",
        F.sqrt(F.greatest(divergence, F.lit(0.0))).alias("distance"),
    )


_STATE = "since timestamp, last timestamp"
_OUT = "alert string, window_end timestamp, rate double, firing boolean"


def held_alert_stream(rates: DataFrame, limit: float, hold: str, step: str, resolve: bool = False) -> DataFrame:
    """Streaming form of ``operators.alerts.held_alerts`` over (alert, window_end, rate).

    One small state per alert: when the rate became high and when it was last seen.
    An alert gets one row per evaluation, so a group grows with time, not with traffic.

    With ``resolve``, ``window_end`` needs a watermark. Once that stands a step behind the
    last evaluation, an event-time timer ends the run and removes the state: an alert that
    was firing gets one more row, a step after its last one, without a rate and not firing.
    A row that comes later still begins a new run, as it does after a gap in the batch form.
    """
    hold_for, step_for = pd.Timedelta(hold), pd.Timedelta(step)
    zone = rates.sparkSession.conf.get("spark.sql.session.timeZone")  # of the times in the batches, which bear none

    def due(last: pd.Timestamp, state: GroupState) -> int:
        # a timer is set for a time after the watermark; one that is due already goes off at its next move
        at = pd.Timestamp(last + step_for).tz_localize(zone, ambiguous=False, nonexistent="shift_forward")
        return max(at.value // 1_000_000, state.getCurrentWatermarkMs()) + 1

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        since, last = state.get if state.exists else (None, None)
        if state.hasTimedOut:
            state.remove()
            if since is not None and last - since >= hold_for:
                yield pd.DataFrame({"alert": [key[0]], "window_end": [last + step_for], "rate": pd.Series([None], dtype="float64"), "firing": [False]})
            return
        rows = pd.concat(list(batches)).sort_values("window_end")
        firing = []
        for end, rate in zip(rows["window_end"], rows["rate"], strict=True):
            high = rate > limit
            if not high:
                since = None
            elif since is None or end - last > step_for:
                since = end
            firing.append(bool(high and end - since >= hold_for))
            last = end
        state.update((since, last))
        if resolve:
            state.setTimeoutTimestamp(due(last, state))
        yield pd.DataFrame({"alert": key[0], "window_end": rows["window_end"], "rate": rows["rate"], "firing": firing})

    return rates.groupBy("alert").applyInPandasWithState(
        advance, _OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout if resolve else GroupStateTimeout.NoTimeout
    )
