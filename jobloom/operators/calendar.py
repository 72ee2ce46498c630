"""Collection slots on the local clock, as columns of a UTC timestamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions import policy as P


def local(ts: Column) -> Column:
    """Local wall-clock time (timestamp_ntz) of a UTC wall-clock timestamp_ntz."""
    return F.convert_timezone(F.lit("UTC"), F.lit(P.ZONE), ts)


def due_slot(ts: Column, lag_minutes: int = 0) -> Column:
    """The latest slot that began at least ``lag_minutes`` ago today; null before the first.

    The lag applies to the slot that is due: while it is fresh the result is null, not the slot before.
    """
    stamp = local(ts)
    minute = F.hour(stamp) * 60 + F.minute(stamp)
    out = F.lit(None).cast("int")
    for h in P.COLLECT_HOURS:
        out = F.when(minute >= h * 60, F.lit(h)).otherwise(out)
    return F.when(minute >= out * 60 + lag_minutes, out)


def next_slot(ts: Column) -> Column:
    """Local time of the next slot, strictly later."""
    stamp = local(ts)
    day = F.date_trunc("DAY", stamp).cast("timestamp_ntz")
    at = [day + F.make_dt_interval(F.lit(d), F.lit(h)) for d in (0, 1) for h in P.COLLECT_HOURS]
    return F.array_min(F.filter(F.array(*at), lambda x: x > stamp))


def next_check_text(ts: Column) -> Column:
    nxt, days = next_slot(ts), F.date_diff(next_slot(ts).cast("date"), local(ts).cast("date"))
    clock = F.date_format(nxt, "HH:mm")
    return F.concat(F.lit("⏭ "), F.when(days == 0, clock).when(days == 1, F.concat(F.lit("завтра "), clock)).otherwise(F.concat(F.date_format(nxt, "yyyy-MM-dd "), clock)))


def overdue_slots(clock: DataFrame, ts: str, done: DataFrame, late_minutes: int | None = None) -> DataFrame:
    """Slots of each clock row that have begun, plus the lag, and are not in ``done(day, slot)``.

    The slots are an array of two, exploded, so the theta condition is a filter and the rest an anti join on
    (day, slot). With ``late_minutes`` only slots that began so long ago, with their lag.
    """
    stamp = local(F.col(ts))
    minute = F.hour(stamp) * 60 + F.minute(stamp)
    df = clock.withColumns({"day": stamp.cast("date"), "_minute": minute, "slot": F.explode(F.array(*[F.lit(h) for h in P.COLLECT_HOURS]))})
    df = df.withColumn("lag_minutes", (F.col("_minute") - F.col("slot") * 60).cast("long")).where(F.col("lag_minutes") >= max(P.KICK_LAG_MINUTES, late_minutes or 0))
    return df.drop("_minute").join(done.select("day", "slot"), ["day", "slot"], "left_anti")
