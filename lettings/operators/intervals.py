"""Date-interval questions per key, answered from calendar profiles instead of row pairs.

Dates come from a calendar, so after grouping by (key, day) a key has at most as many rows as the
calendar has days, however many intervals it holds. All windows below run over such profiles. No
step compares intervals pairwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FOREVER = 2**30
"""Day number after any calendar date; the open end of the last gap."""


def conflict_counts(
    requests: DataFrame, booked: DataFrame, key: str, *, name: str = "conflicts"
) -> DataFrame:
    """Add to each request the number of booked intervals of its key that overlap it.

    Both frames have ``key, start_date, end_date`` with start <= end. Overlapping intervals are
    those that start by the request's end, less those that end before its start.
    """
    zero = F.lit(0).cast("long")
    one = F.lit(1).cast("long")

    def events(frame: DataFrame, day: str, opened: object, closed: object) -> DataFrame:
        return frame.select(
            key, F.col(day).alias("_day"), opened.alias("_opened"), closed.alias("_closed")
        )

    profile = (
        events(booked, "start_date", one, zero)
        .unionByName(events(booked, "end_date", zero, one))
        .unionByName(events(requests, "start_date", zero, zero))
        .unionByName(events(requests, "end_date", zero, zero))
        .groupBy(key, "_day")
        .agg(F.sum("_opened").alias("_opened"), F.sum("_closed").alias("_closed"))
    )
    by_day = Window.partitionBy(key).orderBy("_day")
    totals = profile.select(
        key,
        "_day",
        F.sum("_opened").over(by_day).alias("_started"),
        F.coalesce(
            F.sum("_closed").over(by_day.rowsBetween(Window.unboundedPreceding, -1)), zero
        ).alias("_ended"),
    )
    at_end = totals.select(key, F.col("_day").alias("end_date"), "_started")
    at_start = totals.select(key, F.col("_day").alias("start_date"), "_ended")
    return (
        requests.join(at_end, [key, "end_date"])
        .join(at_start, [key, "start_date"])
        .withColumn(name, F.col("_started") - F.col("_ended"))
        .drop("_started", "_ended")
        .select(*requests.columns, name)
    )


def granted_chain(frame: DataFrame, key: str, identifier: str) -> DataFrame:
    """Identifiers of the intervals that each key grants, served by start and then identifier.

    An interval is granted if it starts after the end of the last granted one. Of those that start
    on one day only the first can be, so a key has one row per start day at most before its chain
    is followed, and the list of a hot key is bounded by the calendar.
    """
    first = frame.groupBy(key, "start_date").agg(
        F.min_by("end_date", identifier).alias("end_date"), F.min(identifier).alias(identifier)
    )
    served = F.sort_array(F.collect_list(F.struct("start_date", "end_date", identifier)))
    chains = first.groupBy(key).agg(served.alias("_served"))
    kind = frame.schema[identifier].dataType.simpleString()
    granted = F.expr(
        f"""aggregate(_served, named_struct('e', cast(null as date), 'ids', cast(array() as array<{kind}>)),
          (a, x) -> if(a.e is null or x.start_date > a.e,
            named_struct('e', x.end_date, 'ids', concat(a.ids, array(x.{identifier}))), a), a -> a.ids)"""
    )
    return chains.select(F.explode(granted).alias(identifier))


def free_gaps(keys: DataFrame, booked: DataFrame, key: str) -> DataFrame:
    """Free periods of every key as day numbers ``gap_from..gap_to``, both inclusive."""
    starts = booked.groupBy(key, F.unix_date("start_date").alias("_start")).agg(
        F.max(F.unix_date("end_date")).alias("_end")
    )
    by_start = Window.partitionBy(key).orderBy("_start")
    reach = F.max("_end").over(by_start)
    following = F.coalesce(F.lead("_start").over(by_start), F.lit(FOREVER + 1))
    between = starts.select(
        key, (reach + 1).alias("gap_from"), (following - 1).alias("gap_to")
    ).filter("gap_from <= gap_to")
    ahead = starts.groupBy(key).agg((F.min("_start") - 1).alias("_before"))
    leading = keys.join(ahead, key, "left").select(
        key,
        F.lit(-FOREVER).alias("gap_from"),
        F.coalesce("_before", F.lit(FOREVER)).alias("gap_to"),
    )
    return leading.unionByName(between)


def first_fitting(
    requests: DataFrame,
    gaps: DataFrame,
    group: str,
    candidate: str,
    *,
    horizon: DataFrame | None = None,
) -> DataFrame:
    """For each distinct request (group, day_from, day_to): the smallest candidate of the group
    with a gap around it, as column ``candidate``; requests that fit nowhere are absent.

    A gap fits when it starts by ``day_from`` and ends no sooner than ``day_to``. Start days are
    stored in dyadic blocks: a gap is listed at most once per level, a request looks at the few blocks
    that tile the days up to its own start; their numbers are even, so gaps are listed in even ones.
    Inside a block the smallest candidate with a late enough end is a running minimum over end days, which
    the requests that look there read off in passing. Work is (gaps + requests) x log(days), and a
    block holds one gap per end day and one look per pair of days, so a group with most of the data is
    still many tasks bounded by the calendar.
    Gaps that end too early for any request, or hold fewer days than the shortest, are left out first.
    ``horizon`` may name a cheaper frame whose rows include the days of all requests.
    """
    wanted = requests.select(group, "day_from", "day_to").dropna().distinct()
    span = (
        (wanted if horizon is None else horizon)
        .agg(
            F.min("day_from").alias("low"),
            F.max("day_from").alias("high"),
            F.min(F.col("day_to") - F.col("day_from")).alias("shortest"),
        )
        .first()
    )
    # Three numbers, asked for once: as subqueries each use of them would run the frame again.
    low, high, shortest = (F.lit(span[name]).cast("int") for name in ("low", "high", "shortest"))
    reduced = (
        gaps.groupBy(group, "gap_from", "gap_to")
        .agg(F.min(candidate).alias("_candidate"))
        .withColumns({"_low": low, "_high": high, "_shortest": shortest})
        .filter("gap_from <= _high and gap_to - greatest(gap_from, _low) >= _shortest")
        .withColumn("_slot", F.expr("greatest(gap_from, _low) - _low"))
        .withColumn("_levels", F.expr("length(bin(_high - _low + 1))"))
    )
    stored = (
        reduced.withColumn("_level", F.explode(F.expr("sequence(0, _levels - 1)")))
        .withColumn("_block", F.expr("shiftright(_slot, _level)"))
        .filter("_block % 2 = 0")
        .groupBy(group, "_level", "_block", F.col("gap_to").alias("day_to"))
        .agg(F.min("_candidate").alias("_candidate"))
    )
    looked_up = (
        wanted.withColumn("_prefix", F.col("day_from") - low + 1)
        .withColumn("_level", F.explode(F.expr("sequence(0, length(bin(_prefix)) - 1)")))
        .filter("shiftright(_prefix, _level) % 2 = 1")
        .withColumn("_block", F.expr("shiftright(_prefix, _level) - 1"))
        .select(group, "day_from", "day_to", "_level", "_block")
    )
    later = Window.partitionBy(group, "_level", "_block").orderBy(F.desc("day_to"))
    return (
        stored.unionByName(looked_up, allowMissingColumns=True)
        .withColumn(candidate, F.min("_candidate").over(later))
        .filter(F.col("day_from").isNotNull() & F.col(candidate).isNotNull())
        .groupBy(group, "day_from", "day_to")
        .agg(F.min(candidate).alias(candidate))
    )
