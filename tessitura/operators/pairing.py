"""Event streams to notes: tempo in force, on/off pairing, unmatched events, polyphony."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scans import HotKeys, Scan, last_seen, previous, refine, running_sum, scan


def tempo_clock(events: DataFrame, keys, at: str, order, tempo: str, default: int, hot: HotKeys | None = None) -> DataFrame:
    """Tempo before each event and the clock: the sum of step length times tempo in force.

    ``tempo`` is null on events that are not tempo changes. A change applies after its
    own instant. Steps count from the first event of the key.
    """
    in_force = F.coalesce("__seen", F.lit(default).cast("bigint"))
    step = F.coalesce(F.col(at) - F.col("__before"), F.lit(0).cast("bigint"))
    rows = scan(
        events,
        keys,
        order,
        [last_seen("__seen", F.col(tempo), inclusive=False), previous("__before", F.col(at))],
        hot,
        [running_sum("clock", step * in_force)],
    )
    return rows.withColumn("tempo_before", in_force).drop("__seen", "__before")


def pair_events(events: DataFrame, track: str, pitch: str, at: str, event: str, hot: HotKeys | None = None):
    """First-in first-out pairing of on and off events per (track, pitch).

    An off without a sounding on is dropped and reported. The number of sounding notes
    is a walk that cannot fall below zero, so an off is unmatched exactly when the plain
    running balance reaches a new minimum below zero; the r-th on then belongs to the
    r-th matched off. Offs of one instant come before ons.

    Returns ``(notes, unmatched_offs, unreleased_ons, polyphonic_ons)``.
    """
    key = [track, pitch]
    rank = F.when(F.col("kind") == "off", 0).otherwise(1)
    step = F.when(F.col("kind") == "on", 1).otherwise(-1)
    rows = events.withColumn("__rank", rank).withColumn("__step", step)
    order = [at, "__rank", event]
    by_pitch = refine(hot, events, key)
    lost = (F.col("kind") == "off") & (F.col("__level") < F.least(F.lit(0), F.col("__low")))
    ranked = scan(
        rows,
        key,
        order,
        [running_sum("__level", F.col("__step"))],
        by_pitch,
        [Scan("__low", "min", F.col("__level"))],
        [
            running_sum("on_rank", F.when(F.col("kind") == "on", 1).otherwise(0)),
            running_sum("off_rank", F.when((F.col("kind") == "off") & ~lost, 1).otherwise(0)),
        ],
    ).withColumn("lost", lost)
    ons = ranked.where("kind = 'on'").select(*key, F.col(at).alias("on_at"), F.col(event).alias("on_event"), F.col("on_rank").alias("pair"))
    offs = ranked.where("kind = 'off' and not lost").select(*key, F.col(at).alias("off_at"), F.col(event).alias("off_event"), F.col("off_rank").alias("pair"))
    paired = ons.join(offs, [*key, "pair"], "left")
    notes = paired.where("off_at is not null")
    unreleased = paired.where("off_at is null").select(*key, "on_at", "on_event")
    unmatched = ranked.where("lost").select(*key, F.col(at).alias("off_at"), F.col(event).alias("off_event"))
    live = ranked.withColumn("__live", F.when(F.col("lost"), 0).otherwise(F.col("__step")))
    sounding = scan(live, [track], order, [running_sum("sounding_before", F.col("__live"), inclusive=False)], hot)
    poly = sounding.where("kind = 'on' and sounding_before > 0").select(
        *key, F.col(at).alias("on_at"), F.col(event).alias("on_event"), "sounding_before"
    )
    return notes, unmatched, unreleased, poly
