"""Interval algebra on a keyed timeline: union, subtract, complement, overlap, as-of.

Times are BIGINT (sample indices or microseconds). ``eps`` is one sample for sample
timelines and 0 for exact ones: "within eps" means ``<= eps``, "beyond" means ``> eps``.
Nothing here compares all pairs of a key: unions and differences are ordered scans,
containment in disjoint intervals is an as-of lookup, and general overlap is an
equi-join on fixed time bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scans import HotKeys, following, last_seen, previous, running_max, running_sum, scan

START, END = "start_us", "end_us"


def adjacent_gaps(rows, keys, order, min_gap: int, index="note_index", start=START, end=END, carry=(), hot=None):
    """Pairs of neighbours whose distance is at least ``min_gap``; one row per boundary."""
    extra = [previous(f"left_{c}", F.col(c)) for c in carry]
    paired = scan(rows, keys, order, [previous("gap_start", F.col(end)), *extra], hot)
    return paired.where(F.col(start) - F.col("gap_start") >= min_gap).select(
        *keys,
        F.col(index).alias("boundary_index"),
        "gap_start",
        F.col(start).alias("gap_end"),
        (F.col(start) - F.col("gap_start")).alias("gap_len"),
        *[f"left_{c}" for c in carry],
        *[F.col(c).alias(f"right_{c}") for c in carry],
    )


def adjacent_overlaps(rows, keys, order, eps=0, index="note_index", start=START, end=END, hot=None):
    """Neighbours where the later one starts more than ``eps`` before the earlier one ends."""
    paired = scan(rows, keys, order, [previous("left_end", F.col(end))], hot)
    return paired.where(F.col(start) < F.col("left_end") - eps).select(
        *keys, F.col(index), (F.col("left_end") - F.col(start)).alias("overlap_len")
    )


def running_max_violations(rows, keys, order, eps=0, index="note_index", start=START, end=END, hot=None):
    """Rows that start more than ``eps`` before the latest end of any earlier row."""
    seen = scan(rows, keys, order, [running_max("max_end_before", F.col(end))], hot)
    return seen.where(F.col(start) < F.col("max_end_before") - eps).select(
        *keys, index, start, "max_end_before"
    )


def union(rows: DataFrame, keys: Sequence[str], eps=0, start=START, end=END, hot: HotKeys | None = None) -> DataFrame:
    """Merge intervals that touch or lie within ``eps``; empty and inverted ones are dropped."""
    valid = rows.where(F.col(end) > F.col(start)).select(*keys, start, end)
    fresh = F.when(F.col("__reach").isNull() | (F.col(start) > F.col("__reach") + eps), 1).otherwise(0)
    numbered = scan(
        valid, keys, [start, end], [running_max("__reach", F.col(end))], hot, [running_sum("__island", fresh)]
    )
    return numbered.groupBy(*keys, "__island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("__island")


def subtract(base, cuts, keys, eps=0, start=START, end=END, hot: HotKeys | None = None) -> DataFrame:
    """Union of ``base`` minus union of ``cuts``; pieces of at most ``eps`` are dropped.

    One sweep over interval edges replaces the nested loop. A cut that reaches into a
    base by at most ``eps`` leaves that edge where it was. On an exact timeline the sweep
    counts depths of the raw intervals, so one shuffle serves both sides and the merge.
    """
    if eps == 0:
        return union(_bare_segments(base, cuts, keys, start, end, hot), keys, 0, start, end, hot)
    whole = union(base, keys, eps, start, end, hot)
    holes = union(cuts, keys, eps, start, end, hot)
    pieces = subtract_disjoint(whole, holes, keys, eps, start, end, hot)
    return union(pieces, keys, eps, start, end, hot)


def _bare_segments(base, cuts, keys, start, end, hot) -> DataFrame:
    """Stretches between neighbouring edges that lie in some base and in no cut."""

    def edges(rows: DataFrame, kind: int) -> DataFrame:
        edge = F.array(F.struct(F.col(start).alias("at"), F.lit(1).alias("step")), F.struct(F.col(end).alias("at"), F.lit(-1).alias("step")))
        out = rows.where(F.col(end) > F.col(start)).select(*keys, F.explode(edge).alias("e"))
        return out.select(*keys, F.col("e.at").alias("at"), F.lit(kind).alias("kind"), F.col("e.step").alias("step"))

    depth = lambda kind: F.when(F.col("kind") == kind, F.col("step")).otherwise(0)
    steps = [running_sum("in_base", depth(0)), running_sum("in_cut", depth(1)), following("until", F.col("at"))]
    swept = scan(edges(base, 0).unionByName(edges(cuts, 1)), keys, ["at", "kind", "step"], steps, hot)
    bare = swept.where((F.col("in_base") > 0) & (F.col("in_cut") == 0) & (F.col("until") > F.col("at")))
    return bare.select(*keys, F.col("at").alias(start), F.col("until").alias(end))


def subtract_disjoint(whole, holes, keys, eps=0, start=START, end=END, hot=None, carry=()) -> DataFrame:
    """``subtract`` for inputs that are already disjoint; ``carry`` columns of the base ride along."""

    def edges(rows: DataFrame, is_base: bool) -> DataFrame:
        tag = F.struct(F.col(start).alias("from"), F.col(end).alias("to"), *carry)
        edge = F.array(
            F.struct(F.col(start).alias("at"), F.lit(1).alias("step")),
            F.struct(F.col(end).alias("at"), F.lit(-1).alias("step")),
        )
        kind = 0 if is_base else 1
        out = rows.select(*keys, (tag if is_base else F.lit(None)).alias("base"), F.explode(edge).alias("e"))
        return out.select(
            *keys,
            F.col("e.at").alias("at"),
            F.lit(kind).alias("kind"),
            F.col("e.step").alias("step"),
            (F.when(F.col("e.step") == 1, F.col("base")) if is_base else F.lit(None)).alias("base"),
        )

    base_edges = edges(whole, True)
    cut_edges = edges(holes, False).withColumn("base", F.lit(None).cast(base_edges.schema["base"].dataType))
    swept = scan(
        base_edges.unionByName(cut_edges),
        keys,
        ["at", "kind", "step"],
        [
            running_sum("in_base", F.when(F.col("kind") == 0, F.col("step")).otherwise(0)),
            running_sum("in_cut", F.when(F.col("kind") == 1, F.col("step")).otherwise(0)),
            following("until", F.col("at")),
            last_seen("of", F.col("base")),
        ],
        hot,
    )
    left = F.when(F.col("at") - F.col("of.from") <= eps, F.col("of.from")).otherwise(F.col("at"))
    right = F.when(F.col("of.to") - F.col("until") <= eps, F.col("of.to")).otherwise(F.col("until"))
    return (
        swept.where((F.col("in_base") > 0) & (F.col("in_cut") == 0) & (F.col("until") > F.col("at")))
        .select(*keys, left.alias(start), right.alias(end), *[F.col(f"of.{c}") for c in carry])
        .where(F.col(end) - F.col(start) > eps)
    )


def uncovered(covered, extents, keys, eps=0, start=START, end=END, hot=None) -> DataFrame:
    """Parts of ``[0, extent]`` that no interval covers, head and tail included."""
    whole = extents.select(*keys, F.lit(0).cast("bigint").alias(start), F.col("extent").alias(end))
    return subtract(whole, covered, keys, eps, start, end, hot)


def asof(probes: DataFrame, marks: DataFrame, keys, at: str, mark_at: str, value: Sequence[str],
         strictly_before=False, name="mark", hot=None, tie: Sequence[str] = ()) -> DataFrame:
    """Attach to each probe the latest mark at or before it (or strictly before it).

    Both sides become one ordered stream and the mark is carried forward, so a key
    with many marks and many probes never forms a product. Marks at one instant are
    ranked by ``tie``; the greatest wins.
    """
    packed = marks.select(
        *keys,
        F.col(mark_at).alias("__at"),
        F.lit(1 if strictly_before else 0).alias("__side"),
        F.struct(*[F.col(t) for t in tie], F.lit(0).alias("__0")).alias("__tie"),
        F.struct(*value).alias(name),
    )
    tie_type = packed.schema["__tie"].dataType
    rows = probes.select(
        *keys,
        F.col(at).alias("__at"),
        F.lit(0 if strictly_before else 1).alias("__side"),
        F.lit(None).cast(tie_type).alias("__tie"),
        F.struct(*probes.columns).alias("__probe"),
    )
    both = rows.unionByName(packed, allowMissingColumns=True)
    filled = scan(both, keys, ["__at", "__side", "__tie"], [last_seen("__mark", F.col(name))], hot)
    return filled.where(F.col("__probe").isNotNull()).select("__probe.*", F.col("__mark").alias(name))


def overlapping_any(rows, disjoint, keys, eps=0, start=START, end=END, hot=None) -> DataFrame:
    """Flag rows that overlap any of the disjoint intervals by more than ``eps``.

    The last interval that starts before the row ends also ends last, so it decides.
    """
    marks = disjoint.select(*keys, F.col(start).alias("w_start"), F.col(end).alias("w_end"))
    probes = rows.withColumn("__limit", F.col(end) - eps)
    found = asof(probes, marks, keys, "__limit", "w_start", ["w_start", "w_end"], strictly_before=True, hot=hot)
    hit = F.coalesce(F.col("mark.w_end") - F.col(start) > eps, F.lit(False))
    return found.select(*rows.columns, hit.alias("overlaps"))


def contained_any(rows, disjoint, keys, eps=0, start=START, end=END, hot=None) -> DataFrame:
    """Flag rows that lie wholly inside one of the disjoint intervals (within ``eps``)."""
    marks = disjoint.select(*keys, F.col(start).alias("w_start"), F.col(end).alias("w_end"))
    probes = rows.withColumn("__limit", F.col(start) + eps)
    found = asof(probes, marks, keys, "__limit", "w_start", ["w_start", "w_end"], hot=hot)
    inside = F.coalesce(F.col(end) <= F.col("mark.w_end") + eps, F.lit(False))
    return found.select(*rows.columns, inside.alias("contained"))


def binned(rows: DataFrame, width: int, start=START, end=END, name="__bin") -> DataFrame:
    """One copy of each interval per fixed time bin it touches."""
    first, final = F.floor(F.col(start) / width), F.floor((F.col(end)) / width)
    return rows.withColumn(name, F.explode(F.sequence(first, F.greatest(first, final))))


def overlap_join(left, right, keys, width: int, on: Column, left_span, right_span, how="inner") -> DataFrame:
    """Join intervals that share a key and overlap, on ``(key, time bin)``.

    Column names of the two sides must differ apart from ``keys``. A pair is kept only
    in the bin that holds the later of the two starts, so no pair appears twice. Bins
    spread one long timeline over many tasks; AQE splits a bin that is still too big.
    With ``how="left"`` a left row also appears, with nulls, once per bin without a
    match: aggregate by the left key (a count of a right column is then right as is).
    """
    (ls, le), (rs, re) = left_span, right_span
    a = binned(left, width, ls, le, "__bin")
    b = binned(right, width, rs, re, "__bin_r").withColumnsRenamed({k: f"__r_{k}" for k in keys})
    same = F.col("__bin") == F.col("__bin_r")
    for k in keys:
        same = same & (F.col(k) == F.col(f"__r_{k}"))
    owner = F.col("__bin") == F.floor(F.greatest(F.col(ls), F.col(rs)) / width)
    joined = a.join(b, same & owner & on, how)
    return joined.drop("__bin", "__bin_r", *[f"__r_{k}" for k in keys])
