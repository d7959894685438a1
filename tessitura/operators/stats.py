"""Exact order statistics and pitch summaries that never hold a group in one buffer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import octave_distance
from .scans import HotKeys, Scan, following, refine, row_number, running_sum, scan


def percentiles(rows: DataFrame, keys: Sequence[str], value: Column, wanted: dict[str, tuple[str, float]], hot: HotKeys | None = None) -> DataFrame:
    """Exact percentiles per key by counting, not by buffering.

    ``wanted`` maps a column name to (kind, p): ``linear`` interpolates between ranks,
    ``nearest`` takes rank ceil(p * n), ``upper`` takes the upper middle for p = 0.5.
    Equal values are counted before the shuffle; ranks come from an ordered scan over the
    distinct values, which is chunked for hot keys.
    """
    keys = list(keys)
    counts = rows.select(*keys, value.alias("__v")).where("__v is not null").groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__c"))
    # The count of a key is what lies up to a value plus what lies after it: no second pass.
    steps = [running_sum("__upto", F.col("__c")), Scan("__after", "sum", F.col("__c"), reverse=True)]
    both = scan(counts, keys, ["__v"], steps, refine(hot, counts, keys))
    both = both.withColumn("n", F.col("__upto") + F.coalesce("__after", F.lit(0)))

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((rank > F.col("__upto") - F.col("__c")) & (rank <= F.col("__upto")), F.col("__v")))

    aggs = [F.max("n").alias("n")]
    for name, (kind, p) in wanted.items():
        if kind == "linear":
            spot = (F.col("n") - 1) * F.lit(p)
            aggs += [at_rank(F.floor(spot) + 1).alias(f"__lo_{name}"), at_rank(F.ceil(spot) + 1).alias(f"__hi_{name}")]
        elif kind == "nearest":
            aggs.append(at_rank(F.least(F.ceil(F.col("n") * F.lit(p)), F.col("n"))).alias(name))
        else:
            aggs.append(at_rank(F.floor(F.col("n") * F.lit(p)) + 1).alias(name))
    out = both.groupBy(*keys).agg(*aggs)
    for name, (kind, p) in wanted.items():
        if kind == "linear":
            spot = (F.col("n") - 1) * F.lit(p)
            lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
            out = out.withColumn(name, lo + (hi - lo) * (spot - F.floor(spot)))
    return out.select(*keys, "n", *wanted)


def robust_normalize(rows: DataFrame, keys: Sequence[str], columns: dict[str, str], hot: HotKeys | None = None) -> DataFrame:
    """Clip (x - p10) / (p90 - p10) to 0..1 per key; null values and a flat range give 0.5.

    ``columns`` maps each value column to the name of its normalised column. The borders
    of all columns of a key come from one pass over the columns as rows.
    """
    keys = list(keys)
    long = rows.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("__col"), F.col(c).cast("double").alias("__x")) for c in columns
    ])).alias("__e")).select(*keys, "__e.*")
    borders = percentiles(
        long, [*keys, "__col"], F.col("__x"), {"__low": ("linear", 0.1), "__high": ("linear", 0.9)}, refine(hot, long, [*keys, "__col"])
    )
    pick = lambda c, side: F.max(F.when(F.col("__col") == c, F.col(side))).alias(f"{side}_{c}")
    wide = borders.groupBy(*keys).agg(*[pick(c, side) for c in columns for side in ("__low", "__high")])
    out = rows.join(wide, keys, "left")
    for c, name in columns.items():
        low, width = F.col(f"__low_{c}"), F.col(f"__high_{c}") - F.col(f"__low_{c}")
        scaled = F.least(F.greatest((F.col(c) - low) / F.nullif(width, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
        out = out.withColumn(name, F.when(F.col(c).isNull() | (width < 1e-8), 0.5).otherwise(F.coalesce(scaled, F.lit(0.5))))
    return out.drop(*[f"{side}_{c}" for c in columns for side in ("__low", "__high")])


def run_lengths(rows: DataFrame, keys: Sequence[str], order: Sequence[str], flag: Column, hot: HotKeys | None = None) -> DataFrame:
    """Per key: rows, true rows, longest run of true rows, longest run of false rows between true rows."""
    keys = list(keys)
    marked = rows.select(*keys, *order, F.coalesce(flag, F.lit(False)).alias("__f"))
    placed = scan(
        marked, keys, order,
        [row_number("__pos"), running_sum("__run", F.when(F.col("__f"), 0).otherwise(1))],
        hot,
    )
    # Inside a run the false count is constant, so runs are groups and pre-aggregate.
    per_run = placed.groupBy(*keys, "__run").agg(
        F.count_if("__f").alias("n"), F.count(F.lit(1)).alias("all"), F.min(F.when(F.col("__f"), F.col("__pos"))).alias("first"),
        F.max(F.when(F.col("__f"), F.col("__pos"))).alias("last"),
    )
    runs = per_run.where("n > 0")
    gaps = scan(runs, keys, ["__run"], [following("__next", F.col("first"))], refine(hot, runs, keys))
    holes = gaps.groupBy(*keys).agg(
        F.max("n").alias("longest_run"), F.coalesce(F.max(F.col("__next") - F.col("last") - 1), F.lit(0)).cast("bigint").alias("max_hole"), F.sum("n").alias("true_rows")
    )
    size = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return size.join(holes, keys, "left").fillna(0, ["longest_run", "max_hole", "true_rows"])


def pitch_mode(rows: DataFrame, keys: Sequence[str], position: Sequence[str], midi: Column) -> DataFrame:
    """Most frequent rounded semitone (first seen on ties), its share, the span and the count."""
    v = rows.select(*keys, F.struct(*position).alias("at"), midi.alias("m")).where("m is not null")
    tone = v.groupBy(*keys, F.rint("m").cast("bigint").alias("tone")).agg(
        F.count(F.lit(1)).alias("c"), F.min("at").alias("at"), F.min("m").alias("lo"), F.max("m").alias("hi")
    )
    out = tone.groupBy(*keys).agg(
        F.min(F.struct((-F.col("c")).alias("minus"), "at", "tone")).alias("b"), F.sum("c").alias("f0_valid_count"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
    )
    return out.select(
        *keys, F.col("b.tone").alias("f0_mode_midi"), F.round(-F.col("b.minus") / F.col("f0_valid_count"), 6).alias("f0_mode_ratio"),
        F.round(F.col("hi") - F.col("lo"), 6).alias("f0_span_semitone"), "f0_valid_count",
    )


def pitch_delta_summary(rows: DataFrame, keys: Sequence[str], delta: Column, hot: HotKeys | None = None) -> DataFrame:
    """Difference of two pitch backends per key with the raw and the octave-aware gate."""
    keys = list(keys)
    good = rows.select(*keys, delta.alias("raw")).where(F.col("raw").isNotNull() & ~F.isnan("raw"))
    good = good.withColumn("adj", octave_distance(F.col("raw")))
    octave = (F.col("raw") - F.col("adj") >= 6.0) & (F.col("adj") <= 1.0)
    counts = good.groupBy(*keys).agg(
        F.max("raw").alias("max_delta"), F.count_if(octave).alias("octave_frames"),
        F.count_if((F.col("raw") > 1.0) & ~octave).alias("over_1"), F.count_if((F.col("raw") > 2.0) & ~octave).alias("over_2"),
    )
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("__k"), F.col(k).alias("__x")) for k in ("raw", "adj")]))
    long = good.select(*keys, kinds.alias("e")).select(*keys, "e.*")
    both = percentiles(long, [*keys, "__k"], F.col("__x"), {"mid": ("upper", 0.5), "p95": ("nearest", 0.95)}, refine(hot, long, [*keys, "__k"]))
    pick = lambda k, c, name: F.max(F.when(F.col("__k") == k, F.col(c))).alias(name)
    ranks = both.groupBy(*keys).agg(
        F.max("n").alias("n"), pick("raw", "mid", "median_delta"), pick("raw", "p95", "p95_delta"), pick("adj", "mid", "adjusted_median"), pick("adj", "p95", "adjusted_p95")
    )
    out = counts.join(ranks, keys)
    n = F.col("n")
    raw_ok = (F.col("median_delta") <= 0.5) & (F.col("p95_delta") <= 1.0)
    robust = (F.col("median_delta") <= 0.5) & (F.col("adjusted_median") <= 0.5) & (F.col("octave_frames") / n <= 0.10)
    robust = robust & (F.col("over_1") / n <= 0.10) & (F.col("over_2") / n <= 0.05)
    return out.withColumn("pitch_gate", F.when(raw_ok, "raw").when(robust, "robust_crosscheck").otherwise("blocked"))
