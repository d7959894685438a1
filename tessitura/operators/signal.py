"""Frame features and sample-level joins.

Sums over a frame run in the JVM; only the autocorrelation pitch needs NumPy, and gets
its frames in Arrow batches.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import db_gain, dbfs


def as_double(samples: Column) -> Column:
    return F.transform(samples, lambda v: v.cast("double"))


def frame_rms(samples: Column) -> Column:
    """Root mean square of a frame; an empty frame gives 0."""
    power = F.aggregate(as_double(samples), F.lit(0.0), lambda a, v: a + v * v)
    return F.when(F.size(samples) > 0, F.sqrt(power / F.size(samples))).otherwise(0.0)


def frame_features(frames: DataFrame, samples: str = "samples", full_scale: float = 1.0) -> DataFrame:
    """RMS, level, peak and clipping flag per frame."""
    peak = F.coalesce(F.array_max(F.transform(as_double(F.col(samples)), lambda v: F.abs(v))), F.lit(0.0))
    rows = frames.withColumn("rms", frame_rms(F.col(samples)))
    return rows.withColumns({"db": dbfs(F.col("rms"), 1e-7), "peak": peak, "clipped": peak >= full_scale}).drop(samples)


def clip_level(frames: DataFrame, keys, samples: str = "samples") -> DataFrame:
    """Peak and RMS level per clip from per-frame sums of squares."""
    power = F.aggregate(as_double(F.col(samples)), F.lit(0.0), lambda a, v: a + v * v)
    peak = F.array_max(F.transform(as_double(F.col(samples)), lambda v: F.abs(v)))
    sums = frames.select(*keys, power.alias("p"), F.size(samples).alias("n"), peak.alias("peak"))
    out = sums.groupBy(*keys).agg(F.sum("p").alias("p"), F.sum("n").alias("n"), F.max("peak").alias("peak"))
    return out.select(
        *keys, F.round(dbfs(F.col("peak"), 1e-12), 4).alias("peak_dbfs"), F.round(dbfs(F.sqrt(F.col("p") / F.col("n")), 1e-12), 4).alias("rms_dbfs")
    )


def strongest_channel(channels: DataFrame, keys, samples: str = "samples") -> DataFrame:
    """Channel with the greatest energy, the lowest number on ties; channels are never mixed."""
    power = channels.select(*keys, "channel", F.aggregate(as_double(F.col(samples)), F.lit(0.0), lambda a, v: a + v * v).alias("p"))
    sums = power.groupBy(*keys, "channel").agg(F.sum("p").alias("p"))
    return sums.groupBy(*keys).agg(F.max_by("channel", F.struct("p", -F.col("channel"))).alias("channel"))


def autocorrelation_pitch(rate: int, low: float = 65.0, high: float = 1100.0, strength: float = 0.3, min_energy: float = 1e7):
    """Pandas UDF: pitch of a frame in Hz, null without a clear period.

    A frame is centred, gated by energy, and its period is the lag with the strongest
    autocorrelation between the two pitch limits.
    """
    first, last = max(1, int(rate / high)), int(rate / low)

    @F.pandas_udf("double")
    def pitch(frames: pd.Series) -> pd.Series:
        out = np.full(len(frames), np.nan)
        for i, frame in enumerate(frames):
            x = np.asarray(frame, dtype=np.float32)
            if x.size == 0:
                continue
            x = x - x.mean()
            if float(x @ x) < min_energy:
                continue
            size = 1 << (2 * x.size - 1).bit_length()
            spectrum = np.fft.rfft(x, size)
            corr = np.fft.irfft(np.abs(spectrum) ** 2, size)[: min(last, x.size - 1) + 1]
            if corr.size <= first:
                continue
            lag = first + int(np.argmax(corr[first:]))
            if corr[lag] >= strength * max(corr[0], 1.0):
                out[i] = rate / lag
        return pd.Series(out).where(~np.isnan(out), None)

    return pitch


# -- chunks and boundaries ----------------------------------------------------------


def chunk_plan(regions: DataFrame, keys, total: str, core: int, context: int, tail_pad: int) -> DataFrame:
    """Cores of fixed size that cover ``[0, total)`` with context on both sides."""
    start = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(total) - 1, F.lit(core).cast("bigint"))).alias("core_start")
    rows = regions.where(F.col(total) > 0).select(*keys, F.col(total).alias("__total"), start)
    end = F.least(F.col("core_start") + core, F.col("__total"))
    return rows.select(
        *keys,
        (F.expr(f"core_start div {core}") + 1).alias("chunk_id"), "core_start", end.alias("core_end"),
        F.greatest(F.col("core_start") - context, F.lit(0)).alias("segment_start"),
        F.least(end + context, F.col("__total")).alias("segment_end"),
        F.when(end == F.col("__total"), F.lit(max(context, tail_pad))).otherwise(F.lit(0)).cast("bigint").alias("right_padding"),
    )


def boundary_chunks(boundaries: DataFrame, chunks: DataFrame) -> DataFrame:
    """Last chunk that ends, and last chunk that starts, exactly at each boundary frame."""
    ends = chunks.groupBy(F.col("region").alias("left"), F.col("core_end").alias("frame")).agg(F.max("chunk_id").alias("left_chunk"))
    starts = chunks.groupBy(F.col("region").alias("right"), F.col("core_start").alias("frame")).agg(F.max("chunk_id").alias("right_chunk"))
    return boundaries.join(ends, ["left", "frame"], "left").join(starts, ["right", "frame"], "left")


def boundary_jumps(boundaries: DataFrame, samples: DataFrame, keys, boundary: str, index: str, value: str) -> DataFrame:
    """Add ``jump``: distance of the two samples that meet at each boundary, 0 at or beyond the ends.

    Only the two samples of each boundary are looked up, by equality.
    """
    keys = list(keys)
    spots = boundaries.select(*keys, boundary).distinct()
    sides = spots.select(*keys, boundary, F.explode(F.array(F.col(boundary) - 1, F.col(boundary))).alias(index))
    met = sides.join(samples.select(*keys, index, value), [*keys, index])
    # Both sides are needed: at an end one of them is missing.
    sized = met.groupBy(*keys, boundary).agg((F.max(value) - F.min(value)).alias("__jump"), F.count(value).alias("__sides"))
    jump = F.when(F.col("__sides") == 2, F.col("__jump")).otherwise(F.lit(0.0))
    return boundaries.join(sized, [*keys, boundary], "left").select(*boundaries.columns, jump.alias("jump"))


def crossfade(left: DataFrame, right: DataFrame, keys, index: str, value: str, length: int) -> DataFrame:
    """Linear fade from ``left`` to ``right`` over an overlap of ``length`` aligned samples."""
    r = right.select(*keys, index, F.col(value).alias("__r"))
    weight = F.col(index) / F.lit(max(length - 1, 1))
    return left.join(r, [*keys, index]).select(*keys, index, (F.col(value) * (1.0 - weight) + F.col("__r") * weight).alias("mixed"))


def peak_limited_mix(a: DataFrame, b: DataFrame, keys, index, value: str, boost_db: float, ceiling: float = 0.98) -> DataFrame:
    """Sum of two aligned series with ``a`` boosted, scaled down per key if the peak exceeds the ceiling."""
    other = b.select(*keys, *index, F.col(value).alias("__b"))
    both = a.join(other, [*keys, *index]).select(*keys, *index, (F.col("__b") + F.col(value) * db_gain(F.lit(boost_db))).alias("raw"))
    peak = both.groupBy(*keys).agg(F.max(F.abs("raw")).alias("peak"))
    gain = F.when(F.col("peak") > ceiling, F.lit(ceiling) / F.col("peak")).otherwise(1.0)
    return both.join(peak, list(keys)).select(*keys, *index, (F.col("raw") * gain).alias("mixed"))
