"""Captions to a parameter schedule: text scores, intensity, weighted means, modes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clip_round
from .stats import robust_normalize

# The score labels in tie order.
LABELS = ("joy", "sadness", "anticipation", "surprise", "anger", "fear", "disgust", "trust")
# Punctuation rules (name, pattern, score increments).
PUNCTUATION_HINTS = (
    ("exclamation", "[！!]", {"joy": 0.08, "surprise": 0.05}),
    ("question", "[？?]", {"fear": 0.08, "sadness": 0.08}),
)
BASE_SCORE = 0.05


def proxy_scores(captions: DataFrame, text: str, hints=PUNCTUATION_HINTS) -> DataFrame:
    """One score column per label and the names of the rules that matched."""
    hit = {name: F.col(text).rlike(pattern) for name, pattern, _ in hints}
    scores = {}
    for label in LABELS:
        value = F.lit(BASE_SCORE)
        for name, _, weights in hints:
            if label in weights:
                value = value + F.when(hit[name], weights[label]).otherwise(0.0)
        scores[label] = F.bround(F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)), 4)
    names = F.concat_ws(",", *[F.when(test, F.lit(name)) for name, test in hit.items()])
    return captions.withColumns(scores | {"matched": names})


def acoustic_intensity(captions: DataFrame, keys: Sequence[str], rms: str, centroid: str, f0: str, voiced: str, hot=None) -> DataFrame:
    """Weighted blend of robustly normalised loudness, brightness, log pitch and voiced share."""
    rows = captions.withColumn("__lf0", F.when(F.col(f0) > 0, F.log2(f0)))
    norm = robust_normalize(rows, keys, {rms: "__n_rms", centroid: "__n_cen", "__lf0": "__n_f0"}, hot)
    share = F.least(F.greatest(F.col(voiced), F.lit(0.0)), F.lit(1.0))
    blend = 0.55 * F.col("__n_rms") + 0.20 * F.col("__n_cen") + 0.15 * F.col("__n_f0") + 0.10 * share
    return norm.withColumn("acoustic_intensity", F.bround(blend, 4)).drop("__lf0", "__n_rms", "__n_cen", "__n_f0")


def top_labels(scores: dict[str, Column], n: int = 3) -> Column:
    """Labels of the ``n`` highest scores, label order on ties, joined by commas."""
    ranked = F.array_sort(F.array(*[
        F.struct((-score).alias("minus"), F.lit(i).alias("place"), F.lit(label).alias("label")) for i, (label, score) in enumerate(scores.items())
    ]))
    return F.array_join(F.transform(F.slice(ranked, 1, n), lambda s: s["label"]), ",")


def clip01(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))


def schedule(captions: DataFrame, keys: Sequence[str], start: str, end: str, weight: str) -> DataFrame:
    """One row of conversion parameters per group of captions; means weighted by duration."""
    w = F.nullif(F.sum(weight), F.lit(0))
    means = captions.groupBy(*keys).agg(
        F.min(start).alias("start"), F.max(end).alias("end"),
        *[(F.sum(F.col(c) * F.col(weight)) / w).alias(c) for c in (*LABELS, "acoustic_intensity")],
    )
    c = F.col
    arousal = clip01(0.35 * c("joy") + 0.30 * c("anticipation") + 0.15 * c("surprise") + 0.10 * c("anger") + 0.10 * c("fear"))
    tension = clip01(0.45 * c("sadness") + 0.30 * c("fear") + 0.20 * c("anger") + 0.15 * c("surprise"))
    rows = means.withColumns({"arousal": arousal, "tension": tension})
    rows = rows.withColumn("blended", clip01(0.72 * c("acoustic_intensity") + 0.28 * c("arousal")))
    mode = F.when((c("tension") >= 0.48) & (c("blended") >= 0.55), "tension_peak")
    mode = mode.when((c("joy") + c("anticipation") >= 0.65) & (c("blended") >= 0.38), "build")
    mode = mode.when(c("sadness") >= c("joy") + 0.08, "reflective").otherwise("warm_memory")
    return rows.select(
        *keys, "start", "end",
        clip_round(0.54 + 0.08 * c("blended"), 0.54, 0.62).alias("index_rate"),
        clip_round(0.28 + 0.07 * c("blended"), 0.28, 0.35).alias("rms_mix_rate"),
        clip_round(0.22 + 0.05 * c("tension"), 0.22, 0.27).alias("protect"),
        mode.alias("emotion_mode"), top_labels({l: c(l) for l in LABELS}).alias("semantic_top"),
        F.bround("arousal", 4).alias("semantic_arousal"), F.bround("acoustic_intensity", 4).alias("acoustic_intensity"), F.bround("blended", 4).alias("blended_intensity"),
    )
