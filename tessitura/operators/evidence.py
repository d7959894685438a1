"""Acoustic evidence for gaps and rests, and the repairs it allows.

Frame tables have one row per frame (``song_id, pos, power, voiced``); pitch series of
the two backends are input columns. Evidence is a join of frames and gaps on time bins,
never a decode of one whole recording in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import dbfs
from .intervals import overlap_join
from .scans import following, previous, refine, running_sum, scan
from .stats import percentiles

SONG = ["song_id"]
# Fixed value: least voiced share for the sparse two-backend rule.
SPARSE_MIN_VOICED = 0.10


def classify_gap(gap_db: Column, neighbor_db: Column, voiced: Column, run: Column) -> Column:
    """VOCAL_EVIDENCE, REST_CANDIDATE or EVIDENCE_INSUFFICIENT by fixed thresholds."""
    relative = gap_db - neighbor_db
    quiet = (gap_db <= -45.0) | ((gap_db <= -30.0) & F.coalesce(relative <= -15.0, F.lit(False)))
    vocal = (F.coalesce(voiced, F.lit(1.0)) >= 0.1) | (F.coalesce(run, F.lit(1.0)) >= 0.1)
    return F.when(vocal, "VOCAL_EVIDENCE").when(F.coalesce(quiet, F.lit(False)), "REST_CANDIDATE").otherwise("EVIDENCE_INSUFFICIENT")


def gap_measures(frames: DataFrame, gaps: DataFrame, context: int, bin_width: int, hot=None) -> DataFrame:
    """Level in and around each gap, voiced share and longest voiced run as a share.

    ``gaps`` has ``song_id, gap_id, gap_from, gap_to`` in frame positions, half open.
    Gaps without a frame are kept with null levels.
    """
    runs = scan(frames, SONG, ["pos"], [running_sum("__run", F.when(F.col("voiced"), 0).otherwise(1))], hot)
    points = runs.withColumn("pos_end", F.col("pos") + 1)
    wide = gaps.withColumn("w_from", F.greatest(F.col("gap_from") - context, F.lit(0))).withColumn("w_to", F.col("gap_to") + context)
    pairs = overlap_join(
        points, wide, SONG, bin_width, (F.col("pos") >= F.col("w_from")) & (F.col("pos") < F.col("w_to")), ("pos", "pos_end"), ("w_from", "w_to")
    )
    inside = (F.col("pos") >= F.col("gap_from")) & (F.col("pos") < F.col("gap_to"))
    per_run = pairs.groupBy("song_id", "gap_id", "__run").agg(
        F.count_if(inside).alias("n_in"), F.sum(F.when(inside, F.col("power"))).alias("p_in"),
        F.count_if(~inside).alias("n_out"), F.sum(F.when(~inside, F.col("power"))).alias("p_out"),
        F.count_if(inside & F.col("voiced")).alias("v"),
        F.max(F.when(~inside & F.col("voiced"), F.col("power"))).alias("loudest"),
    )
    whole = per_run.groupBy("song_id", "gap_id").agg(
        *[F.sum(c).alias(c) for c in ("n_in", "p_in", "n_out", "p_out", "v")], F.max("v").alias("run"), F.max("loudest").alias("loudest")
    )
    n = F.nullif("n_in", F.lit(0))
    return gaps.join(whole, ["song_id", "gap_id"], "left").select(
        *gaps.columns,
        F.coalesce("n_in", F.lit(0)).alias("frame_count"),
        F.round(dbfs(F.sqrt(F.coalesce(F.col("p_in") / n, F.lit(0.0)))), 6).alias("gap_dbfs"),
        F.round(dbfs(F.sqrt(F.coalesce(F.col("p_out") / F.nullif("n_out", F.lit(0)), F.lit(0.0)))), 6).alias("neighbor_dbfs"),
        F.round(F.coalesce(F.col("v") / n, F.lit(0.0)), 6).alias("voiced_ratio"),
        F.round(F.coalesce(F.col("run") / n, F.lit(0.0)), 6).alias("voiced_run_ratio"),
        F.when(F.col("loudest").isNotNull(), F.round(dbfs(F.sqrt("loudest"), 1e-7), 6)).alias("adjacent_voiced_dbfs"),
    )


def gap_evidence(frames, gaps, context, bin_width, hot=None) -> DataFrame:
    m = gap_measures(frames, gaps, context, bin_width, hot)
    status = classify_gap(F.col("gap_dbfs"), F.col("neighbor_dbfs"), F.col("voiced_ratio"), F.col("voiced_run_ratio"))
    return m.drop("adjacent_voiced_dbfs").withColumns(
        {"relative_db": F.round(F.col("gap_dbfs") - F.col("neighbor_dbfs"), 6), "status": status}
    )


def rest_evidence(frames, rests, context, bin_width, hot=None) -> DataFrame:
    """PASS when a rest is near the noise floor, well below its voiced neighbours, and unvoiced.

    The level of a rest is the mean of its frame levels; the noise floor is the 10th
    percentile of the frame levels of the song.
    """
    level = dbfs(F.sqrt("power"), 1e-7)
    floor = percentiles(frames, SONG, level, {"noise_floor": ("linear", 0.10)}, hot).drop("n")
    m = gap_measures(frames, rests, context, bin_width, hot).select(*rests.columns, "frame_count", "voiced_ratio", "adjacent_voiced_dbfs")
    points = frames.select("song_id", "pos", level.alias("db")).withColumn("pos_end", F.col("pos") + 1)
    pairs = overlap_join(
        points, rests, SONG, bin_width, (F.col("pos") >= F.col("gap_from")) & (F.col("pos") < F.col("gap_to")), ("pos", "pos_end"), ("gap_from", "gap_to")
    )
    energy = pairs.groupBy("song_id", "gap_id").agg(F.round(F.avg("db"), 6).alias("energy_db"))
    both = m.join(energy, ["song_id", "gap_id"], "left").join(floor, SONG, "left").withColumn("noise_floor", F.round("noise_floor", 6))
    energy_ok = F.col("energy_db") <= F.col("noise_floor") + 6.0
    contrast_ok = F.col("adjacent_voiced_dbfs").isNull() | (F.col("energy_db") <= F.col("adjacent_voiced_dbfs") - 12.0)
    f0_ok = F.col("voiced_ratio") <= 0.1
    return both.withColumn("status", F.when(energy_ok & contrast_ok & f0_ok, "PASS").otherwise("BLOCKED"))


def dual_gate(a: Column, b: Column, note_midi: Column | None = None, island=0.08, hole=0.03, delta=0.5) -> Column:
    """Reasons why two pitch backends do not support singing together; empty means accepted.

    ``a`` and ``b`` are structs (voiced_ratio, longest_voiced_sec, max_hole_sec, median_midi).
    """
    tests = {}
    either = lambda f: f(a) | f(b)
    diff = F.abs(a["median_midi"] - b["median_midi"])
    tests["backend_pitch_disagreement"] = F.coalesce(diff > delta, F.lit(True))
    tests["f0_hole"] = either(lambda s: F.coalesce(s["max_hole_sec"] > hole, F.lit(True)))
    if note_midi is not None:
        off = lambda s: note_midi.isNotNull() & F.coalesce(F.abs(s["median_midi"] - note_midi) > delta, F.lit(True))
        tests["first_note_pitch_mismatch"] = off(a)
    tests["no_voiced_frame"] = either(lambda s: F.coalesce(s["voiced_ratio"] <= 0, F.lit(True)))
    if note_midi is not None:
        tests["second_note_pitch_mismatch"] = off(b)
    tests["voiced_island"] = either(lambda s: F.coalesce(s["longest_voiced_sec"] < island, F.lit(True)))
    return F.array_sort(F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()])))


def gap_action(rows: DataFrame) -> DataFrame:
    """Status and action of a gap from both backends, its levels and its neighbours.

    Columns: ``a``, ``b`` (structs as in ``dual_gate``), ``left_pitch``, ``right_pitch``,
    ``gap_dbfs``, ``neighbor_dbfs``, ``noise_floor_dbfs``, ``hnr_db``, ``flatness``, ``length_sec``.
    """
    near = lambda p: F.coalesce((F.abs(F.col("a.median_midi") - F.col(p)) <= 0.5) & (F.abs(F.col("b.median_midi") - F.col(p)) <= 0.5), F.lit(False))
    left, right = near("left_pitch"), near("right_pitch")
    same = F.coalesce(F.col("left_pitch") == F.col("right_pitch"), F.lit(False))
    reasons = dual_gate(F.col("a"), F.col("b"), F.when(same, F.col("left_pitch")))
    low = lambda s: F.coalesce(F.col(f"{s}.voiced_ratio") < 0.1, F.lit(False))
    side = lambda suffix: F.when(left & ~right, f"EXTEND_LEFT_F0_{suffix}").when(right & ~left, f"EXTEND_RIGHT_F0_{suffix}").when(
        left & right & same, f"EXTEND_LEFT_F0_{suffix}"
    )
    voiced = F.least(F.coalesce("a.voiced_ratio", F.lit(0.0)), F.coalesce("b.voiced_ratio", F.lit(0.0)))
    sparse = F.when(voiced >= SPARSE_MIN_VOICED, side("DUAL_SPARSE"))
    quiet = low("a") & low("b")
    pause = quiet & (F.col("gap_dbfs") <= F.col("noise_floor_dbfs") + 6.0) & (F.col("gap_dbfs") - F.col("neighbor_dbfs") <= -12.0)
    breath = quiet & F.col("length_sec").between(0.05, 0.8) & (F.col("hnr_db") <= 5.0) & (F.col("flatness") >= 0.2)
    ok = F.size(reasons) == 0
    status = F.when(ok, "VOCAL_SUPPORTED").when(sparse.isNotNull(), "VOCAL_SUPPORTED_SPARSE_DUAL").when(pause, "SP_CONFIRMED")
    action = F.when(ok, F.coalesce(side("DUAL"), F.lit("PRUNE_PHRASE_NO_GAME_SUPPORT"))).when(sparse.isNotNull(), sparse).when(pause, "CLASSIFY_SP")
    return rows.withColumns(
        {
            "gate_reasons": F.array_join(reasons, ","),
            "status": status.when(breath, "AP_CONFIRMED").otherwise("AMBIGUOUS"),
            "resolution_action": action.when(breath, "CLASSIFY_AP").otherwise("PRUNE_INTERVAL"),
        }
    )


def repair_gaps(notes: DataFrame, evidence: DataFrame, max_gap: int, hot=None) -> DataFrame:
    """Extend the left note over a voiced gap: same pitch on both sides, or a left-pitch match.

    ``evidence`` is keyed by ``song_id, boundary_index`` (the right note's index) with
    status, gap_len, voiced_ratio, mode_ratio, span_semitone, pitch_match, matches_left,
    matches_right, gap_dbfs, relative_db. One row per repaired note.
    """
    ahead = scan(
        notes, SONG, ["note_index"],
        [following("next_start", F.col("start_us")), following("next_pitch", F.col("pitch"))], hot,
    ).withColumn("boundary_index", F.col("note_index") + 1)
    rows = ahead.join(evidence, ["song_id", "boundary_index"])
    base = (F.col("status") == "VOCAL_EVIDENCE") & (F.col("next_start") > F.col("end_us")) & (F.col("gap_len") <= max_gap)
    same = (
        (F.col("voiced_ratio") >= 0.35) & F.coalesce("pitch_match", F.lit(True)) & (F.coalesce("mode_ratio", F.lit(1.0)) >= 0.75)
        & (F.coalesce("span_semitone", F.lit(0.0)) <= 2.0) & (F.col("pitch") == F.col("next_pitch"))
    )
    left = (
        (F.col("voiced_ratio") >= 0.25) & (F.col("mode_ratio") >= 0.9) & (F.col("span_semitone") <= 2.0) & (F.col("gap_dbfs") > -30.0)
        & (F.col("relative_db") > -15.0) & F.col("matches_left") & ~F.coalesce("matches_right", F.lit(False))
    )
    how = F.when(base & same, "EXTEND_LEFT_SAME_PITCH_NOTE").when(base & left, "EXTEND_LEFT_F0_MATCHED_NOTE")
    return rows.withColumn("resolution", how).where("resolution is not null").select(
        "song_id", "boundary_index", "note_index", "pitch", "start_us", F.col("end_us").alias("old_end"), F.col("next_start").alias("new_end"), "resolution"
    )


def apply_decisions(notes: DataFrame, decisions: DataFrame, hot=None):
    """Extend notes left or right of a boundary as decided; other boundaries become cut intervals.

    ``decisions``: ``song_id, boundary_index, action``. Returns (notes, cuts).
    """
    rows = scan(notes, SONG, ["note_index"], [following("next_start", F.col("start_us")), previous("last_end", F.col("end_us"))], hot)
    after = decisions.select("song_id", (F.col("boundary_index") - 1).alias("note_index"), F.col("action").alias("after"))
    before = decisions.select("song_id", F.col("boundary_index").alias("note_index"), F.col("action").alias("before"))
    both = rows.join(after, ["song_id", "note_index"], "left").join(before, ["song_id", "note_index"], "left")
    gap_after, gap_before = F.col("next_start") > F.col("end_us"), F.col("start_us") > F.col("last_end")
    moved = both.select(
        *[c for c in notes.columns if c not in ("start_us", "end_us")],
        F.when(F.col("before").startswith("EXTEND_RIGHT") & gap_before, F.col("last_end")).otherwise(F.col("start_us")).alias("start_us"),
        F.when(F.col("after").startswith("EXTEND_LEFT") & gap_after, F.col("next_start")).otherwise(F.col("end_us")).alias("end_us"),
    )
    cuts = both.where(F.col("before").startswith("PRUNE") & gap_before).select(
        "song_id", F.col("last_end").alias("start_us"), F.col("start_us").alias("end_us"), F.col("before").alias("reason")
    )
    return moved, cuts


def interval_features(frames: DataFrame, spans: DataFrame, bin_width: int, voice_db: float, hot=None) -> DataFrame:
    """Loudness, brightness, pitch and voiced share of each interval.

    ``frames``: song_id, pos, db, centroid, f0. ``spans``: song_id, span_id, s_from, s_to. Gives the
    75th percentile of db, the median centroid, the median f0 of voiced frames and the
    voiced ratio; an interval without frames has nulls and ratio 0.
    """
    key = ["song_id", "span_id"]
    points = frames.withColumn("pos_end", F.col("pos") + 1)
    pairs = overlap_join(points, spans, SONG, bin_width, (F.col("pos") >= F.col("s_from")) & (F.col("pos") < F.col("s_to")), ("pos", "pos_end"), ("s_from", "s_to"))
    voiced = F.col("db") > voice_db
    kinds = F.array(
        F.struct(F.lit("db").alias("k"), F.col("db").alias("x")), F.struct(F.lit("centroid").alias("k"), F.col("centroid").alias("x")),
        F.struct(F.lit("f0").alias("k"), F.when(voiced, F.col("f0")).alias("x")),
    )
    long = pairs.select(*key, F.explode(kinds).alias("e")).select(*key, "e.*")
    p = percentiles(long, [*key, "k"], F.col("x"), {"p50": ("linear", 0.5), "p75": ("linear", 0.75)}, refine(hot, long, [*key, "k"]))
    pick = lambda k, c, name: F.round(F.max(F.when(F.col("k") == k, F.col(c))), 4).alias(name)
    wide = p.groupBy(*key).agg(pick("db", "p75", "rms_db"), pick("centroid", "p50", "centroid_hz"), pick("f0", "p50", "f0_median_hz"))
    share = pairs.groupBy(*key).agg(F.round(F.avg(F.when(voiced, 1.0).otherwise(0.0)), 4).alias("voiced_ratio"))
    return spans.select(*key).join(wide, key, "left").join(share, key, "left").fillna(0.0, ["voiced_ratio"])
