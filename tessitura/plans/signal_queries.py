"""Frame, evidence, caption and chunk queries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions import models
from ..functions import scalar as fn
from ..operators import captions as cp
from ..operators import evidence as ev
from ..operators import signal as sg
from ..operators import stats as st
from ..operators.scans import find_hot_keys, following, row_number, scan
from .registry import query
from .views import SONG, Tables

LEVELS = """lv AS (SELECT song_id, frame, sqrt(p / 64) AS rms, pk AS peak FROM (SELECT song_id, frame, sum(x * x) AS p, max(abs(x)) AS pk FROM frame_values GROUP BY song_id, frame))"""


@query(f"WITH {LEVELS} SELECT song_id, frame, round(rms, 6) AS rms, round(20 * log10(greatest(rms, 1e-7)), 6) AS db, round(peak, 6) AS peak, peak >= 0.3 AS clipped FROM lv")
def frame_rms_peak(t: Tables):
    rows = sg.frame_features(t.frames(), full_scale=0.3)
    return rows.select("song_id", "frame", "clipped", *[F.round(c, 6).alias(c) for c in ("rms", "db", "peak")])


@query(f"WITH {LEVELS} SELECT song_id, count(*) AS n, round(quantile_cont(20 * log10(greatest(rms, 1e-7)), 0.1), 6) AS noise_floor FROM lv GROUP BY song_id")
def noise_floor(t: Tables):
    rows = sg.frame_features(t.frames())
    out = st.percentiles(rows, SONG, F.col("db"), {"noise_floor": ("linear", 0.1)}, t.hot("embeddings", "label", "song_id"))
    return out.withColumn("noise_floor", F.round("noise_floor", 6))


@query("SELECT song_id, round(20 * log10(greatest(max(abs(x)), 1e-12)), 4) AS peak_dbfs, round(20 * log10(greatest(sqrt(sum(x * x) / count(*)), 1e-12)), 4) AS rms_dbfs FROM frame_values GROUP BY song_id")
def clip_levels(t: Tables):
    return sg.clip_level(t.frames(), SONG)


@query("SELECT song_id, arg_max(frame, (p, -frame)) AS channel FROM (SELECT song_id, frame, sum(x * x) AS p FROM frame_values GROUP BY ALL) GROUP BY song_id")
def strongest_channel(t: Tables):
    return sg.strongest_channel(t.frames().withColumnRenamed("frame", "channel"), SONG)


RUNS = """pos AS (SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY frame, idx) - 1 AS pos FROM frame_values),
    rn AS (SELECT *, sum(CASE WHEN voiced THEN 0 ELSE 1 END) OVER (PARTITION BY song_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM pos)"""


@query(f"""WITH {RUNS}, tr AS (SELECT *, pos - lag(pos) OVER (PARTITION BY song_id ORDER BY pos) - 1 AS hole FROM rn WHERE voiced),
    h AS (SELECT song_id, coalesce(max(hole), 0) AS max_hole, count(*) AS true_rows FROM tr GROUP BY song_id),
    l AS (SELECT song_id, max(n) AS longest_run FROM (SELECT song_id, run, count(*) AS n FROM rn WHERE voiced GROUP BY ALL) GROUP BY song_id)
    SELECT song_id, count(*) AS rows, any_value(longest_run) AS longest_run, any_value(max_hole) AS max_hole, any_value(true_rows) AS true_rows FROM pos JOIN h USING (song_id) JOIN l USING (song_id) GROUP BY song_id""")
def longest_run(t: Tables):
    values = t.frame_values().select("song_id", "frame", "idx", "voiced")
    return st.run_lengths(values, SONG, ["frame", "idx"], F.col("voiced"), find_hot_keys(values, SONG))


@query("""WITH m AS (SELECT song_id, frame, idx, 69 + 12 * log2(f0 / 440) AS midi FROM frame_values),
    c AS (SELECT song_id, CAST(round_even(midi, 0) AS BIGINT) AS tone, count(*) AS c, min((frame, idx)) AS f, min(midi) AS lo, max(midi) AS hi FROM m GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY c DESC, f) AS rn, sum(c) OVER (PARTITION BY song_id) AS n, min(lo) OVER (PARTITION BY song_id) AS l, max(hi) OVER (PARTITION BY song_id) AS h FROM c)
    SELECT song_id, tone AS f0_mode_midi, round(c / n, 6) AS f0_mode_ratio, round(h - l, 6) AS f0_span_semitone, CAST(n AS BIGINT) AS f0_valid_count FROM r WHERE rn = 1""")
def pitch_mode(t: Tables):
    return st.pitch_mode(t.frame_values(), SONG, ["frame", "idx"], fn.hz_to_midi(F.col("f0")))


@query("""WITH d AS (SELECT a.song_id, 12 * abs(a.x - 5 * b.x) AS r FROM frame_values a JOIN frame_values b ON a.frame = b.frame AND a.idx = 63 - b.idx),
    j AS (SELECT *, least(r, abs(r - 12), abs(r - 24), r + 12, r + 24) AS a FROM d),
    s AS (SELECT song_id, max(r) AS max_delta, CAST(sum(CASE WHEN r - a >= 6 AND a <= 1 THEN 1 ELSE 0 END) AS BIGINT) AS octave_frames,
      CAST(sum(CASE WHEN r > 1 AND NOT (r - a >= 6 AND a <= 1) THEN 1 ELSE 0 END) AS BIGINT) AS over_1, CAST(sum(CASE WHEN r > 2 AND NOT (r - a >= 6 AND a <= 1) THEN 1 ELSE 0 END) AS BIGINT) AS over_2,
      count(*) AS n, list_sort(list(r)) AS lr, list_sort(list(a)) AS la FROM j GROUP BY song_id),
    p AS (SELECT song_id, max_delta, octave_frames, over_1, over_2, n, lr[n // 2 + 1] AS median_delta, lr[CAST(ceil(n * 0.95) AS BIGINT)] AS p95_delta, la[n // 2 + 1] AS adjusted_median, la[CAST(ceil(n * 0.95) AS BIGINT)] AS adjusted_p95 FROM s)
    SELECT song_id, round(max_delta, 6) AS max_delta, octave_frames, over_1, over_2, n, round(median_delta, 6) AS median_delta, round(p95_delta, 6) AS p95_delta, round(adjusted_median, 6) AS adjusted_median, round(adjusted_p95, 6) AS adjusted_p95,
      CASE WHEN median_delta <= 0.5 AND p95_delta <= 1 THEN 'raw' WHEN median_delta <= 0.5 AND adjusted_median <= 0.5 AND octave_frames / n <= 0.1 AND over_1 / n <= 0.1 AND over_2 / n <= 0.05 THEN 'robust_crosscheck' ELSE 'blocked' END AS pitch_gate FROM p""")
def pitch_delta_summary(t: Tables):
    x = sg.as_double(F.col("samples"))
    delta = F.zip_with(x, F.reverse(x), lambda a, b: 12 * F.abs(a - 5 * b))
    rows = t.frames().select("song_id", F.explode(delta).alias("raw"))
    out = st.pitch_delta_summary(rows, SONG, F.col("raw"), find_hot_keys(rows, SONG))
    return out.withColumns({c: F.round(c, 6) for c in ("max_delta", "median_delta", "p95_delta", "adjusted_median", "adjusted_p95")})


GAPS = """sz AS (SELECT song_id, count(*) AS n FROM pos GROUP BY song_id),
    gp AS (SELECT song_id, g AS gap_id, 40 * g + 20 AS gap_from, 40 * g + 30 AS gap_to FROM sz, LATERAL (SELECT unnest(generate_series(0, (n - 30) // 40)) AS g)),
    inn AS (SELECT g.song_id, gap_id, count(*) AS n_in, sum(x * x) AS p_in, sum(CASE WHEN voiced THEN 1 ELSE 0 END) AS v FROM gp g JOIN rn p ON p.song_id = g.song_id AND pos >= gap_from AND pos < gap_to GROUP BY ALL),
    rl AS (SELECT song_id, gap_id, max(k) AS run FROM (SELECT g.song_id, gap_id, run, sum(CASE WHEN voiced THEN 1 ELSE 0 END) AS k FROM gp g JOIN rn p ON p.song_id = g.song_id AND pos >= gap_from AND pos < gap_to GROUP BY ALL) GROUP BY ALL),
    ctx AS (SELECT g.song_id, gap_id, count(*) AS n_out, sum(x * x) AS p_out, max(CASE WHEN voiced THEN x * x END) AS loud FROM gp g JOIN pos p ON p.song_id = g.song_id AND ((pos >= gap_from - 10 AND pos < gap_from) OR (pos >= gap_to AND pos < gap_to + 10)) GROUP BY ALL),
    ms AS (SELECT *, round(20 * log10(greatest(sqrt(p_in / n_in), 1e-9)), 6) AS gap_dbfs, round(20 * log10(greatest(sqrt(p_out / n_out), 1e-9)), 6) AS neighbor_dbfs, round(v / n_in, 6) AS voiced_ratio, round(run / n_in, 6) AS voiced_run_ratio,
      CASE WHEN loud IS NOT NULL THEN round(20 * log10(greatest(sqrt(loud), 1e-7)), 6) END AS adj FROM gp JOIN inn USING (song_id, gap_id) JOIN rl USING (song_id, gap_id) JOIN ctx USING (song_id, gap_id))"""


def _series(t: Tables):
    """The samples of a song as one series of frames, and a gap of 10 frames every 40."""
    values = t.frame_values().select("song_id", "frame", "idx", "x", "voiced")
    hot = find_hot_keys(values, SONG)
    placed = scan(values, SONG, ["frame", "idx"], [row_number("n")], hot)
    frames = placed.select("song_id", (F.col("n") - 1).alias("pos"), (F.col("x") * F.col("x")).alias("power"), "voiced")
    size = values.groupBy("song_id").agg(F.count(F.lit(1)).alias("n"))
    gaps = size.select("song_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("(n - 30) div 40"))).alias("gap_id"))
    return frames, gaps.select("song_id", "gap_id", (40 * F.col("gap_id") + 20).alias("gap_from"), (40 * F.col("gap_id") + 30).alias("gap_to")), hot


@query(f"""WITH {RUNS}, {GAPS} SELECT song_id, gap_id, gap_from, gap_to, n_in AS frame_count, gap_dbfs, neighbor_dbfs, voiced_ratio, voiced_run_ratio, round(gap_dbfs - neighbor_dbfs, 6) AS relative_db,
    CASE WHEN voiced_ratio >= 0.1 OR voiced_run_ratio >= 0.1 THEN 'VOCAL_EVIDENCE' WHEN gap_dbfs <= -45 OR (gap_dbfs <= -30 AND gap_dbfs - neighbor_dbfs <= -15) THEN 'REST_CANDIDATE' ELSE 'EVIDENCE_INSUFFICIENT' END AS status FROM ms""")
def gap_evidence(t: Tables):
    frames, gaps, hot = _series(t)
    return ev.gap_evidence(frames, gaps, 10, 1000, hot)


@query(f"""WITH {RUNS}, {GAPS}, fl AS (SELECT song_id, round(quantile_cont(20 * log10(greatest(abs(x), 1e-7)), 0.1), 6) AS noise_floor FROM pos GROUP BY song_id),
    en AS (SELECT g.song_id, gap_id, round(avg(20 * log10(greatest(abs(x), 1e-7))), 6) AS energy_db FROM gp g JOIN pos p ON p.song_id = g.song_id AND pos >= gap_from AND pos < gap_to GROUP BY ALL)
    SELECT song_id, gap_id, gap_from, gap_to, n_in AS frame_count, voiced_ratio, adj AS adjacent_voiced_dbfs, energy_db, noise_floor,
    CASE WHEN energy_db <= noise_floor + 6 AND (adj IS NULL OR energy_db <= adj - 12) AND voiced_ratio <= 0.1 THEN 'PASS' ELSE 'BLOCKED' END AS status FROM ms JOIN fl USING (song_id) JOIN en USING (song_id, gap_id)""")
def rest_evidence(t: Tables):
    frames, gaps, hot = _series(t)
    return ev.rest_evidence(frames, gaps, 10, 1000, hot)


@query(None)
def frame_pitch(t: Tables):
    """Autocorrelation pitch of every frame; NumPy inside Arrow batches, no SQL form."""
    pitch = sg.autocorrelation_pitch(6_400, 100.0, 1_100.0, min_energy=0.0)
    return t.frames().select("song_id", "frame", F.round(pitch("samples"), 4).alias("f0"))


# -- captions -----------------------------------------------------------------------

HINTS = (("commas", ",", {"joy": 0.38, "surprise": 0.05}), ("stops", r"\. ", {"fear": 0.08, "sadness": 0.48}))


@query("""WITH s AS (SELECT song, id, CASE WHEN contains(text, ',') THEN 1 ELSE 0 END AS c, CASE WHEN contains(text, '. ') THEN 1 ELSE 0 END AS d FROM captions)
    SELECT song, id, round(0.05 + c * 0.38, 4) AS joy, round(0.05 + d * 0.48, 4) AS sadness, round(0.05 + c * 0.05, 4) AS surprise, round(0.05 + d * 0.08, 4) AS fear, concat_ws(',', CASE WHEN c = 1 THEN 'commas' END, CASE WHEN d = 1 THEN 'stops' END) AS matched FROM s""")
def caption_scores(t: Tables):
    return cp.proxy_scores(t.captions(), "text", HINTS).select("song", "id", "joy", "sadness", "surprise", "fear", "matched")


INTENSITY = """b AS (SELECT song, quantile_cont(CAST(commas AS DOUBLE), 0.1) AS c1, quantile_cont(CAST(commas AS DOUBLE), 0.9) AS c9, quantile_cont(CAST(stops AS DOUBLE), 0.1) AS s1, quantile_cont(CAST(stops AS DOUBLE), 0.9) AS s9,
      quantile_cont(CASE WHEN blanks > 0 THEN log2(blanks) END, 0.1) AS b1, quantile_cont(CASE WHEN blanks > 0 THEN log2(blanks) END, 0.9) AS b9 FROM captions GROUP BY song),
    it AS (SELECT c.*, round_even(0.55 * CASE WHEN c9 - c1 < 1e-8 THEN 0.5 ELSE least(greatest((commas - c1) / (c9 - c1), 0), 1) END + 0.20 * CASE WHEN s9 - s1 < 1e-8 THEN 0.5 ELSE least(greatest((stops - s1) / (s9 - s1), 0), 1) END
      + 0.15 * CASE WHEN blanks = 0 OR b9 - b1 < 1e-8 THEN 0.5 ELSE least(greatest((log2(blanks) - b1) / (b9 - b1), 0), 1) END + 0.10 * ((id % 4) / 4), 4) AS acoustic_intensity FROM captions c JOIN b USING (song))"""


def _intensity(t: Tables):
    rows = t.captions().withColumn("voiced", F.col("id") % 4 / 4)
    return cp.acoustic_intensity(rows, ["song"], "commas", "stops", "blanks", "voiced", t.hot_conversations)


@query(f"WITH {INTENSITY} SELECT song, id, acoustic_intensity FROM it")
def robust_norm(t: Tables):
    return _intensity(t).select("song", "id", "acoustic_intensity")


@query(f"""WITH {INTENSITY}, sc AS (SELECT *, 0.05 + CASE WHEN contains(text, ',') THEN 0.38 ELSE 0 END AS joy, 0.05 + CASE WHEN contains(text, '. ') THEN 0.48 ELSE 0 END AS sad,
      0.05 + CASE WHEN contains(text, ',') THEN 0.05 ELSE 0 END AS sur, 0.05 + CASE WHEN contains(text, '. ') THEN 0.08 ELSE 0 END AS fear FROM it),
    mn AS (SELECT song, min(start_ms) AS "start", max(start_ms + duration_ms) AS "end", sum(joy * duration_ms) / sum(duration_ms) AS joy, sum(sad * duration_ms) / sum(duration_ms) AS sad, sum(sur * duration_ms) / sum(duration_ms) AS sur,
      sum(fear * duration_ms) / sum(duration_ms) AS fear, sum(acoustic_intensity * duration_ms) / sum(duration_ms) AS ai FROM sc GROUP BY song),
    ar AS (SELECT *, 0.35 * joy + 0.30 * 0.05 + 0.15 * sur + 0.10 * 0.05 + 0.10 * fear AS arousal, 0.45 * sad + 0.30 * fear + 0.20 * 0.05 + 0.15 * sur AS tension FROM mn),
    bl AS (SELECT *, 0.72 * ai + 0.28 * arousal AS blended FROM ar)
    SELECT song, CAST("start" AS BIGINT) AS "start", CAST("end" AS BIGINT) AS "end", round_even(least(greatest(0.54 + 0.08 * blended, 0.54), 0.62), 3) AS index_rate, round_even(0.28 + 0.07 * blended, 3) AS rms_mix_rate, round_even(least(0.22 + 0.05 * tension, 0.27), 3) AS protect,
    CASE WHEN tension >= 0.48 AND blended >= 0.55 THEN 'tension_peak' WHEN joy + 0.05 >= 0.65 AND blended >= 0.38 THEN 'build' WHEN sad >= joy + 0.08 THEN 'reflective' ELSE 'warm_memory' END AS emotion_mode,
    round_even(arousal, 4) AS semantic_arousal, round_even(ai, 4) AS acoustic_intensity, round_even(blended, 4) AS blended_intensity FROM bl""")
def caption_schedule(t: Tables):
    scored = cp.proxy_scores(_intensity(t), "text", HINTS).withColumn("end_ms", F.col("start_ms") + F.col("duration_ms"))
    return cp.schedule(scored, ["song"], "start_ms", "end_ms", "duration_ms").drop("semantic_top")


@query("""WITH s AS (SELECT song, id, [commas, stops, blanks % 7, id] AS v FROM captions),
    u AS (SELECT song, id, v[i] AS v, i, ['joy', 'sadness', 'anticipation', 'surprise'][i] AS label FROM s, range(1, 5) AS r(i)),
    r AS (SELECT *, row_number() OVER (PARTITION BY song, id ORDER BY v DESC, i) AS rn FROM u)
    SELECT song, id, string_agg(label, ',' ORDER BY rn) AS top FROM r WHERE rn <= 3 GROUP BY song, id""")
def top_emotions(t: Tables):
    scores = {"joy": F.col("commas"), "sadness": F.col("stops"), "anticipation": F.col("blanks") % 7, "surprise": F.col("id")}
    return t.captions().select("song", "id", cp.top_labels(scores).alias("top"))


@query("""SELECT clip_id, 1 + s // 700 AS chunk_id, s AS core_start, least(s + 700, duration_ms) AS core_end, greatest(s - 50, 0) AS segment_start, least(least(s + 700, duration_ms) + 50, duration_ms) AS segment_end,
    CASE WHEN s + 700 >= duration_ms THEN 60 ELSE 0 END AS right_padding FROM clips, LATERAL (SELECT unnest(generate_series(0, duration_ms - 1, 700)) AS s)""")
def chunk_plan(t: Tables):
    return sg.chunk_plan(t.clips().select("clip_id", "duration_ms"), ["clip_id"], "duration_ms", 700, 50, 60)


@query("""WITH k AS (SELECT song, id, start_ms, start_ms + duration_ms AS end_ms FROM captions WHERE id % 5 <> 3), l AS (SELECT *, lead(start_ms) OVER w AS nx, lead(id) OVER w AS nid FROM k WINDOW w AS (PARTITION BY song ORDER BY start_ms, id))
    SELECT song, id AS left_id, nid AS right_id, CAST(end_ms AS BIGINT) AS boundary_ms FROM l WHERE end_ms = nx""")
def continuous_boundaries(t: Tables):
    rows = t.captions().where("id % 5 <> 3").select("song", "id", "start_ms", (F.col("start_ms") + F.col("duration_ms")).alias("end_ms"))
    ahead = scan(rows, ["song"], ["start_ms", "id"], [following("nx", F.struct("start_ms", "id"))], t.hot_conversations)
    return ahead.where(F.col("end_ms") == F.col("nx.start_ms")).select("song", F.col("id").alias("left_id"), F.col("nx.id").alias("right_id"), F.col("end_ms").alias("boundary_ms"))


@query("""SELECT song_id, frame, CAST(n AS BIGINT) AS boundary, round(coalesce(abs(x - px), 0), 6) AS jump FROM (SELECT *, row_number() OVER w - 1 AS n, lag(x) OVER w AS px FROM frame_values WINDOW w AS (PARTITION BY song_id ORDER BY frame, idx)) WHERE idx = 0""")
def boundary_jumps(t: Tables):
    """Jump of the signal where frames of one song meet."""
    values = t.frame_values().select("song_id", "frame", "idx", "x")
    placed = scan(values, SONG, ["frame", "idx"], [row_number("n")], find_hot_keys(values, SONG)).withColumn("n", F.col("n") - 1)
    meets = placed.where("idx = 0").select("song_id", "frame", F.col("n").alias("boundary"))
    out = sg.boundary_jumps(meets, placed.select("song_id", "n", F.col("x").cast("double").alias("x")), SONG, "boundary", "n", "x")
    return out.withColumn("jump", F.round("jump", 6))


@query("SELECT a.frame, a.idx, round(a.x * (1 - a.idx / 63) + b.x * (a.idx / 63), 6) AS mixed FROM frame_values a JOIN frame_values b ON b.frame = a.frame + 1 AND b.idx = a.idx")
def crossfade(t: Tables):
    v = t.frame_values().select("frame", "idx", "x")
    out = sg.crossfade(v, v.withColumn("frame", F.col("frame") - 1), ["frame"], "idx", "x", 64)
    return out.withColumn("mixed", F.round("mixed", 6))


@query("""WITH m AS (SELECT a.frame, a.idx, b.x * 3 + a.x * 3 * pow(10, 3.0 / 20) AS raw FROM frame_values a JOIN frame_values b ON b.frame = a.frame AND b.idx = 63 - a.idx), p AS (SELECT frame, max(abs(raw)) AS peak FROM m GROUP BY frame)
    SELECT frame, idx, round(raw * CASE WHEN peak > 0.98 THEN 0.98 / peak ELSE 1 END, 6) AS mixed FROM m JOIN p USING (frame)""")
def peak_limited_mix(t: Tables):
    v = t.frame_values().select("frame", "idx", (F.col("x") * 3).alias("x"))
    out = sg.peak_limited_mix(v, v.withColumn("idx", 63 - F.col("idx")), ["frame"], ["idx"], "x", 3.0)
    return out.withColumn("mixed", F.round("mixed", 6))


@query("""WITH f AS (SELECT n.song_id, n.note_index, n.pitch, CAST(40 + k % 50 AS BIGINT) AS heard FROM notes n JOIN (SELECT song_id, start_us, min(k) AS k FROM ev GROUP BY ALL) e USING (song_id, start_us))
    SELECT song_id, note_index, round(least(abs(d), abs(d - 12), abs(d + 12), abs(d - 24), abs(d + 24)), 6) AS distance, least(abs(d), abs(d - 12), abs(d + 12), abs(d - 24), abs(d + 24)) <= 0.75 AS matches FROM (SELECT *, CAST(heard - pitch AS DOUBLE) AS d FROM f)""")
def f0_note_check(t: Tables):
    heard = t.timed_events().groupBy("song_id", "start_us").agg((40 + F.min("k") % 50).alias("heard"))
    rows = t.notes().join(heard, ["song_id", "start_us"])
    gap = fn.octave_distance((F.col("heard") - F.col("pitch")).cast("double"))
    return rows.select("song_id", "note_index", F.round(gap, 6).alias("distance"), (gap <= 0.75).alias("matches"))


def _vowel_weights():
    return {"a": 0.5, "e": 0.25, "i": -0.25, "o": 0.125, "u": -0.5}


def _vowel_mean(weights, texts):
    """Mean weight of the vowels of each text; a text with a question mark is refused."""
    found = [[weights[c] for c in x.lower() if c in weights] for x in texts]
    return pd.Series([None if "?" in x or not v else sum(v) / len(v) for x, v in zip(texts, found)], dtype=object)


@query("""WITH v AS (SELECT song, id, text, commas, len(regexp_replace(lower(text), '[^a]', '', 'g')) AS a, len(regexp_replace(lower(text), '[^e]', '', 'g')) AS e, len(regexp_replace(lower(text), '[^i]', '', 'g')) AS i,
        len(regexp_replace(lower(text), '[^o]', '', 'g')) AS o, len(regexp_replace(lower(text), '[^u]', '', 'g')) AS u FROM captions),
    w AS (SELECT *, contains(text, '?') OR a + e + i + o + u = 0 AS refused FROM v)
    SELECT song, id, round(CASE WHEN refused THEN 0.1 * commas ELSE (0.5 * a + 0.25 * e - 0.25 * i + 0.125 * o - 0.5 * u) / (a + e + i + o + u) END, 6) AS score, CASE WHEN refused THEN 'RULE_REFUSED' ELSE 'MODEL' END AS score_status FROM w""")
def model_scores(t: Tables):
    """A user's scorer on distinct caption texts, with a rule where it refuses."""
    rows = t.captions().select("song", "id", "text", "commas")
    scored = models.with_model(rows, "text", _vowel_weights, _vowel_mean, "double", F.col("commas") * F.lit(0.1), "score")
    return scored.select("song", "id", F.round("score", 6).alias("score"), "score_status")
