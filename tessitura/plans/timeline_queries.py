"""Timeline queries: gaps, overlaps, unions, coverage, rests, pairing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals as iv
from ..operators import pairing, windows
from ..operators.scans import running_sum, scan
from .registry import query
from .views import HOUR_US, SONG, Tables

BIN = 6 * HOUR_US
ORDER = ["start_us", "note_index"]
MINUTE_US = 60_000_000

AUDIT = """
    audited AS (
        SELECT n.song_id, n.note_index, count(w.start_us) AS hits,
               count_if(w.start_us IS NOT NULL AND n.start_us >= w.start_us AND n.end_us <= w.end_us) AS inside,
               CASE WHEN max(n.end_us) <= max(n.start_us) THEN 'invalid'
                    WHEN count(w.start_us) = 1 AND count_if(w.start_us IS NOT NULL AND n.start_us >= w.start_us AND n.end_us <= w.end_us) = 1 THEN 'contained'
                    WHEN count(w.start_us) > 0 THEN 'cut' ELSE 'outside' END AS status
        FROM notes n LEFT JOIN windows w ON n.song_id = w.song_id AND n.end_us > w.start_us AND n.start_us < w.end_us
             AND n.end_us > n.start_us
        GROUP BY n.song_id, n.note_index)"""


@query(f"WITH {AUDIT} SELECT song_id, note_index, hits, inside, status FROM audited")
def note_window_audit(t: Tables):
    return windows.audit_notes(t.notes(), t.windows())


@query(f"""WITH {AUDIT},
    n AS (SELECT song_id, count(*) AS note_count, count_if(status='contained') AS contained, count_if(status='cut') AS cut,
                 count_if(status='outside') AS outside, count_if(status='invalid') AS invalid FROM audited GROUP BY song_id),
    w AS (SELECT w.song_id, count(*) AS window_count, count_if(NOT EXISTS (SELECT 1 FROM notes n WHERE n.song_id = w.song_id
                 AND n.end_us > n.start_us AND n.end_us > w.start_us AND n.start_us < w.end_us)) AS empty_windows
          FROM windows w GROUP BY w.song_id)
    SELECT song_id, note_count, contained, cut, outside, invalid, window_count, empty_windows, CAST(0 AS BIGINT) AS window_issues,
           CASE WHEN cut + invalid + empty_windows = 0 THEN 'PASS' ELSE 'REVIEW_REQUIRED' END AS status
    FROM n JOIN w USING (song_id)""")
def note_window_counts(t: Tables):
    return windows.song_audit(t.notes(), t.windows(), hot=t.hot_songs)


@query("""SELECT song_id, clip_id, 'OVERLAPPING_SCORE_WINDOWS' AS type, p AS previous_clip_id FROM (
    SELECT song_id, clip_id, start_us, lag(end_us) OVER w AS pe, lag(clip_id) OVER w AS p
    FROM (SELECT song_id, start_us, end_us, CAST(note_index AS VARCHAR) AS clip_id FROM notes WHERE end_us > start_us)
    WINDOW w AS (PARTITION BY song_id ORDER BY start_us, end_us, clip_id)) WHERE start_us < pe
    UNION ALL SELECT song_id, CAST(note_index AS VARCHAR), 'INVALID_SCORE_WINDOW', NULL FROM notes WHERE end_us <= start_us""")
def window_overlap_audit(t: Tables):
    rows = t.notes().select("song_id", F.col("note_index").cast("string").alias("clip_id"), "start_us", "end_us")
    bad = windows.audit_windows(rows.where("end_us <= start_us"), hot=t.hot_songs)
    return windows.audit_windows(rows.where("end_us > start_us"), hot=t.hot_songs).unionByName(bad.where("type = 'INVALID_SCORE_WINDOW'"))


@query("""SELECT song_id, note_index AS boundary_index, left_end AS gap_start, start_us AS gap_end, start_us - left_end AS gap_len,
        left_pitch, pitch AS right_pitch FROM (
    SELECT *, lag(end_us) OVER w AS left_end, lag(pitch) OVER w AS left_pitch FROM notes
    WINDOW w AS (PARTITION BY song_id ORDER BY start_us, note_index)) WHERE start_us - left_end >= 500000""")
def adjacent_gaps(t: Tables):
    return iv.adjacent_gaps(t.notes(), SONG, ORDER, 500_000, carry=["pitch"], hot=t.hot_songs)


@query("""SELECT song_id, note_index, left_end - start_us AS overlap_len FROM (
    SELECT *, lag(end_us) OVER (PARTITION BY song_id ORDER BY start_us, note_index) AS left_end FROM notes)
    WHERE start_us < left_end""")
def adjacent_overlaps(t: Tables):
    return iv.adjacent_overlaps(t.notes(), SONG, ORDER, hot=t.hot_songs)


@query("""SELECT song_id, note_index, start_us, max_end_before FROM (
    SELECT *, max(end_us) OVER (PARTITION BY song_id ORDER BY start_us, note_index ROWS BETWEEN UNBOUNDED PRECEDING
              AND 1 PRECEDING) AS max_end_before FROM notes) WHERE start_us < max_end_before""")
def running_max_violations(t: Tables):
    return iv.running_max_violations(t.notes(), SONG, ORDER, hot=t.hot_songs)


@query("SELECT song_id, start_us, end_us FROM u_notes")
def interval_union(t: Tables):
    return iv.union(t.notes(), SONG, hot=t.hot_songs)


# Difference of two disjoint sets: every piece starts at a base start or a cut end and
# runs to the nearest cut start or base end.
SUBTRACT = """
    SELECT b.song_id, p.at AS start_us, min(CASE WHEN c.start_us >= p.at THEN least(c.start_us, b.end_us) ELSE b.end_us END) AS end_us
    FROM {base} b
    JOIN (SELECT song_id, start_us AS at FROM {base} UNION SELECT song_id, end_us FROM {cuts}) p
      ON p.song_id = b.song_id AND p.at >= b.start_us AND p.at < b.end_us
    LEFT JOIN {cuts} c ON c.song_id = b.song_id AND c.end_us > b.start_us AND c.start_us < b.end_us
    WHERE NOT EXISTS (SELECT 1 FROM {cuts} x WHERE x.song_id = b.song_id AND x.start_us <= p.at AND x.end_us > p.at)
    GROUP BY b.song_id, b.start_us, p.at"""


@query(SUBTRACT.format(base="u_windows", cuts="u_exclusions"))
def interval_subtract(t: Tables):
    return iv.subtract(t.windows(), t.exclusions(), SONG, hot=t.hot_songs)


@query("WITH whole AS (SELECT song_id, CAST(0 AS BIGINT) AS start_us, max(end_us) + 1000000 AS end_us FROM notes GROUP BY song_id),"
       f" pieces AS ({SUBTRACT.format(base='whole', cuts='u_notes')}) SELECT song_id, start_us, end_us FROM pieces")
def uncovered(t: Tables):
    extents = t.notes().groupBy("song_id").agg((F.max("end_us") + 1_000_000).alias("extent"))
    return iv.uncovered(t.notes(), extents, SONG, hot=t.hot_songs)


@query(f"""WITH expected AS ({SUBTRACT.format(base='u_windows', cuts='u_exclusions')}),
    e AS (SELECT song_id, row_number() OVER (PARTITION BY song_id ORDER BY start_us) AS piece, start_us AS expected_start, end_us AS expected_end FROM expected),
    o AS (SELECT song_id, row_number() OVER (PARTITION BY song_id ORDER BY start_us) AS piece, start_us AS observed_start, end_us AS observed_end FROM u_notes)
    SELECT song_id, piece, expected_start, expected_end, observed_start, observed_end,
           CASE WHEN expected_start IS NULL THEN 'UNEXPECTED' WHEN observed_start IS NULL THEN 'MISSING'
                WHEN expected_start = observed_start AND expected_end = observed_end THEN 'EQUAL' ELSE 'DIFFERENT' END AS state
    FROM e FULL JOIN o USING (song_id, piece)""")
def coverage_contract(t: Tables):
    return windows.coverage_contract(t.windows(), t.exclusions(), t.notes(), hot=t.hot_songs)


GAPS = """gaps AS (SELECT song_id, note_index AS boundary_index, left_end AS start_us, start_us AS end_us FROM (
    SELECT *, lag(end_us) OVER (PARTITION BY song_id ORDER BY start_us, note_index) AS left_end FROM notes)
    WHERE start_us - left_end >= 500000),
    placed AS (SELECT *, EXISTS (SELECT 1 FROM windows w WHERE w.song_id = g.song_id AND g.end_us > w.start_us
                                 AND g.start_us < w.end_us) AS active FROM gaps g)"""


def _gaps(t: Tables):
    gaps = iv.adjacent_gaps(t.notes(), SONG, ORDER, 500_000, hot=t.hot_songs)
    gaps = gaps.select("song_id", "boundary_index", F.col("gap_start").alias("start_us"), F.col("gap_end").alias("end_us"))
    return iv.overlapping_any(gaps, iv.union(t.windows(), SONG, hot=t.hot_songs), SONG, hot=t.hot_songs)


@query(f"WITH {GAPS} SELECT song_id, boundary_index, start_us, end_us FROM placed WHERE active")
def active_gaps(t: Tables):
    return _gaps(t).where("overlaps").drop("overlaps")


@query(f"WITH {GAPS} SELECT song_id, boundary_index, start_us, end_us, 'GAP_OUTSIDE_ACCEPTED_WINDOWS' AS reason FROM placed WHERE NOT active")
def excluded_gaps(t: Tables):
    return _gaps(t).where("not overlaps").drop("overlaps").withColumn("reason", F.lit("GAP_OUTSIDE_ACCEPTED_WINDOWS"))


@query("""SELECT song_id, note_index, track, pitch, start_us, end_us FROM notes n WHERE EXISTS (
    SELECT 1 FROM u_windows w WHERE w.song_id = n.song_id AND n.start_us >= w.start_us AND n.end_us <= w.end_us)""")
def contained_notes(t: Tables):
    accepted = iv.union(t.windows(), SONG, hot=t.hot_songs)
    return iv.contained_any(t.notes(), accepted, SONG, hot=t.hot_songs).where("contained").drop("contained")


SPLIT = 15 * MINUTE_US


@query(f"""WITH spans AS (SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY start_us) - 1 AS span_index FROM windows),
    pairs AS (SELECT n.song_id, n.note_index, s.span_index, greatest(n.start_us, s.start_us) AS seg_start, least(n.end_us, s.end_us) AS seg_end,
              n.start_us, n.end_us FROM notes n JOIN spans s ON n.song_id = s.song_id AND n.end_us > s.start_us AND n.start_us < s.end_us),
    ranked AS (SELECT *, count(*) OVER w AS spans, min(seg_end - seg_start) OVER w AS smallest,
               row_number() OVER (PARTITION BY song_id, note_index ORDER BY seg_end - seg_start DESC, span_index) AS rn
               FROM pairs WINDOW w AS (PARTITION BY song_id, note_index))
    SELECT song_id, note_index, span_index, seg_start, seg_end, (seg_start <> start_us OR seg_end <> end_us) AS split
    FROM ranked WHERE NOT (spans > 1 AND smallest < {SPLIT}) OR rn = 1""")
def note_span_split(t: Tables):
    spans = scan(t.windows(), SONG, ["start_us", "clip_id"], [running_sum("n", F.lit(1).cast("bigint"))], t.hot_songs)
    spans = spans.select("song_id", (F.col("n") - 1).alias("span_index"), F.col("start_us").alias("span_start"), F.col("end_us").alias("span_end"))
    notes = t.notes().select("song_id", "note_index", "start_us", "end_us")
    return windows.split_over_spans(notes, spans, BIN, SPLIT, t.hot_songs).drop("span_start", "span_end")


@query("""WITH cut AS (SELECT song_id, CAST(sum(end_us - start_us) AS BIGINT) AS pruned_us, count(*) AS pieces FROM u_exclusions GROUP BY song_id),
    total AS (SELECT song_id, CAST(sum(end_us - start_us) AS BIGINT) AS total_us FROM windows GROUP BY song_id),
    s AS (SELECT song_id, coalesce(total_us, 0) AS total_us, coalesce(pruned_us, 0) AS pruned_us, coalesce(pieces, 0) AS pieces FROM total FULL JOIN cut USING (song_id)),
    w AS (SELECT CAST(sum(pruned_us) AS BIGINT) AS set_pruned_us, CAST(sum(total_us) AS BIGINT) AS set_total_us FROM s)
    SELECT s.*, w.*, CASE WHEN set_pruned_us * 100 <= set_total_us * 5 THEN 'WITHIN_BUDGET' ELSE 'BLOCKED_PRUNE_BUDGET' END AS status,
           round(set_pruned_us / set_total_us, 6) AS prune_ratio FROM s, w""")
def prune_budget(t: Tables):
    return windows.prune_budget(t.exclusions(), t.windows(), 5, hot=t.hot_songs)


@query(f"""SELECT song_id, chunk_index, count(*) AS note_count, min(start_us) AS start_us, max(end_us) AS end_us FROM (
    SELECT *, CAST(sum(fresh) OVER (PARTITION BY song_id ORDER BY start_us, note_index ROWS UNBOUNDED PRECEDING) AS BIGINT) AS chunk_index FROM (
        SELECT *, CASE WHEN start_us - lag(end_us) OVER (PARTITION BY song_id ORDER BY start_us, note_index) >= {30 * MINUTE_US}
                  THEN 1 ELSE 0 END AS fresh FROM mono_notes)) GROUP BY song_id, chunk_index""")
def phrase_chunks(t: Tables):
    return windows.phrase_chunks(t.mono_notes(), 30 * MINUTE_US, hot=t.hot_songs)


PIECES = f"""
    parts AS MATERIALIZED (SELECT w.song_id, w.clip_id, w.start_us AS ws, w.end_us AS we, q.start_us, q.end_us FROM windows w
        JOIN (SELECT b.song_id, b.clip_id, p.at AS start_us,
                     min(CASE WHEN c.start_us >= p.at THEN least(c.start_us, b.end_us) ELSE b.end_us END) AS end_us
              FROM windows b
              JOIN (SELECT song_id, clip_id, start_us AS at FROM windows UNION
                    SELECT w.song_id, w.clip_id, x.end_us FROM windows w JOIN u_exclusions x ON x.song_id = w.song_id
                           AND x.end_us >= w.start_us AND x.end_us < w.end_us) p
                ON p.song_id = b.song_id AND p.clip_id = b.clip_id
              LEFT JOIN u_exclusions c ON c.song_id = b.song_id AND c.end_us > b.start_us AND c.start_us < b.end_us
              WHERE NOT EXISTS (SELECT 1 FROM u_exclusions x WHERE x.song_id = b.song_id AND x.start_us <= p.at AND x.end_us > p.at)
              GROUP BY b.song_id, b.clip_id, b.start_us, p.at) q ON q.song_id = w.song_id AND q.clip_id = w.clip_id),
    restored AS (SELECT song_id, clip_id, ws AS start_us, we AS end_us FROM parts GROUP BY song_id, clip_id, ws, we
        HAVING min(end_us - start_us) < {30 * MINUTE_US} AND sum(end_us - start_us) < we - ws),
    pieces AS MATERIALIZED (SELECT song_id, clip_id, start_us, end_us FROM parts WHERE (song_id, clip_id) NOT IN (SELECT (song_id, clip_id) FROM restored)
        UNION ALL SELECT song_id, clip_id, start_us, end_us FROM restored)"""


@query(f"WITH {PIECES} SELECT song_id, clip_id, start_us, end_us FROM pieces")
def window_pieces(t: Tables):
    return windows.plan_pieces(t.windows(), t.exclusions(), 30 * MINUTE_US, hot=t.hot_songs)[0]


@query(f"""WITH {PIECES} SELECT r.song_id, r.clip_id, greatest(r.start_us, x.start_us) AS start_us, least(r.end_us, x.end_us) AS end_us
    FROM restored r JOIN u_exclusions x ON x.song_id = r.song_id AND x.end_us > r.start_us AND x.start_us < r.end_us""")
def restored_pauses(t: Tables):
    return windows.plan_pieces(t.windows(), t.exclusions(), 30 * MINUTE_US, hot=t.hot_songs)[1]


@query(f"""WITH {PIECES},
    inside AS MATERIALIZED (SELECT n.song_id, p.clip_id, p.start_us AS piece_start, p.end_us AS piece_end, 'note' AS kind, n.note_index, n.pitch, n.start_us, n.end_us
        FROM mono_notes n JOIN pieces p ON p.song_id = n.song_id AND n.start_us >= p.start_us AND n.end_us <= p.end_us WHERE n.end_us > n.start_us),
    edge AS (SELECT song_id, clip_id, piece_start, start_us, end_us FROM inside
        UNION ALL SELECT song_id, clip_id, start_us, start_us, start_us FROM pieces
        UNION ALL SELECT song_id, clip_id, start_us, end_us, end_us FROM pieces),
    rests AS (SELECT song_id, clip_id, piece_start, max_end AS start_us, start_us AS end_us FROM (
        SELECT *, max(end_us) OVER (PARTITION BY song_id, clip_id, piece_start ORDER BY start_us, end_us
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS max_end FROM edge) WHERE start_us > max_end),
    both_kinds AS (SELECT song_id, clip_id, piece_start, kind, note_index, pitch, start_us, end_us FROM inside
        UNION ALL SELECT song_id, clip_id, piece_start, 'rest', NULL, NULL, start_us, end_us FROM rests
          WHERE (song_id, clip_id, piece_start) IN (SELECT (song_id, clip_id, piece_start) FROM inside))
    SELECT *, row_number() OVER (PARTITION BY song_id, clip_id, piece_start ORDER BY start_us, end_us) AS element FROM both_kinds""")
def rest_insertion(t: Tables):
    pieces = windows.plan_pieces(t.windows(), t.exclusions(), 30 * MINUTE_US, hot=t.hot_songs)[0]
    notes = t.mono_notes().where("end_us > start_us").select("song_id", "note_index", "pitch", "start_us", "end_us")
    return windows.window_elements(pieces, notes, hot=t.hot_songs)


@query("""WITH s AS (SELECT song_id, event_id, start_us, coalesce(last_value(tempo IGNORE NULLS) OVER (PARTITION BY song_id
        ORDER BY start_us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 500) AS tempo_before,
        start_us - coalesce(lag(start_us) OVER (PARTITION BY song_id ORDER BY start_us, event_id), start_us) AS step
    FROM (SELECT *, CASE WHEN event_type = 'signup' THEN CAST(round(value * 100) AS BIGINT) END AS tempo FROM ev))
    SELECT song_id, event_id, start_us, tempo_before, CAST(sum(step * tempo_before) OVER (PARTITION BY song_id
           ORDER BY start_us, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS clock FROM s""")
def tempo_asof(t: Tables):
    tempo = F.when(F.col("event_type") == "signup", F.round(F.col("value") * 100).cast("bigint"))
    events = t.timed_events().select("song_id", "event_id", "start_us", tempo.alias("tempo"))
    return pairing.tempo_clock(events, SONG, "start_us", ["start_us", "event_id"], "tempo", 500, t.hot_songs).drop("tempo")


PAIRING = """
    walked AS (SELECT *, sum(CASE kind WHEN 'on' THEN 1 ELSE -1 END) OVER w AS level FROM on_off
        WINDOW w AS (PARTITION BY track, pitch ORDER BY start_us, CASE kind WHEN 'off' THEN 0 ELSE 1 END, event_id ROWS UNBOUNDED PRECEDING)),
    marked AS (SELECT *, kind = 'off' AND level < least(0, coalesce(min(level) OVER (PARTITION BY track, pitch
        ORDER BY start_us, CASE kind WHEN 'off' THEN 0 ELSE 1 END, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lost FROM walked),
    ons AS (SELECT track, pitch, start_us AS on_at, event_id AS on_event, row_number() OVER (PARTITION BY track, pitch ORDER BY start_us, event_id) AS pair
        FROM marked WHERE kind = 'on'),
    offs AS (SELECT track, pitch, start_us AS off_at, event_id AS off_event, row_number() OVER (PARTITION BY track, pitch ORDER BY start_us, event_id) AS pair
        FROM marked WHERE kind = 'off' AND NOT lost)"""


def _paired(t: Tables):
    return pairing.pair_events(t.on_off(), "track", "pitch", "start_us", "event_id", t.hot("events", "user_id", "track"))


@query(f"WITH {PAIRING} SELECT track, pitch, pair, on_at, on_event, off_at, off_event FROM ons JOIN offs USING (track, pitch, pair)")
def on_off_pairing(t: Tables):
    return _paired(t)[0]


@query(f"""WITH {PAIRING} SELECT track, pitch, 'NOTE_OFF_WITHOUT_ON' AS type, event_id AS event FROM marked WHERE lost
    UNION ALL SELECT o.track, o.pitch, 'UNRELEASED_NOTE', o.on_event FROM ons o ANTI JOIN offs f USING (track, pitch, pair)""")
def unpaired_events(t: Tables):
    _, unmatched, unreleased, _ = _paired(t)
    lost = unmatched.select("track", "pitch", F.lit("NOTE_OFF_WITHOUT_ON").alias("type"), F.col("off_event").alias("event"))
    return lost.unionByName(unreleased.select("track", "pitch", F.lit("UNRELEASED_NOTE").alias("type"), F.col("on_event").alias("event")))


@query(f"""WITH {PAIRING} SELECT track, pitch, on_at, on_event, sounding_before FROM (
    SELECT track, pitch, kind, start_us AS on_at, event_id AS on_event,
           CAST(sum(CASE WHEN kind = 'on' THEN 1 WHEN lost THEN 0 ELSE -1 END) OVER (PARTITION BY track ORDER BY start_us,
           CASE kind WHEN 'off' THEN 0 ELSE 1 END, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT) AS sounding_before FROM marked)
    WHERE kind = 'on' AND sounding_before > 0""")
def polyphony(t: Tables):
    return _paired(t)[3]
