"""Sequential rules. Packing and merging have a recursive SQL form; the others are checked
against a direct simulation in the tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..operators import folds, windows
from ..operators import intervals as iv
from ..operators.scans import find_hot_keys, row_number, scan
from .registry import query
from .timeline_queries import BIN, MINUTE_US
from .views import SONG, Tables

HOUR = 60 * MINUTE_US

STEPS = """it AS (SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY note_index) AS rn FROM mono_notes WHERE end_us > start_us)"""


@query(f"""WITH RECURSIVE {STEPS},
    st AS (SELECT song_id, rn, start_us AS ws, end_us AS we, note_index AS fi, note_index AS li, CAST(1 AS BIGINT) AS n, CAST(0 AS BIGINT) AS closed,
             CAST(NULL AS BIGINT) AS os, CAST(NULL AS BIGINT) AS oe, CAST(NULL AS BIGINT) AS ofi, CAST(NULL AS BIGINT) AS oli, CAST(NULL AS BIGINT) AS onn FROM it WHERE rn = 1
      UNION ALL SELECT s.song_id, i.rn, CASE WHEN f THEN i.start_us ELSE ws END, CASE WHEN f THEN i.end_us ELSE greatest(we, i.end_us) END, CASE WHEN f THEN i.note_index ELSE fi END, i.note_index,
             CASE WHEN f THEN 1 ELSE n + 1 END, closed + CASE WHEN f THEN 1 ELSE 0 END, CASE WHEN f THEN ws END, CASE WHEN f THEN we END, CASE WHEN f THEN fi END, CASE WHEN f THEN li END, CASE WHEN f THEN n END
      FROM (SELECT s.*, (i.start_us - s.we >= {HOUR // 2} AND s.we - s.ws >= {HOUR}) OR i.end_us - s.ws > {12 * HOUR} AS f FROM st s JOIN it i ON i.song_id = s.song_id AND i.rn = s.rn + 1) s
      JOIN it i ON i.song_id = s.song_id AND i.rn = s.rn + 1),
    out_ AS (SELECT song_id, closed AS window_index, os AS s, oe AS e, ofi AS f, oli AS l, onn AS n FROM st WHERE os IS NOT NULL
      UNION ALL SELECT song_id, closed + 1, ws, we, fi, li, n FROM (SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY rn DESC) AS z FROM st) WHERE z = 1)
    SELECT song_id, window_index, s AS "start", e AS "end", f AS first_item, l AS last_item, n AS items,
      CASE WHEN e - s > {15 * HOUR} THEN 'ALIGNMENT_WINDOW_TOO_LONG' WHEN e - s < {HOUR} AND n > 1 THEN 'ALIGNMENT_DENSE_SHORT_WINDOW' END AS issue FROM out_""")
def window_packing(t: Tables):
    items = t.mono_notes().select("song_id", F.col("note_index").alias("item"), F.col("start_us").alias("start"), F.col("end_us").alias("end"))
    return folds.pack_windows(items, SONG, HOUR // 2, HOUR, 12 * HOUR, 15 * HOUR, t.hot_songs)


@query(f"""SELECT song_id, note_index AS item, CASE WHEN e <= start_us THEN 'ALIGNMENT_ITEM_DURATION_INVALID' ELSE 'ALIGNMENT_ITEM_TOO_LONG' END AS issue, e - start_us AS duration
    FROM (SELECT *, CASE WHEN pitch % 7 = 3 THEN start_us ELSE end_us END AS e FROM mono_notes) WHERE e <= start_us OR e - start_us > {2 * HOUR}""")
def window_item_issues(t: Tables):
    """Packing's item issues; notes of some pitches are taken as having no length, so that both rules fire."""
    end = F.when(F.col("pitch") % 7 == 3, F.col("start_us")).otherwise(F.col("end_us"))
    items = t.mono_notes().select("song_id", F.col("note_index").alias("item"), F.col("start_us").alias("start"), end.alias("end"))
    return folds.item_issues(items, SONG, 2 * HOUR)


@query(f"""WITH RECURSIVE {STEPS},
    b AS (SELECT song_id, rn, note_index, start_us, end_us - start_us AS d, pitch % 20 AS p FROM it),
    st AS (SELECT song_id, rn, note_index AS fi, start_us AS s, d, p, note_index AS li, CAST(1 AS BIGINT) AS n, false AS nw, CAST(NULL AS BIGINT) AS ofi, CAST(NULL AS BIGINT) AS os, CAST(NULL AS BIGINT) AS od, CAST(NULL AS BIGINT) AS op,
             CAST(NULL AS BIGINT) AS oli, CAST(NULL AS BIGINT) AS onn FROM b WHERE rn = 1
      UNION ALL SELECT x.song_id, rn2, CASE WHEN m THEN fi ELSE i2 END, CASE WHEN m THEN s ELSE s2 END, CASE WHEN m THEN d + d2 ELSE d2 END, CASE WHEN m THEN p + p2 ELSE p2 END, i2, CASE WHEN m THEN n + 1 ELSE 1 END, NOT m,
             CASE WHEN NOT m THEN fi END, CASE WHEN NOT m THEN s END, CASE WHEN NOT m THEN d END, CASE WHEN NOT m THEN p END, CASE WHEN NOT m THEN li END, CASE WHEN NOT m THEN n END
      FROM (SELECT t.*, b.rn AS rn2, b.note_index AS i2, b.start_us AS s2, b.d AS d2, b.p AS p2, b.start_us = t.s + t.d AND ((t.d < {2 * HOUR} AND t.p > 8) OR (b.d < {2 * HOUR} AND b.p > 8)) AS m
            FROM st t JOIN b ON b.song_id = t.song_id AND b.rn = t.rn + 1) x)
    SELECT song_id, ofi AS first_item, os AS "start", od AS duration, op AS phones, oli AS last_item, onn AS members FROM st WHERE nw
    UNION ALL SELECT song_id, fi, s, d, p, li, n FROM (SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY rn DESC) AS z FROM st) WHERE z = 1""")
def dense_merge(t: Tables):
    items = t.mono_notes().where("end_us > start_us").select(
        "song_id", F.col("note_index").alias("item"), F.col("start_us").alias("start"), (F.col("end_us") - F.col("start_us")).alias("duration"), (F.col("pitch") % 20).alias("phones")
    )
    return folds.merge_dense(items, SONG, 0, 2 * HOUR, 8, t.hot_songs)


@query(None)
def boundary_repair(t: Tables):
    """Decisions of the boundary repair over all notes and windows."""
    return folds.repair_windows(t.mono_notes(), t.windows(), BIN, "majority", hot=t.hot_songs)[1]


@query(None)
def boundary_repair_audit(t: Tables):
    """Note status against the repaired windows."""
    repaired, _ = folds.repair_windows(t.mono_notes(), t.windows(), BIN, "majority", hot=t.hot_songs)
    return windows.audit_notes(t.mono_notes(), repaired, hot=t.hot_songs).groupBy("song_id", "status").count()


@query(None)
def activity_segments(t: Tables):
    values = t.frame_values().select("song_id", "frame", "idx", "x")
    hot = find_hot_keys(values, SONG)
    placed = scan(values, SONG, ["frame", "idx"], [row_number("n")], hot)
    quiet = F.when(F.expr("(n div 200) % 3 = 1"), 1e-5).otherwise(1.0)
    frames = placed.select("song_id", (F.col("n") - 1).alias("pos"), (F.abs("x") * quiet).alias("rms"))
    return folds.activity_segments(frames, SONG, hot=hot)


# Ends of phrases one after another: own end, all the phrase can hold, or the next rest that leaves room.
REALIGN = """p AS (SELECT song AS song_id, id AS phrase, blanks % 5 + 1 AS n, blanks % 9 + 3 AS ph FROM captions),
    q AS MATERIALIZED (SELECT *, row_number() OVER w AS rn, CAST(sum(n) OVER w AS BIGINT) AS t, CAST(sum(n) OVER w - coalesce(sum(greatest(ph - n, 0)) OVER (PARTITION BY song_id ORDER BY phrase ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS BIGINT) AS low
      FROM p WINDOW w AS (PARTITION BY song_id ORDER BY phrase)),
    g AS MATERIALIZED (SELECT song_id, note_index AS g FROM (SELECT *, lag(end_us) OVER (PARTITION BY song_id ORDER BY note_index) AS le FROM notes) WHERE start_us - le >= 500000),
    gl AS MATERIALIZED (SELECT q.song_id, rn, list(g ORDER BY g) AS gs FROM q JOIN g ON g.song_id = q.song_id AND g.g >= low AND g.g <= t GROUP BY ALL),
    qq AS MATERIALIZED (SELECT q.*, gs FROM q LEFT JOIN gl USING (song_id, rn)),
    e AS (SELECT song_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS phrase, CAST(0 AS BIGINT) AS b, CAST(0 AS BIGINT) AS c, CAST(0 AS BIGINT) AS e FROM qq WHERE rn = 1
      UNION ALL SELECT song_id, rn, phrase, b, c, coalesce(list_min(list_filter(gs, lambda x: x > b AND x < c)), c)
      FROM (SELECT k.song_id, k.rn, k.phrase, k.gs, e.e AS b, least(k.t, e.e + greatest(k.n, k.ph)) AS c FROM e JOIN qq k ON k.song_id = e.song_id AND k.rn = e.rn + 1)),
    held AS (SELECT g.song_id, g, max(rn) AS hold FROM g JOIN q ON q.song_id = g.song_id AND t - n <= g GROUP BY ALL),
    met AS (SELECT h.song_id, g, hold, (SELECT min(e.rn) FROM e WHERE e.song_id = h.song_id AND e.rn > 0 AND e.e >= g) AS rn FROM held h),
    gaps_ AS (SELECT m.song_id, CASE WHEN g = h.b THEN h.phrase ELSE e.phrase END AS phrase, CASE WHEN g = h.b OR g = e.c THEN 'ALREADY_ALIGNED' WHEN g < q.low THEN 'FAILED' ELSE 'REALIGNED' END AS kind, g AS boundary_index,
        CASE WHEN g = h.b OR g = e.c THEN 0 WHEN g < q.low THEN q.low - g ELSE e.c - g END AS value
      FROM met m JOIN e h ON h.song_id = m.song_id AND h.rn = hold LEFT JOIN e ON e.song_id = m.song_id AND e.rn = m.rn LEFT JOIN q ON q.song_id = m.song_id AND q.rn = m.rn WHERE m.rn IS NOT NULL OR g = h.b)"""


def _realigned(t: Tables):
    phrases = t.captions().select(
        F.col("song").alias("song_id"), F.col("id").alias("phrase"), (F.col("blanks") % 5 + 1).alias("count"), (F.col("blanks") % 9 + 3).alias("phones")
    )
    gaps = iv.adjacent_gaps(t.notes(), SONG, ["note_index"], 500_000, hot=t.hot_songs)
    hot = t.hot("conversations", "conv_id", "song_id")
    return phrases, folds.realign_counts(phrases, gaps.select("song_id", "boundary_index"), hot), hot


@query(f"""WITH RECURSIVE {REALIGN}
    SELECT song_id, phrase, 'COUNT' AS kind, NULL AS boundary_index, e - b AS value FROM e WHERE rn > 0
    UNION ALL SELECT song_id, phrase, kind, boundary_index, value FROM gaps_""")
def realign_counts(t: Tables):
    return _realigned(t)[1]


@query(f"""WITH RECURSIVE {REALIGN},
    l AS (SELECT song_id, boundary_index, value AS n, sum(value) OVER (PARTITION BY song_id ORDER BY boundary_index) AS upto FROM gaps_ WHERE kind = 'REALIGNED'),
    r AS (SELECT *, sum(n) OVER (PARTITION BY song_id ORDER BY phrase) AS upto FROM (SELECT e.song_id, e.phrase, e.c - e.b - q.n AS n FROM e JOIN q USING (song_id, rn)) WHERE n > 0)
    SELECT l.song_id, boundary_index, phrase, CAST(least(l.upto, r.upto) - greatest(l.upto - l.n, r.upto - r.n) AS BIGINT) AS taken
    FROM l JOIN r ON r.song_id = l.song_id AND l.upto > r.upto - r.n AND r.upto > l.upto - l.n""")
def realign_recipients(t: Tables):
    phrases, moved, hot = _realigned(t)
    return folds.realign_recipients(phrases, moved, hot)


@query("""WITH l AS (SELECT conv_id, turn, list_filter(string_split_regex(trim(lower(text)), '\\s+'), lambda x: x <> '') AS w FROM conversations)
    SELECT conv_id, turn, len(w) - len(list_filter(w, lambda x: x IN ('le', 'and'))) AS kept FROM l""")
def label_filter(t: Tables):
    words = fn.tokens(F.lower("text"))
    kept = folds.filter_labels(words, F.filter(words, lambda x: ~x.isin("le", "and")), ["le", "and"])
    return t.read("conversations").select("conv_id", "turn", F.size(kept).cast("bigint").alias("kept"))
