"""Item contracts, phrase timing, pronunciation and evidence-driven repair queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..operators import consensus as cs
from ..operators import evidence as ev
from ..operators import intervals as iv
from ..operators import manifest as mf
from ..operators import sequences as sq
from ..operators import windows
from ..operators.scans import running_sum, scan
from .registry import QUERIES, query
from .timeline_queries import BIN, MINUTE_US, SPLIT
from .views import SONG, Tables

ITEM = "ORDER BY line, part, supp, cents"


@query(f"""SELECT *, nullif(concat_ws(',', CASE WHEN first_slur <> 0 THEN 'NOTE_SLUR_FIRST_INVALID' END, CASE WHEN bad_notes > 0 THEN 'NON_POSITIVE_NOTE_DURATION' END,
      CASE WHEN bad_phones > 0 THEN 'NON_POSITIVE_PH_DURATION' END, CASE WHEN note_total <> ph_total THEN 'DURATION_TOTAL_MISMATCH' END), '') AS issues
    FROM (SELECT item_id, count(*) AS note_count, CAST(sum(note_dur) AS BIGINT) AS note_total, CAST(sum(ph_dur) AS BIGINT) AS ph_total,
      CAST(first(note_slur {ITEM}) AS BIGINT) AS first_slur, CAST(sum(CASE WHEN note_slur = 0 THEN 1 ELSE 0 END) AS BIGINT) AS words,
      CAST(sum(CASE WHEN note_dur <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS bad_notes, CAST(sum(CASE WHEN ph_dur <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS bad_phones
      FROM item_elements GROUP BY item_id)""")
def sequence_contract(t: Tables):
    return sq.element_contract(t.item_elements(), "item_id", t.ITEM_ORDER)


@query(f"""SELECT item_id, line, part, supp, cents, CAST(coalesce(sum(note_dur) OVER w, 0) AS BIGINT) AS note_offset, CAST(coalesce(sum(ph_dur) OVER w, 0) AS BIGINT) AS ph_offset
    FROM item_elements WINDOW w AS (PARTITION BY item_id {ITEM} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def running_offsets(t: Tables):
    return sq.running_offsets(t.item_elements(), "item_id", t.ITEM_ORDER, t.hot_items).drop("note_dur", "ph_dur", "note_slur", "unit")


@query(f"""SELECT item_id, line, part, supp, cents, CASE WHEN NOT rest AND unit = lag(CASE WHEN NOT rest THEN unit END) OVER (PARTITION BY item_id {ITEM})
    THEN CAST(1 AS BIGINT) ELSE 0 END AS slur FROM (SELECT *, ph_dur = 0 AS rest FROM item_elements)""")
def slur_flags(t: Tables):
    rows = sq.slur_flags(t.item_elements(), "item_id", t.ITEM_ORDER, "unit", F.col("ph_dur") == 0, t.hot_items)
    return rows.select("item_id", *t.ITEM_ORDER, "slur")


@query("""SELECT frame, c, CAST(list_sum(CAST(list_slice(s, f + 1, f + n) AS DOUBLE[])) AS DOUBLE) AS total, n AS size FROM (
    SELECT frame, samples AS s, c, frame % 7 + 1 + c AS n, CASE c WHEN 0 THEN 0 WHEN 1 THEN frame % 7 + 1 ELSE 2 * (frame % 7) + 3 END AS f
    FROM frames, (VALUES (0), (1), (2)) AS v(c))""")
def array_slices(t: Tables):
    base = F.col("frame") % 7 + 1
    cuts = F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda c: F.struct(c.cast("bigint").alias("c"), (base + c).alias("size")))
    upto = F.transform(cuts, lambda x, i: F.aggregate(F.slice(cuts, 1, i), F.lit(0).cast("bigint"), lambda a, y: a + y["size"]))
    parts = F.explode(F.zip_with(cuts, upto, lambda x, before: F.struct(x["c"].alias("c"), x["size"].alias("size"), F.slice("samples", (before + 1).cast("int"), x["size"].cast("int")).alias("part"))))
    rows = t.frames().select("frame", parts.alias("p"))
    total = F.aggregate(F.transform("p.part", lambda v: v.cast("double")), F.lit(0.0), lambda a, v: a + v)
    return rows.select("frame", F.col("p.c").alias("c"), F.round(total, 6).alias("total"), F.col("p.size").alias("size"))


CLAIMS = """cl AS (SELECT song AS song_id, id AS phrase, blanks % 40 AS n, CAST(sum(blanks % 40) OVER (PARTITION BY song ORDER BY id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS t FROM captions)"""


@query(f"""WITH {CLAIMS}, sz AS (SELECT song_id, count(*) AS size FROM notes GROUP BY song_id)
    SELECT song_id, phrase, NULL AS note_index, 'TIMING_SOURCE_NOTE_INDEX_MISSING' AS type FROM cl WHERE n = 0
    UNION ALL SELECT c.song_id, phrase, i, 'TIMING_SOURCE_NOTE_INDEX_INVALID' FROM (SELECT *, unnest(generate_series(t - n, t - 1)) AS i FROM cl WHERE n > 0) c LEFT JOIN sz ON sz.song_id = c.song_id WHERE i >= coalesce(size, 0)""")
def timing_index_issues(t: Tables):
    """Captions claim consecutive notes, one per blank; later ones run past the notes of their song."""
    phrases = t.captions().select(F.col("song").alias("song_id"), F.col("id").alias("phrase"), (F.col("blanks") % 40).alias("n"))
    cut = mf.slices(phrases, SONG, ["phrase"], "n", t.hot("conversations", "conv_id", "song_id"))
    claims = cut.where("n > 0").select("song_id", "phrase", F.explode(F.sequence("slice_from", F.col("slice_to") - 1)).alias("note_index"))
    return sq.index_issues(phrases, claims, t.notes())


# -- phrase timing ------------------------------------------------------------------

ASSIGN = """phr AS (SELECT song AS song_id, id AS phrase, blanks % 5 + 1 AS note_count FROM captions),
    sl AS (SELECT *, CAST(sum(note_count) OVER (PARTITION BY song_id ORDER BY phrase ROWS UNBOUNDED PRECEDING) AS BIGINT) AS slice_to FROM phr),
    a AS (SELECT n.*, s.phrase FROM notes n JOIN sl s ON s.song_id = n.song_id AND n.note_index >= slice_to - note_count AND n.note_index < slice_to),
    lagged AS (SELECT *, start_us - lag(end_us) OVER (PARTITION BY song_id, phrase ORDER BY note_index) AS gap FROM a),
    tm AS (SELECT song_id, phrase, count(*) AS note_count, CAST(sum(end_us - start_us) AS BIGINT) AS note_total, min(start_us) AS score_start, max(end_us) AS score_end,
      CAST(sum(CASE WHEN gap > 0 THEN 1 ELSE 0 END) AS BIGINT) AS gaps, CAST(sum(CASE WHEN gap < 0 THEN 1 ELSE 0 END) AS BIGINT) AS "overlaps",
      coalesce(max(CASE WHEN gap > 0 THEN gap END), 0) AS max_gap, CAST(sum(end_us - start_us) + (phrase % 2) * 60000000 AS BIGINT) AS ph_total,
      max(end_us) - min(start_us) AS score_span FROM lagged GROUP BY song_id, phrase)"""


def _assigned(t: Tables):
    phrases = t.captions().select(F.col("song").alias("song_id"), F.col("id").alias("phrase"), (F.col("blanks") % 5 + 1).alias("note_count"))
    cut = mf.slices(phrases, SONG, ["phrase"], "note_count", t.hot("conversations", "conv_id", "song_id"))
    notes = t.notes().select("song_id", "note_index", "start_us", "end_us")
    found = iv.asof(notes, cut, SONG, "note_index", "slice_from", ["phrase", "slice_to"], hot=t.hot_songs)
    return found.where(F.col("note_index") < F.col("mark.slice_to")).select(*notes.columns, F.col("mark.phrase").alias("phrase"))


def _timing(t: Tables, assigned):
    phones = assigned.groupBy("song_id", "phrase").agg((F.sum(F.col("end_us") - F.col("start_us")) + F.max(F.col("phrase") % 2) * 60_000_000).alias("ph_total"))
    return sq.phrase_timing(assigned, phones, ["song_id", "phrase"], hot=t.hot_songs)


@query(f"""WITH {ASSIGN} SELECT *, CASE WHEN note_total > 0 THEN round(ph_total / note_total, 6) END AS total_ratio, CASE WHEN score_span > 0 THEN round(ph_total / score_span, 6) END AS span_ratio,
    (ph_total <> note_total OR ph_total <> score_span OR "overlaps" > 0) AS mismatch,
    CASE WHEN ph_total <> note_total OR ph_total <> score_span OR "overlaps" > 0 OR gaps > 0 THEN 'low' ELSE 'high' END AS confidence,
    CASE WHEN ph_total <> note_total OR ph_total <> score_span OR "overlaps" > 0 THEN 'REVIEW_REQUIRED' ELSE 'ALIGNED' END AS repair_status FROM tm""")
def phrase_timing_audit(t: Tables):
    return _timing(t, _assigned(t))


@query(f"""WITH {ASSIGN} SELECT song_id, note_index, 'TIMING_UNASSIGNED_SOURCE_NOTE' AS type FROM notes n ANTI JOIN a USING (song_id, note_index)""")
def note_index_usage(t: Tables):
    return sq.index_usage(_assigned(t), t.notes().select("song_id", "note_index"), SONG)


DRAFT = f"""{ASSIGN}, draft AS (SELECT a.song_id, a.note_index, a.start_us, a.end_us, a.phrase, ph_total AS target_span,
      score_start + CAST(round_even((a.start_us - score_start) * (CAST(ph_total AS DOUBLE) / CAST(score_span AS DOUBLE)), 0) AS BIGINT) AS proposed_start,
      score_start + CAST(round_even((a.end_us - score_start) * (CAST(ph_total AS DOUBLE) / CAST(score_span AS DOUBLE)), 0) AS BIGINT) AS proposed_end
      FROM a JOIN tm USING (song_id, phrase) WHERE score_span > 0 AND ph_total > 0)"""


def _draft(t: Tables):
    assigned = _assigned(t)
    return sq.rescale(assigned, _timing(t, assigned), ["song_id", "phrase"])


@query(f"WITH {DRAFT} SELECT *, proposed_end > proposed_start AS positive FROM draft")
def timing_rescale(t: Tables):
    return _draft(t)


@query(f"""WITH {DRAFT}, l AS (SELECT *, lag(proposed_end) OVER w AS pe, lag(note_index) OVER w AS pn, row_number() OVER w AS rn FROM draft
      WINDOW w AS (PARTITION BY song_id, phrase ORDER BY proposed_start, note_index)),
    s AS (SELECT song_id, phrase, CAST(sum(CASE WHEN proposed_end <= proposed_start THEN 1 ELSE 0 END) AS BIGINT) AS non_positive,
      CAST(sum(CASE WHEN note_index < pn THEN 1 ELSE 0 END) AS BIGINT) AS misordered, CAST(sum(CASE WHEN proposed_start < pe THEN 1 ELSE 0 END) AS BIGINT) AS overlapping,
      arg_max(proposed_end, rn) - min(proposed_start) AS span, max(target_span) AS target_span FROM l GROUP BY song_id, phrase)
    SELECT *, CASE WHEN non_positive + misordered + overlapping > 0 OR span <> target_span THEN 'BLOCKED' ELSE 'PASS' END AS status FROM s""")
def draft_audit(t: Tables):
    return sq.audit_draft(_draft(t), ["song_id", "phrase"], hot=t.hot_songs)


SEGMENTS = f"""spans AS (SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY start_us) - 1 AS span_index FROM windows),
    pairs AS (SELECT n.song_id, n.note_index, s.span_index, s.start_us AS span_start, s.end_us AS span_end, greatest(n.start_us, s.start_us) AS seg_start, least(n.end_us, s.end_us) AS seg_end
      FROM notes n JOIN spans s ON n.song_id = s.song_id AND n.end_us > s.start_us AND n.start_us < s.end_us),
    ranked AS (SELECT *, count(*) OVER w AS spans, min(seg_end - seg_start) OVER w AS smallest, row_number() OVER (PARTITION BY song_id, note_index ORDER BY seg_end - seg_start DESC, span_index) AS rn
      FROM pairs WINDOW w AS (PARTITION BY song_id, note_index)),
    seg AS (SELECT *, greatest(span_start, coalesce(max(seg_end) OVER (PARTITION BY song_id, span_index ORDER BY seg_start, seg_end, note_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), span_start)) AS cur
      FROM ranked WHERE NOT (spans > 1 AND smallest < {SPLIT}) OR rn = 1),
    trim_ AS (SELECT *, greatest(seg_start, cur) AS st, seg_start < cur AS trimmed FROM seg WHERE seg_end > greatest(seg_start, cur)),
    fl AS (SELECT *, lag(st) OVER w AS bef, lead(st) OVER w AS nxt FROM trim_ WINDOW w AS (PARTITION BY song_id, span_index ORDER BY seg_start, seg_end, note_index)),
    filled AS (SELECT song_id, span_index, span_start, span_end, note_index, CASE WHEN bef IS NULL AND st > span_start THEN span_start ELSE st END AS "start",
      CASE WHEN nxt > seg_end THEN nxt WHEN nxt IS NULL AND seg_end < span_end THEN span_end ELSE seg_end END AS "end",
      concat_ws(',', CASE WHEN trimmed THEN 'TRIMMED_OVERLAP' END, CASE WHEN bef IS NULL AND st > span_start THEN 'COLLAPSED_LEADING_GAP' END,
        CASE WHEN nxt > seg_end THEN 'COLLAPSED_INTERNAL_GAP' END, CASE WHEN nxt IS NULL AND seg_end < span_end THEN 'COLLAPSED_TRAILING_GAP' END) AS action FROM fl)"""


def _filled(t: Tables):
    spans = scan(t.windows(), SONG, ["start_us", "clip_id"], [running_sum("n", F.lit(1).cast("bigint"))], t.hot_songs)
    spans = spans.select("song_id", (F.col("n") - 1).alias("span_index"), F.col("start_us").alias("span_start"), F.col("end_us").alias("span_end"))
    cut = windows.split_over_spans(t.notes().select("song_id", "note_index", "start_us", "end_us"), spans, BIN, SPLIT, t.hot_songs)
    return sq.fill_spans(cut, t.hot_songs)


@query(f"WITH {SEGMENTS} SELECT * FROM filled")
def fill_span_gaps(t: Tables):
    return _filled(t)


@query(f"""WITH {SEGMENTS} SELECT song_id, span_index, max(span_start) AS span_start, max(span_end) AS span_end, count(*) AS notes, CAST(sum("end" - "start") AS BIGINT) AS note_total,
    CAST(0 AS BIGINT) AS non_positive, CAST(0 AS BIGINT) AS breaks, 'PASS' AS status FROM filled GROUP BY song_id, span_index""")
def repaired_audit(t: Tables):
    return sq.audit_filled(_filled(t), t.hot_songs)


PIECE_KEYS = ["song_id", "clip_id", "piece_start"]
ELEMENTS = f"el AS MATERIALIZED (SELECT * FROM ({QUERIES['rest_insertion'].sql}))"
TARGETS = f"""{ELEMENTS}, nb AS (SELECT *, 48 + (start_us // 1000000) % 25 AS f0, max(CASE WHEN kind = 'note' THEN element END) OVER (PARTITION BY song_id, clip_id, piece_start ORDER BY element
      ROWS UNBOUNDED PRECEDING) AS le, min(CASE WHEN kind = 'note' THEN element END) OVER (PARTITION BY song_id, clip_id, piece_start ORDER BY element ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS re FROM el),
    tg AS (SELECT n.song_id, n.clip_id, n.piece_start, n.element, CASE WHEN re IS NOT NULL AND (le IS NULL OR abs(f0 - r.pitch) <= abs(f0 - l.pitch)) THEN re ELSE le END AS target,
      CASE WHEN re IS NULL AND le IS NULL THEN NULL WHEN re IS NOT NULL AND (le IS NULL OR abs(f0 - r.pitch) <= abs(f0 - l.pitch)) THEN 'right' ELSE 'left' END AS side, n.end_us - n.start_us AS moved
      FROM nb n LEFT JOIN el l ON l.song_id = n.song_id AND l.clip_id = n.clip_id AND l.piece_start = n.piece_start AND l.element = le
      LEFT JOIN el r ON r.song_id = n.song_id AND r.clip_id = n.clip_id AND r.piece_start = n.piece_start AND r.element = re WHERE n.kind = 'rest')"""


def _elements(t: Tables):
    return QUERIES["rest_insertion"].build(t)


def _heard():
    return 48 + F.expr("start_us div 1000000") % 25


@query(f"WITH {TARGETS} SELECT * FROM tg")
def rest_neighbours(t: Tables):
    return sq.rest_targets(_elements(t), PIECE_KEYS, _heard(), t.hot_songs)


@query(f"""WITH {TARGETS} SELECT e.song_id, e.clip_id, e.piece_start, e.element, e.note_index, CAST(end_us - start_us + coalesce(m, 0) AS BIGINT) AS note_dur, CAST(coalesce(m, 0) AS BIGINT) AS absorbed
    FROM el e LEFT JOIN (SELECT song_id, clip_id, piece_start, target, sum(moved) AS m FROM tg WHERE moved < {120 * MINUTE_US} GROUP BY ALL) x
    ON x.song_id = e.song_id AND x.clip_id = e.clip_id AND x.piece_start = e.piece_start AND x.target = e.element WHERE kind = 'note'""")
def rest_absorption(t: Tables):
    short = F.col("end_us") - F.col("start_us") < 120 * MINUTE_US
    return sq.absorb_rests(_elements(t), PIECE_KEYS, _heard(), short, t.hot_songs)


# -- gap repair ---------------------------------------------------------------------

EVIDENCE = """evid AS (SELECT song_id, note_index AS boundary_index, start_us - left_end AS gap_len, CASE WHEN pitch % 4 = 0 THEN 'REST_CANDIDATE' ELSE 'VOCAL_EVIDENCE' END AS status,
    (note_index * 7 % 100) / 100.0 AS voiced_ratio, CASE WHEN note_index % 3 = 0 THEN 0.95 ELSE 0.8 END AS mode_ratio, (note_index % 5) / 2.0 AS span_semitone,
    note_index % 2 = 0 AS matches_left, note_index % 6 = 0 AS matches_right, -(note_index % 40) AS gap_dbfs, -(note_index % 20) AS relative_db
    FROM (SELECT *, lag(end_us) OVER (PARTITION BY song_id ORDER BY note_index) AS left_end FROM notes) WHERE start_us - left_end >= 500000)"""


def gap_rows(t: Tables):
    gaps = iv.adjacent_gaps(t.notes(), SONG, ["note_index"], 500_000, carry=["pitch"], hot=t.hot_songs)
    i = F.col("boundary_index")
    return gaps.select(
        "song_id", "boundary_index", "gap_len", F.when(F.col("right_pitch") % 4 == 0, "REST_CANDIDATE").otherwise("VOCAL_EVIDENCE").alias("status"),
        (i * 7 % 100 / 100).alias("voiced_ratio"), F.when(i % 3 == 0, 0.95).otherwise(0.8).alias("mode_ratio"), (i % 5 / 2).alias("span_semitone"),
        F.lit(None).cast("boolean").alias("pitch_match"), (i % 2 == 0).alias("matches_left"), (i % 6 == 0).alias("matches_right"),
        (-(i % 40)).alias("gap_dbfs"), (-(i % 20)).alias("relative_db"),
    )


@query(f"""WITH {EVIDENCE}, nx AS (SELECT *, lead(start_us) OVER w AS ns, lead(pitch) OVER w AS np FROM notes WINDOW w AS (PARTITION BY song_id ORDER BY note_index)),
    j AS (SELECT n.song_id, e.boundary_index, n.note_index, n.pitch, n.start_us, n.end_us AS old_end, ns AS new_end, CASE
      WHEN voiced_ratio >= 0.35 AND mode_ratio >= 0.75 AND span_semitone <= 2 AND pitch = np THEN 'EXTEND_LEFT_SAME_PITCH_NOTE'
      WHEN voiced_ratio >= 0.25 AND mode_ratio >= 0.9 AND span_semitone <= 2 AND gap_dbfs > -30 AND relative_db > -15 AND matches_left AND NOT matches_right THEN 'EXTEND_LEFT_F0_MATCHED_NOTE' END AS resolution
      FROM nx n JOIN evid e ON e.song_id = n.song_id AND e.boundary_index = n.note_index + 1 WHERE status = 'VOCAL_EVIDENCE' AND gap_len <= {600 * MINUTE_US} AND ns > n.end_us)
    SELECT * FROM j WHERE resolution IS NOT NULL""")
def gap_repairs(t: Tables):
    return ev.repair_gaps(t.notes(), gap_rows(t), 600 * MINUTE_US, t.hot_songs)


DECISIONS = f"""{EVIDENCE}, dc AS (SELECT song_id, boundary_index, CASE boundary_index % 3 WHEN 0 THEN 'EXTEND_LEFT_F0_DUAL' WHEN 1 THEN 'EXTEND_RIGHT_F0_DUAL' ELSE 'PRUNE_INTERVAL' END AS action FROM evid),
    nx AS (SELECT *, lead(start_us) OVER w AS ns, lag(end_us) OVER w AS pe FROM notes WINDOW w AS (PARTITION BY song_id ORDER BY note_index)),
    j AS (SELECT n.*, a.action AS aft, b.action AS bef FROM nx n LEFT JOIN dc a ON a.song_id = n.song_id AND a.boundary_index = n.note_index + 1
      LEFT JOIN dc b ON b.song_id = n.song_id AND b.boundary_index = n.note_index)"""


def _decided(t: Tables):
    i = F.col("boundary_index") % 3
    action = F.when(i == 0, "EXTEND_LEFT_F0_DUAL").when(i == 1, "EXTEND_RIGHT_F0_DUAL").otherwise("PRUNE_INTERVAL")
    decisions = gap_rows(t).select("song_id", "boundary_index", action.alias("action"))
    return ev.apply_decisions(t.notes(), decisions, t.hot_songs)


@query(f"""WITH {DECISIONS} SELECT song_id, note_index, track, pitch, CASE WHEN starts_with(bef, 'EXTEND_RIGHT') AND start_us > pe THEN pe ELSE start_us END AS start_us,
    CASE WHEN starts_with(aft, 'EXTEND_LEFT') AND ns > end_us THEN ns ELSE end_us END AS end_us FROM j""")
def decided_notes(t: Tables):
    return _decided(t)[0]


@query(f"WITH {DECISIONS} SELECT song_id, pe AS start_us, start_us AS end_us, bef AS reason FROM j WHERE starts_with(bef, 'PRUNE') AND start_us > pe")
def decided_cuts(t: Tables):
    return _decided(t)[1]


# -- pronunciation ------------------------------------------------------------------


@query("SELECT conv_id, turn, quorum, CASE WHEN quorum >= 2 THEN 'LOCKED' ELSE 'UNRESOLVED' END AS status, CASE WHEN quorum >= 2 THEN line ELSE '' END AS phones FROM ("
       "SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY quorum DESC, f) AS rn FROM (SELECT conv_id, turn, line, count(*) AS quorum, min(backend) AS f FROM variants GROUP BY ALL)) WHERE rn = 1")
def three_way_vote(t: Tables):
    return cs.vote(t.variants(), ["conv_id", "turn"], "line", "backend")


@query("""WITH w AS (SELECT conv_id, turn, backend, list_transform(list_filter(string_split_regex(trim(line), '\\s+'), lambda x: x <> ''), lambda x: CASE WHEN x = 'le' THEN 'SP' ELSE x END) AS p FROM variants),
    v AS (SELECT conv_id, turn, array_to_string(p, ' ') AS line, count(*) AS quorum, min(backend) AS f FROM w WHERE len(p) > 0 GROUP BY ALL)
    SELECT conv_id, turn, quorum, CASE WHEN quorum >= 2 THEN 'LOCKED' ELSE 'UNRESOLVED' END AS status, CASE WHEN quorum >= 2 THEN line ELSE '' END AS phones
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY quorum DESC, f) AS rn FROM v) WHERE rn = 1
    UNION ALL SELECT conv_id, turn, 0, 'UNRESOLVED', '' FROM w GROUP BY conv_id, turn HAVING max(len(p)) = 0""")
def canonical_vote(t: Tables):
    """The three voters write the word "le" as three spellings of a pause."""
    spelled = F.when(F.col("backend") == "a", "sp").when(F.col("backend") == "b", "sil").otherwise("SP")
    phones = F.transform(fn.tokens(F.col("line")), lambda w: F.when(w == "le", spelled).otherwise(w))
    return cs.vote_phones(t.variants().withColumn("p", phones), ["conv_id", "turn"], "p", "backend")


CROSS = """cx AS (SELECT conv_id, turn, p, s, substr(sha256(role || chr(9) || array_to_string(p, ' ')), 1, 16) AS primary_variant, substr(sha256(role || chr(9) || array_to_string(s, ' ')), 1, 16) AS secondary_variant,
      CASE WHEN turn = 3 THEN 'auto_locked_override' WHEN p = s AND NOT list_contains(p, 'le') THEN 'auto_locked' ELSE 'pending' END AS crosscheck
    FROM (SELECT *, list_filter(string_split_regex(trim(lower(text)), '\\s+'), lambda x: x <> '') AS p, list_filter(string_split_regex(trim(regexp_replace(lower(text), '[.,]', '', 'g')), '\\s+'), lambda x: x <> '') AS s FROM conversations))"""


def _cross(t: Tables):
    c = t.read("conversations")
    p, s = fn.tokens(F.lower("text")), fn.tokens(F.regexp_replace(F.lower("text"), "[.,]", ""))
    rows = c.select("conv_id", "turn", "role", fn.without_pauses(p).alias("p"), fn.without_pauses(s).alias("s"))
    return cs.two_way(rows, F.col("role"), F.col("p"), F.col("s"), F.array_contains("p", "le"), F.col("turn") == 3)


@query(f"WITH {CROSS} SELECT conv_id, turn, primary_variant, secondary_variant, crosscheck FROM cx")
def two_way_agreement(t: Tables):
    return _cross(t).drop("p", "s", "role")


@query(f"""WITH {CROSS}, v AS (SELECT conv_id, turn, line, count(*) AS q FROM variants WHERE turn % 2 = 0 GROUP BY ALL HAVING count(*) >= 2),
    j AS (SELECT c.*, v.q, v.line, CASE WHEN v.q IS NOT NULL THEN 'THREE_WAY_G2P_CONSENSUS' WHEN crosscheck = 'pending' THEN 'PRUNE_LYRIC_UNIT'
      WHEN primary_variant = secondary_variant THEN 'EXISTING_TWO_WAY_LOCKED' ELSE 'PRUNE_LYRIC_UNIT_NO_UNIQUE_LOCK' END AS resolution_action FROM cx c LEFT JOIN v USING (conv_id, turn))
    SELECT conv_id, turn, resolution_action, CASE WHEN resolution_action IN ('THREE_WAY_G2P_CONSENSUS', 'EXISTING_TWO_WAY_LOCKED') THEN 'LOCKED' ELSE 'EXCLUDED' END AS status,
      CASE WHEN q IS NOT NULL THEN q WHEN resolution_action = 'EXISTING_TWO_WAY_LOCKED' THEN 2 ELSE 0 END AS quorum,
      CASE WHEN q IS NOT NULL THEN line WHEN resolution_action = 'EXISTING_TWO_WAY_LOCKED' THEN array_to_string(p, ' ') ELSE '' END AS phones FROM j""")
def locks(t: Tables):
    keys = ["conv_id", "turn"]
    cross = _cross(t)
    occurrences = cross.select(*keys, F.array_join("p", " ").alias("phones"))
    consensus = cs.vote(t.variants().where("turn % 2 = 0"), keys, "line", "backend").where("status = 'LOCKED'")
    return cs.locks(occurrences, cross.select(*keys, "primary_variant", "secondary_variant", "crosscheck"), consensus, keys)


@query("SELECT key, value, layer FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY layer, position DESC) AS rn FROM dictionary) WHERE rn = 1")
def layered_dictionary(t: Tables):
    return cs.layered(t.dictionary())


WORDS = """wd AS (SELECT conv_id, turn, i AS ix, w AS word, lower(w) AS key FROM (SELECT conv_id, turn, string_split_regex(trim(text), '\\s+') AS ws FROM conversations), LATERAL (SELECT unnest(ws) AS w, generate_subscripts(ws, 1) AS i)),
    uq AS (SELECT key, min(word) AS value FROM wd GROUP BY key HAVING count(DISTINCT word) = 1)"""


def _words(t: Tables):
    c = t.read("conversations")
    return c.select("conv_id", "turn", F.explode(fn.tokens(F.col("text"))).alias("value")).withColumn("key", F.lower("value"))


@query(f"WITH {WORDS} SELECT key, value FROM uq")
def unique_variants(t: Tables):
    return cs.unique_variants(_words(t))


@query(f"""WITH {WORDS} SELECT conv_id, turn, count(*) AS words, count(uq.value) AS known, CASE WHEN count(*) = count(uq.value) THEN string_agg(uq.value, ' ' ORDER BY ix) ELSE '' END AS phones
    FROM wd LEFT JOIN uq USING (key) GROUP BY conv_id, turn""")
def line_assembly(t: Tables):
    lines = t.read("conversations").select("conv_id", "turn", "text")
    return cs.assemble_lines(lines, cs.unique_variants(_words(t)), ["conv_id", "turn"], fn.tokens(F.lower("text")))


@query("""SELECT d.key, position, value, kept FROM dictionary d JOIN (SELECT key, arg_min(value, position) AS kept FROM dictionary GROUP BY key) f USING (key) WHERE value <> kept""")
def key_conflicts(t: Tables):
    return cs.key_conflicts(t.dictionary())


LEXICON = """lx AS (SELECT r_name AS key, lower(r_name) AS value, 0 AS layer FROM region WHERE r_regionkey < 3
    UNION ALL SELECT DISTINCT ch, lower(ch), 1 FROM (SELECT unnest(string_split(n_name, '')) AS ch FROM nation)),
    ly AS (SELECT c_custkey AS phrase, CASE WHEN c_custkey % 3 = 0 THEN r_name ELSE c_mktsegment END AS surface, CASE WHEN c_custkey % 10 = 7 THEN '' WHEN n_nationkey % 2 = 0 THEN n_name ELSE c_mktsegment END AS reading
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    sp AS (SELECT surface, reading, count(*) AS n, count(value) AS m, string_agg(value, ' ' ORDER BY ix) AS cv FROM (
      SELECT surface, reading, unnest(string_split(reading, '')) AS ch, generate_subscripts(string_split(reading, ''), 1) AS ix FROM (SELECT DISTINCT surface, reading FROM ly WHERE length(reading) > 1)) x
      LEFT JOIN lx ON lx.key = x.ch GROUP BY ALL),
    an AS (SELECT phrase, ly.surface, ly.reading, coalesce(s.value, r.value, CASE WHEN n = m THEN cv END) AS phones,
      CASE WHEN s.value IS NOT NULL THEN 'surface' WHEN r.value IS NOT NULL THEN 'reading' WHEN n = m THEN 'characters' END AS found_by,
      CASE WHEN s.value IS NOT NULL THEN s.layer WHEN r.value IS NOT NULL THEN r.layer WHEN n = m THEN 1 END AS layer
      FROM ly LEFT JOIN lx s ON s.key = ly.surface LEFT JOIN lx r ON r.key = ly.reading LEFT JOIN sp ON sp.surface = ly.surface AND sp.reading = ly.reading)"""


@query(f"""WITH {LEXICON} SELECT phrase, phones, found_by, CASE WHEN reading = '' OR phones IS NULL THEN NULL ELSE substr(sha256(surface || chr(9) || phones), 1, 16) END AS dictionary_variant,
    CASE WHEN reading = '' OR phones IS NULL THEN NULL WHEN layer = 1 THEN 'pending' ELSE 'locked' END AS lock_status,
    CASE WHEN reading = '' THEN 'PRONUNCIATION_UNLOCKED' WHEN phones IS NULL THEN 'UNKNOWN_DICTIONARY_ENTRY' WHEN layer = 1 THEN 'PRONUNCIATION_CANDIDATE_REVIEW_REQUIRED' END AS issue FROM an""")
def dictionary_fallback(t: Tables):
    nation, region = t.read("nation"), t.read("region")
    low = region.where("r_regionkey < 3").select(F.col("r_name").alias("key"), F.lower("r_name").alias("value"), F.lit(0).alias("layer"))
    chars = nation.select(F.explode(F.split("n_name", "")).alias("key")).distinct().select("key", F.lower("key").alias("value"), F.lit(1).alias("layer"))
    both = t.read("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    reading = F.when(F.col("c_custkey") % 10 == 7, "").when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise(F.col("c_mktsegment"))
    phrases = both.select(
        F.col("c_custkey").alias("phrase"), F.when(F.col("c_custkey") % 3 == 0, F.col("r_name")).otherwise(F.col("c_mktsegment")).alias("surface"), reading.alias("reading")
    )
    out = cs.lyric_status(cs.resolve(phrases, low.unionByName(chars)), ["1"])
    return out.select("phrase", "phones", "found_by", "dictionary_variant", "lock_status", "issue")


@query("""WITH f AS (SELECT conv_id, turn, unnest(list_filter([CASE WHEN contains(text, ',') THEN 'pause' END, CASE WHEN regexp_matches(text, '[A-Za-z]') THEN 'latin_text' END,
    CASE WHEN length(text) > 400 THEN 'long' END], lambda x: x IS NOT NULL)) AS flag FROM conversations) SELECT flag, count(*) AS n FROM f GROUP BY flag""")
def flag_histogram(t: Tables):
    flags = {"pause": F.col("text").contains(","), "latin_text": fn.has_latin(F.col("text")), "long": F.length("text") > 400}
    rows = mf.field_issues(t.read("conversations"), "conv_id", flags)
    return rows.groupBy(F.col("code").alias("flag")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH inv AS (SELECT key, count(*) AS n FROM dictionary GROUP BY key), used AS (SELECT DISTINCT 'Brand#' || (l_partkey % 40) AS phone FROM lineitem)
    SELECT 'DUPLICATE_PHONE' AS type, key AS phone FROM inv WHERE n > 1 UNION ALL SELECT 'UNKNOWN_PHONE', phone FROM used WHERE phone NOT IN (SELECT key FROM inv)""")
def phone_inventory_check(t: Tables):
    inventory = t.dictionary().groupBy("key").count()
    used = t.read("lineitem").select(F.concat(F.lit("Brand#"), (F.col("l_partkey") % 40).cast("string")).alias("phone")).distinct()
    twice = inventory.where("count > 1").select(F.lit("DUPLICATE_PHONE").alias("type"), F.col("key").alias("phone"))
    unknown = used.join(inventory.withColumnRenamed("key", "phone"), "phone", "left_anti").select(F.lit("UNKNOWN_PHONE").alias("type"), "phone")
    return twice.unionByName(unknown)


@query("""SELECT l.doc_id, 'sealed_' || l.doc_id AS name, c.audio_sha256, CASE WHEN c.clip_id IS NULL THEN 'SEGMENT_MISSING' WHEN c.split <> 'train' THEN 'NOT_SEALED' END AS issue
    FROM labels l LEFT JOIN clips c ON c.clip_id = l.doc_id""")
def sealed_import(t: Tables):
    segments = t.read("labels").select("doc_id")
    rows = segments.join(t.clips().select(F.col("clip_id").alias("doc_id"), "audio_sha256", "split"), "doc_id", "left")
    issue = F.when(F.col("split").isNull(), "SEGMENT_MISSING").when(F.col("split") != "train", "NOT_SEALED")
    return rows.select("doc_id", F.concat(F.lit("sealed_"), F.col("doc_id").cast("string")).alias("name"), "audio_sha256", issue.alias("issue"))


@query("""SELECT page_id, source, sha256 FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pri) AS rn FROM (
    SELECT page_id, 'register' AS source, sha256, 1 AS pri FROM registered WHERE page_id % 3 <> 0 UNION ALL SELECT page_id, 'current', sha256, 2 FROM members)) WHERE rn = 1""")
def preferred_source(t: Tables):
    a = t.registered().where("page_id % 3 <> 0").select("page_id", F.lit("register").alias("source"), "sha256", F.lit(1).alias("pri"))
    b = t.members().select("page_id", F.lit("current").alias("source"), "sha256", F.lit(2).alias("pri"))
    best = a.unionByName(b).groupBy("page_id").agg(F.min_by(F.struct("source", "sha256"), "pri").alias("m"))
    return best.select("page_id", "m.source", "m.sha256")
