"""Rests absorbed in notes and phones, label alignment with its boundaries, pauses over voice, run audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..operators import contracts as ct
from ..operators import repairs as rp
from ..operators.scans import refine, row_number, running_sum, scan
from .registry import QUERIES, query
from .sequence_queries import PIECE_KEYS, TARGETS
from .timeline_queries import MINUTE_US
from .views import Tables

SHORT = 120 * MINUTE_US

# -- rests ----------------------------------------------------------------------------

# Every note has one or two phones, every rest a pause; some songs breathe at their first rest.
PHONES = f"""{TARGETS}, un AS MATERIALIZED (SELECT *, end_us - start_us AS dur, CAST(sum(CASE WHEN kind = 'note' OR element % 2 = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY song_id, clip_id, piece_start ORDER BY element ROWS UNBOUNDED PRECEDING) AS BIGINT) AS unit FROM el),
    ph AS MATERIALIZED (
      SELECT song_id, clip_id, piece_start, 2 * element AS ph_index, CASE WHEN kind = 'rest' THEN CASE WHEN song_id % 10 = 7 AND element = 1 THEN 'AP' ELSE 'SP' END WHEN pitch % 2 = 0 THEN 'c' ELSE 'v' END AS phone, unit,
        CASE WHEN kind = 'note' AND pitch % 2 = 0 THEN dur // 3 ELSE dur END AS dur FROM un
      UNION ALL SELECT song_id, clip_id, piece_start, 2 * element + 1, 'v', unit, dur - dur // 3 FROM un WHERE kind = 'note' AND pitch % 2 = 0),
    rn AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY song_id, clip_id, piece_start ORDER BY element) AS rest_no FROM tg),
    pl AS MATERIALIZED (SELECT *, max(CASE WHEN phone <> 'SP' THEN ph_index END) OVER (w ROWS UNBOUNDED PRECEDING) AS lp, min(CASE WHEN phone <> 'SP' THEN ph_index END) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rp,
        sum(CASE WHEN phone = 'SP' THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING) AS rest_no FROM ph WINDOW w AS (PARTITION BY song_id, clip_id, piece_start ORDER BY ph_index)),
    bo AS MATERIALIZED (SELECT r.*, p.ph_index, p.dur AS ph_dur, CASE WHEN side = 'right' THEN p.rp ELSE p.lp END AS pt FROM rn r LEFT JOIN (SELECT * FROM pl WHERE phone = 'SP') p USING (song_id, clip_id, piece_start, rest_no) WHERE moved < {SHORT}),
    iss AS MATERIALIZED (SELECT song_id, clip_id, piece_start, element, CASE WHEN side IS NULL THEN 'REST_WITHOUT_NOTE' WHEN ph_index IS NULL THEN 'REST_WITHOUT_PAUSE' WHEN pt IS NULL THEN 'PAUSE_WITHOUT_PHONE' END AS type FROM bo
        WHERE side IS NULL OR ph_index IS NULL OR pt IS NULL),
    fine AS MATERIALIZED (SELECT * FROM bo WHERE (song_id, clip_id, piece_start) NOT IN (SELECT (song_id, clip_id, piece_start) FROM iss)),
    ed AS MATERIALIZED (SELECT song_id, clip_id, piece_start, 'note' AS list, element AS position, target AS recipient, side, moved FROM fine
        UNION ALL SELECT song_id, clip_id, piece_start, 'phone', ph_index, pt, side, ph_dur FROM fine),
    got AS MATERIALIZED (SELECT song_id, clip_id, piece_start, list, recipient, sum(moved) AS m FROM ed GROUP BY ALL),
    ph2 AS MATERIALIZED (SELECT song_id, clip_id, piece_start, row_number() OVER w AS ph_index, phone, dense_rank() OVER (PARTITION BY song_id, clip_id, piece_start ORDER BY unit) AS unit, CAST(dur + coalesce(m, 0) AS BIGINT) AS dur
        FROM ph x LEFT JOIN got g ON g.song_id = x.song_id AND g.clip_id = x.clip_id AND g.piece_start = x.piece_start AND g.list = 'phone' AND g.recipient = x.ph_index
        WHERE (x.song_id, x.clip_id, x.piece_start, x.ph_index) NOT IN (SELECT (song_id, clip_id, piece_start, position) FROM ed WHERE list = 'phone') WINDOW w AS (PARTITION BY x.song_id, x.clip_id, x.piece_start ORDER BY x.ph_index)),
    no2 AS MATERIALIZED (SELECT x.*, CAST(dur + coalesce(m, 0) AS BIGINT) AS d2 FROM un x LEFT JOIN got g ON g.song_id = x.song_id AND g.clip_id = x.clip_id AND g.piece_start = x.piece_start AND g.list = 'note' AND g.recipient = x.element
        WHERE (x.song_id, x.clip_id, x.piece_start, x.element) NOT IN (SELECT (song_id, clip_id, piece_start, position) FROM ed WHERE list = 'note'))"""
PHONES = PHONES.replace("SELECT song_id, clip_id, piece_start, row_number() OVER w AS ph_index", "SELECT x.song_id, x.clip_id, x.piece_start, row_number() OVER w AS ph_index").replace("(PARTITION BY song_id, clip_id, piece_start ORDER BY unit) AS unit, CAST(dur", "(PARTITION BY x.song_id, x.clip_id, x.piece_start ORDER BY unit) AS unit, CAST(dur")


def _sung(t: Tables) -> tuple[DataFrame, DataFrame, Column, Column]:
    """Elements and phones of all pieces, the pitch heard in a rest, and which rests failed."""
    elements = QUERIES["rest_insertion"].build(t).withColumn("dur", F.col("end_us") - F.col("start_us"))
    note = F.col("kind") == "note"
    fresh = F.when(note | (F.col("element") % 2 == 1), 1).otherwise(0).cast("bigint")
    rows = scan(elements, PIECE_KEYS, ["element"], [running_sum("unit", fresh)], refine(t.hot_songs, elements, PIECE_KEYS))
    slot = lambda k, phone, dur: F.struct((2 * F.col("element") + k).alias("ph_index"), phone.alias("phone"), dur.alias("dur"))
    third = F.expr("dur div 3")
    breath = F.when((F.col("song_id") % 10 == 7) & (F.col("element") == 1), "AP").otherwise(rp.PAUSE)
    two = note & (F.col("pitch") % 2 == 0)
    slots = F.when(two, F.array(slot(0, F.lit("c"), third), slot(1, F.lit("v"), F.col("dur") - third))).otherwise(F.array(slot(0, F.when(note, "v").otherwise(breath), F.col("dur"))))
    phones = rows.select(*PIECE_KEYS, "unit", F.explode(slots).alias("p")).select(*PIECE_KEYS, "p.ph_index", "p.phone", "unit", "p.dur")
    return elements, phones, 48 + F.expr("start_us div 1000000") % 25, F.col("dur") < SHORT


@query(f"WITH {PHONES} SELECT song_id, clip_id, piece_start, list, position, recipient, side, moved FROM ed")
def rest_edit_script(t: Tables):
    elements, phones, heard, failed = _sung(t)
    return rp.rest_edits(elements, phones, PIECE_KEYS, heard, failed, t.hot_songs)[0]


@query(f"WITH {PHONES} SELECT * FROM iss")
def rest_edit_issues(t: Tables):
    elements, phones, heard, failed = _sung(t)
    return rp.rest_edits(elements, phones, PIECE_KEYS, heard, failed, t.hot_songs)[1]


@query(f"WITH {PHONES} SELECT song_id, clip_id, piece_start, ph_index, phone, unit, dur FROM ph2")
def rest_absorbed_phones(t: Tables):
    elements, phones, heard, failed = _sung(t)
    return rp.absorb_rests(elements, phones, PIECE_KEYS, heard, failed, t.hot_songs)[1]


@query(f"WITH {PHONES} SELECT song_id, clip_id, piece_start, unit, count(*) AS ph_num FROM ph2 GROUP BY ALL")
def rest_absorbed_units(t: Tables):
    elements, phones, heard, failed = _sung(t)
    return rp.unit_counts(rp.absorb_rests(elements, phones, PIECE_KEYS, heard, failed, t.hot_songs)[1], PIECE_KEYS)


@query(f"""WITH {PHONES}, a AS (SELECT song_id, clip_id, piece_start, count(*) AS slots, CAST(sum(d2) AS BIGINT) AS note_total, CAST(count_if(kind = 'rest') AS BIGINT) AS rests FROM no2 GROUP BY ALL),
    b AS (SELECT song_id, clip_id, piece_start, count(*) AS phones, CAST(sum(dur) AS BIGINT) AS ph_total, CAST(count_if(phone = 'SP') AS BIGINT) AS pauses, max(unit) AS units FROM ph2 GROUP BY ALL)
    SELECT *, CASE WHEN note_total = ph_total AND rests = pauses THEN 'PASS' ELSE 'BLOCKED' END AS status FROM a JOIN b USING (song_id, clip_id, piece_start)""")
def rest_absorption_contract(t: Tables):
    elements, phones, heard, failed = _sung(t)
    notes, left, _, _ = rp.absorb_rests(elements, phones, PIECE_KEYS, heard, failed, t.hot_songs)
    return rp.rest_contract(notes, left, PIECE_KEYS)


# -- alignment ------------------------------------------------------------------------

TURN = ["conv_id", "turn"]
QUIET = ("la", "le", "the", "and", "und", "der", "in", "que", "die", "de", "el", "to", "of")
SIL = ["sil", "sp"]
STEP = 1000
# Words are labels; small words are pauses, of which every third is expected. Long words come out as spn.
WORDS = f"""words AS MATERIALIZED (SELECT conv_id, turn, w[k] AS word, k - 1 AS i, len(w) AS n, CASE WHEN conv_id % 11 = 5 THEN 200 ELSE 0 END AS lead FROM
      (SELECT *, unnest(generate_series(1, len(w))) AS k FROM (SELECT conv_id, turn, list_filter(string_split_regex(trim(lower(text)), '\\s+'), lambda x: x <> '') AS w FROM conversations))),
    lab AS MATERIALIZED (SELECT conv_id, turn, i, n, lead, word IN {QUIET} AS quiet, CASE WHEN word IN {QUIET} THEN 'sil' WHEN length(word) >= 17 THEN 'spn' ELSE word END AS label,
      lead + i * {STEP} AS "start", lead + i * {STEP} + CASE WHEN i % 37 = 36 AND conv_id % 5 = 0 THEN 0 ELSE {STEP} END AS "end" FROM words),
    ex AS MATERIALIZED (SELECT conv_id, turn, i AS pos, CASE WHEN conv_id % 17 = 4 AND i = 2 THEN 'x' ELSE label END AS phone FROM lab WHERE NOT quiet OR i % 3 = 1),
    it AS (SELECT conv_id, turn, max(n) * {STEP} + max(lead) + CASE WHEN conv_id % 13 = 7 THEN 500 ELSE 0 END AS item_end, turn % 2 = 0 AS lead_rest, conv_id % 2 = 0 AS trail_rest FROM lab GROUP BY conv_id, turn),
    exo AS MATERIALIZED (SELECT *, sum(CASE WHEN phone <> 'sil' THEN 1 ELSE 0 END) OVER w AS r, sum(CASE WHEN phone = 'sil' THEN 1 ELSE 0 END) OVER w AS p FROM ex WINDOW w AS (PARTITION BY conv_id, turn ORDER BY pos ROWS UNBOUNDED PRECEDING)),
    fno AS MATERIALIZED (SELECT *, sum(CASE WHEN label <> 'sil' THEN 1 ELSE 0 END) OVER w AS r, sum(CASE WHEN label = 'sil' THEN 1 ELSE 0 END) OVER w AS p FROM lab WINDOW w AS (PARTITION BY conv_id, turn ORDER BY i ROWS UNBOUNDED PRECEDING)),
    exq AS MATERIALIZED (SELECT *, CASE WHEN phone = 'sil' THEN p - coalesce(max(CASE WHEN phone <> 'sil' THEN p END) OVER (PARTITION BY conv_id, turn, r), 0) ELSE 0 END AS q FROM exo),
    fnq AS MATERIALIZED (SELECT *, CASE WHEN label = 'sil' THEN p - coalesce(max(CASE WHEN label <> 'sil' THEN p END) OVER (PARTITION BY conv_id, turn, r), 0) ELSE 0 END AS q FROM fno),
    pr AS MATERIALIZED (SELECT conv_id, turn, e.pos, e.phone, f.i AS idx, f.label, f."start", f."end",
      CASE WHEN e.pos IS NULL THEN CASE WHEN f.label = 'sil' THEN 'SKIPPED_PAUSE' ELSE 'UNEXPECTED' END WHEN f.i IS NULL THEN 'MISSING' WHEN f.label = 'sil' OR f.label = e.phone THEN 'MATCH' ELSE 'LABEL_MISMATCH' END AS status
      FROM exq e FULL OUTER JOIN fnq f USING (conv_id, turn, r, q)),
    ai AS MATERIALIZED (SELECT conv_id, turn, unnest(list_filter([CASE WHEN bool_or(idx IS NOT NULL AND status <> 'SKIPPED_PAUSE' AND label = 'spn') THEN 'MFA_FORBIDDEN_PHONE' END, CASE WHEN bool_or(status IN ('LABEL_MISMATCH', 'MISSING', 'UNEXPECTED')) THEN 'MFA_PHONE_SEQUENCE_MISMATCH' END,
      CASE WHEN bool_or(idx IS NOT NULL AND status <> 'SKIPPED_PAUSE' AND "end" <= "start") THEN 'MFA_NON_POSITIVE_PHONE_DURATION' END], lambda x: x IS NOT NULL)) AS type FROM pr GROUP BY conv_id, turn),
    en AS (SELECT it.*, coalesce(fs, item_end) AS fs, coalesce(le, 0) AS le FROM it LEFT JOIN (SELECT conv_id, turn, min_by("start", idx) AS fs, max_by("end", idx) AS le FROM pr WHERE idx IS NOT NULL AND status <> 'SKIPPED_PAUSE' GROUP BY conv_id, turn) USING (conv_id, turn)),
    bd AS MATERIALIZED (SELECT conv_id, turn, 'leading' AS side, fs AS gap, CASE WHEN (SELECT count(*) = 0 OR bool_or(label <> 'sil') FROM fnq f WHERE f.conv_id = en.conv_id AND f.turn = en.turn AND f."start" < fs - 1 AND f."end" > f."start") THEN 'BOUNDARY_UNEXPLAINED' WHEN lead_rest THEN 'PAUSE_INSERTED' ELSE 'PHONE_EXTENDED' END AS resolution FROM en WHERE fs > 1
      UNION ALL SELECT conv_id, turn, 'trailing', item_end - le, CASE WHEN (SELECT count(*) = 0 OR bool_or(label <> 'sil') FROM fnq f WHERE f.conv_id = en.conv_id AND f.turn = en.turn AND f."end" > le + 1 AND f."start" >= le - 2) THEN 'BOUNDARY_UNEXPLAINED' WHEN trail_rest THEN 'PAUSE_INSERTED' ELSE 'PHONE_EXTENDED' END FROM en WHERE item_end - le > 1)"""


def _aligned(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Expected phones beside found labels of every turn, and the turns as items."""
    turns = t.read("conversations").select(*TURN, fn.tokens(F.lower("text")).alias("w"))
    words = turns.select(*TURN, F.size("w").cast("bigint").alias("n"), F.posexplode("w").alias("i", "word")).withColumn("i", F.col("i").cast("bigint"))
    quiet, lead = F.col("word").isin(*QUIET), F.when(F.col("conv_id") % 11 == 5, 200).otherwise(0).cast("bigint")
    begin = lead + F.col("i") * STEP
    label = F.when(quiet, F.when(F.col("i") % 2 == 0, "").otherwise("sil")).when(F.length("word") >= 17, "spn").otherwise(F.col("word"))
    length = F.when((F.col("i") % 37 == 36) & (F.col("conv_id") % 5 == 0), 0).otherwise(STEP)
    found = words.select(*TURN, F.col("i").alias("idx"), label.alias("label"), begin.alias("start"), (begin + length).alias("end"))
    wrong = (F.col("conv_id") % 17 == 4) & (F.col("i") == 2)
    phone = F.when(wrong, "x").when(quiet, "sil").when(F.length("word") >= 17, "spn").otherwise(F.col("word"))
    expected = words.where(~quiet | (F.col("i") % 3 == 1)).select(*TURN, F.col("i").alias("pos"), phone.alias("phone"))
    late = F.when(F.col("conv_id") % 13 == 7, 500).otherwise(0)
    items = turns.where(F.size("w") > 0).select(*TURN, (F.size("w") * STEP + lead + late).cast("bigint").alias("item_end"), (F.col("turn") % 2 == 0).alias("lead_rest"), (F.col("conv_id") % 2 == 0).alias("trail_rest"))
    return rp.align_labels(found, expected, TURN, SIL), items


@query(f"WITH {WORDS} SELECT conv_id, turn, pos, phone, idx, label, \"start\", \"end\", status FROM pr")
def label_alignment(t: Tables):
    return _aligned(t)[0]


@query(f"WITH {WORDS} SELECT conv_id, turn, type FROM ai")
def alignment_contract(t: Tables):
    return rp.alignment_issues(_aligned(t)[0], TURN)


@query(f"WITH {WORDS} SELECT conv_id, turn, side, gap, resolution FROM bd")
def boundary_time(t: Tables):
    pairs, items = _aligned(t)
    return rp.boundary_edits(pairs, items, TURN, SIL)


@query(f"""WITH {WORDS}, br AS (SELECT conv_id, turn FROM ai UNION SELECT conv_id, turn FROM bd WHERE resolution = 'BOUNDARY_UNEXPLAINED'),
    gd AS MATERIALIZED (SELECT *, min(pos) OVER (PARTITION BY conv_id, turn) AS f, max(pos) OVER (PARTITION BY conv_id, turn) AS l FROM pr WHERE status = 'MATCH' AND (conv_id, turn) NOT IN (SELECT (conv_id, turn) FROM br)),
    wd AS (SELECT conv_id, turn, sum(CASE WHEN side = 'leading' AND resolution = 'PAUSE_INSERTED' THEN gap END) AS lp, sum(CASE WHEN side = 'leading' AND resolution = 'PHONE_EXTENDED' THEN gap END) AS lm,
      sum(CASE WHEN side = 'trailing' AND resolution = 'PAUSE_INSERTED' THEN gap END) AS tp, sum(CASE WHEN side = 'trailing' AND resolution = 'PHONE_EXTENDED' THEN gap END) AS tm FROM bd GROUP BY conv_id, turn),
    g AS (SELECT * FROM gd LEFT JOIN wd USING (conv_id, turn))
    SELECT conv_id, turn, pos + CASE WHEN lp IS NULL THEN 0 ELSE 1 END AS pos, phone, CAST("end" - "start" + CASE WHEN pos = f THEN coalesce(lm, 0) ELSE 0 END + CASE WHEN pos = l THEN coalesce(tm, 0) ELSE 0 END AS BIGINT) AS dur, false AS inserted FROM g
    UNION ALL SELECT DISTINCT conv_id, turn, 0, 'SP', CAST(lp AS BIGINT), true FROM g WHERE lp IS NOT NULL
    UNION ALL SELECT DISTINCT conv_id, turn, l + 1 + CASE WHEN lp IS NULL THEN 0 ELSE 1 END, 'SP', CAST(tp AS BIGINT), true FROM g WHERE tp IS NOT NULL""")
def aligned_phones(t: Tables):
    pairs, items = _aligned(t)
    return rp.aligned_phones(pairs, rp.boundary_edits(pairs, items, TURN, SIL), TURN)


# -- voice in pauses, run audit ---------------------------------------------------------

FRAME = 5


@query(f"""WITH p AS (SELECT item_id, row_number() OVER w AS ph_index, CASE WHEN note_slur = 0 THEN 'SP' WHEN line = 3 THEN 'AP' ELSE 'a' END AS phone, ph_dur, sum(ph_dur) OVER (w ROWS UNBOUNDED PRECEDING) AS e FROM item_elements WINDOW w AS (PARTITION BY item_id ORDER BY line, part, supp, cents)),
    f AS (SELECT item_id, unnest(generate_series(0, total // {FRAME})) * {FRAME} + 2 AS mid FROM (SELECT item_id, CAST(sum(ph_dur) AS BIGINT) AS total FROM item_elements GROUP BY item_id))
    SELECT item_id, ph_index, phone, count(*) AS voiced FROM p JOIN f USING (item_id) WHERE phone IN ('SP', 'AP') AND mid >= e - ph_dur AND mid < e AND (mid + item_id) % 3 > 0 GROUP BY ALL""")
def voiced_pauses(t: Tables):
    kind = F.when(F.col("note_slur") == 0, "SP").when(F.col("line") == 3, "AP").otherwise("a")
    phones = scan(t.item_elements(), ["item_id"], t.ITEM_ORDER, [row_number("ph_index")], t.hot_items).select("item_id", "ph_index", kind.alias("phone"), F.col("ph_dur").alias("dur"))
    totals = t.item_elements().groupBy("item_id").agg(F.sum("ph_dur").alias("total"))
    frames = totals.select("item_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"total div {FRAME}"))).alias("k")).select("item_id", (F.col("k") * FRAME + 2).alias("at"))
    voiced = F.when((F.col("at") + F.col("item_id")) % 3 > 0, 220).otherwise(0)
    return rp.voiced_pauses(phones, frames.withColumn("f0", voiced), ["item_id"], hot=t.hot_items)
