"""Text formats parsed from columns, and scalar rules: the tables' rows are written in a format and read back.

The SQL never parses that text; it says from the source rows what has to come out.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..operators.scans import refine
from ..sources import readers as rd
from .registry import query
from .views import Tables

TEXT = lambda c: F.col(c).cast("string")


def _seconds(c: str):
    return F.concat(F.expr(f"{c} div 1000000").cast("string"), F.lit("."), F.lpad((F.col(c) % 1_000_000).cast("string"), 6, "0"))


# -- line formats ---------------------------------------------------------------------


def _lab(t: Tables):
    """One LAB file per song; some lines lack a field, some have no number, some are blank."""
    k = F.col("note_index") % 11
    line = F.concat_ws(" ", _seconds("start_us"), _seconds("end_us"), "track")
    value = F.when(k == 3, F.concat_ws("\t", _seconds("start_us"), "track")).when(k == 5, F.concat_ws(" ", F.lit("x"), _seconds("end_us"), "track")).when(k == 7, "  ").otherwise(line)
    return t.mono_notes().select(F.col("song_id").alias("file"), (F.col("note_index") + 1).alias("line"), value.alias("value"))


LAB_GOOD = "SELECT song_id AS file, note_index + 1 AS line, start_us / 1e6 AS start, end_us / 1e6 AS \"end\", track AS phone FROM mono_notes WHERE note_index % 11 NOT IN (3, 5, 7)"


@query(LAB_GOOD)
def lab_lines(t: Tables):
    return rd.parse_lab(_lab(t))[0]


@query("""SELECT song_id AS file, note_index + 1 AS line, CASE note_index % 11 WHEN 3 THEN 'FIELD_COUNT' ELSE 'NOT_A_NUMBER' END AS reason
    FROM mono_notes WHERE note_index % 11 IN (3, 5)""")
def lab_line_issues(t: Tables):
    return rd.parse_lab(_lab(t))[1]


@query(f"""WITH good AS ({LAB_GOOD}) SELECT file, line, start, "end", phone
    FROM (SELECT *, lag("end") OVER (PARTITION BY file ORDER BY line) AS before FROM good) WHERE abs(start - before) > 1.0 / 44100""")
def lab_breaks(t: Tables):
    good = rd.parse_lab(_lab(t))[0]
    return rd.lab_breaks(good, hot=refine(t.hot_songs, good, ["file"]))


@query("""WITH kept AS (SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY note_index) AS n FROM notes WHERE note_index % 6 <> 4)
    SELECT song_id AS file, note_index + 2 AS line,
      CASE WHEN song_id % 2 = 0 AND note_index % 3 = 0 THEN 'q' || note_index ELSE 'p' || CASE WHEN n < 1000 THEN lpad(CAST(n AS VARCHAR), 3, '0') ELSE CAST(n AS VARCHAR) END END AS phrase_id,
      track AS surface, 'r' || pitch AS reading, CASE WHEN note_index % 5 = 0 THEN 0 ELSE pitch % 7 END AS note_count FROM kept""")
def lyrics_lines(t: Tables):
    """Tab files with two column orders; ids, counts and whole lines may be blank."""
    count = F.when(F.col("note_index") % 5 == 0, F.lit("many")).otherwise((F.col("pitch") % 7).cast("string"))
    given = F.when(F.col("note_index") % 3 == 0, F.concat(F.lit("q"), TEXT("note_index"))).otherwise("")
    reading = F.concat(F.lit("r"), TEXT("pitch"))
    row = F.when(F.col("song_id") % 2 == 0, F.concat_ws("\t", given, F.col("track"), reading, count)).otherwise(F.concat_ws("\t", reading, F.concat(F.lit(" "), "track"), count))
    value = F.when(F.col("note_index") % 6 == 4, " ").otherwise(row)
    notes = t.notes()
    body = notes.select(F.col("song_id").alias("file"), (F.col("note_index") + 2).alias("line"), value.alias("value"))
    head = F.when(F.col("song_id") % 2 == 0, "phrase_id\tsurface\treading\tnote_count").otherwise("reading\tsurface\tnote_count")
    heads = notes.select("song_id").distinct().select(F.col("song_id").alias("file"), F.lit(1).cast("bigint").alias("line"), head.alias("value"))
    return rd.parse_lyrics_tsv(heads.unionByName(body), refine(t.hot_songs, body, ["file"]))


@query("""SELECT p_brand AS file, CASE WHEN p_partkey % 5 = 1 THEN p_name ELSE split_part(p_name, ' ', 1) END AS key,
      CASE WHEN p_partkey % 5 = 1 THEN p_type || ' ' || p_size ELSE split_part(p_name, ' ', 2) END AS value, p_partkey + 1 AS position
    FROM part WHERE p_partkey % 5 IN (1, 2)""")
def dictionary_lines(t: Tables):
    """One dictionary per brand: comments, tab lines, blank-separated lines, blank lines, lines of one word."""
    k = F.col("p_partkey") % 5
    value = F.when(k == 0, F.concat(F.lit("  # "), "p_name")).when(k == 1, F.concat("p_name", F.lit("\t"), "p_type", F.lit("   "), TEXT("p_size")))
    value = value.when(k == 2, F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("   ")))).when(k == 3, "   ").otherwise(F.replace("p_name", F.lit(" "), F.lit("_")))
    lines = t.read("part").select(F.col("p_brand").alias("file"), (F.col("p_partkey") + 1).alias("line"), value.alias("value"))
    return rd.parse_dictionary(lines).select("file", "key", "value", "position")


SQUEEZED = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"


def _listed(t: Tables):
    """One list per source: the text may hold bars; some lines lack a field or a speaker."""
    k = F.col("doc_id") % 13
    body = F.concat(F.trim(F.regexp_replace("text", r"\s+", " ")), F.lit("|end"))
    audio = F.concat(F.lit("a/"), TEXT("doc_id"), F.lit(".wav"))
    value = F.when(k == 0, F.concat_ws("|", audio, "source", "lang")).when(k == 1, F.concat_ws("|", audio, F.lit(" "), "lang", body)).otherwise(F.concat_ws("|", audio, "source", "lang", body))
    return t.read("documents").select(F.col("source").alias("file"), (F.col("doc_id") + 1).alias("line"), value.alias("value"))


@query(f"""SELECT source AS file, doc_id + 1 AS line, 'a/' || doc_id || '.wav' AS audio_path, source AS speaker, lang AS language, md5({SQUEEZED} || '|end') AS text_md5
    FROM documents WHERE doc_id % 13 > 1 AND upper(lang) = 'EN'""")
def list_lines(t: Tables):
    return rd.parse_list(_listed(t), "EN")[0].withColumn("text_md5", F.md5("text")).drop("text")


@query("""WITH marked AS (SELECT source AS file, doc_id + 1 AS line, CASE WHEN doc_id % 13 = 0 THEN 'FIELD_COUNT' WHEN doc_id % 13 = 1 THEN 'BLANK_FIELD' WHEN upper(lang) <> 'EN' THEN 'LANGUAGE' END AS reason FROM documents)
    SELECT file, line, reason FROM marked WHERE reason IS NOT NULL
    UNION ALL SELECT file, NULL, 'TOO_FEW_ROWS' FROM marked GROUP BY file HAVING count(*) - count(reason) < 12""")
def list_line_issues(t: Tables):
    lines = _listed(t)
    good, bad = rd.parse_list(lines, "EN")
    few = rd.short_lists(good, lines.select("file").distinct(), 12).select("file", F.lit(None).cast("bigint").alias("line"), F.lit("TOO_FEW_ROWS").alias("reason"))
    return bad.unionByName(few)


def _json_lines(t: Tables):
    k = F.col("event_id") % 7
    value = F.when(k == 0, "[1, 2]").when(k == 1, '{"k": ').when(k == 2, "null").when(k == 3, "").otherwise(F.col("props"))
    return t.read("events").select(F.col("user_id").alias("file"), F.col("event_id").alias("line"), value.alias("value"))


@query("SELECT song_id AS file, event_id AS line, k FROM ev WHERE event_id % 7 > 3")
def json_lines(t: Tables):
    return rd.parse_jsonl(_json_lines(t), "struct<k:bigint>")[0]


@query("SELECT song_id AS file, event_id AS line, CASE event_id % 7 WHEN 1 THEN 'INVALID_JSON' ELSE 'NOT_AN_OBJECT' END AS reason FROM ev WHERE event_id % 7 < 3")
def json_line_issues(t: Tables):
    return rd.parse_jsonl(_json_lines(t), "struct<k:bigint>")[1]


@query("""WITH lines AS (SELECT c_nationkey AS part, c_custkey + 1 AS line, CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 9 = 1 THEN 'id,name' ELSE c_custkey || ',' || c_name END AS value FROM customer
      UNION ALL SELECT DISTINCT c_nationkey, 0, 'id,name' FROM customer)
    SELECT part, line, value FROM lines WHERE value <> '' AND (value <> 'id,name' OR (part, line) = (SELECT (min(part), 0) FROM lines))""")
def merged_parts(t: Tables):
    """One part per nation, each with a header; blank lines and repeated headers go."""
    c = t.read("customer")
    value = F.when(F.col("c_custkey") % 9 == 0, " ").when(F.col("c_custkey") % 9 == 1, "id,name").otherwise(F.concat_ws(",", TEXT("c_custkey"), "c_name"))
    body = c.select(F.col("c_nationkey").cast("bigint").alias("file"), (F.col("c_custkey") + 1).alias("line"), value.alias("value"))
    heads = body.select("file").distinct().select("file", F.lit(0).cast("bigint").alias("line"), F.lit("id,name").alias("value"))
    return rd.merge_lines(heads.unionByName(body))


# -- whole documents ------------------------------------------------------------------


@query(r"""WITH d AS (SELECT *, song % 90 * 3600000 + start_ms % 3600000 AS s, trim(regexp_replace(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '<[^>]+>', '', 'g'), ' +', ' ', 'g')) AS plain FROM captions)
    SELECT song, id, md5('あ ' || plain) AS text_md5, CASE WHEN id % 3 = 0 THEN 'tr ' || song END AS translation, s / 1e3 AS start, (s + duration_ms) / 1e3 AS "end", duration_ms / 1e3 AS duration
    FROM d WHERE id % 5 <> 1 AND id % 7 <> 3 AND id % 11 <> 5""")
def srt_captions(t: Tables):
    """One SRT text per turn: captions without kana, without a time line, or that end as they start, go."""
    return _srt(t)[0]


@query("SELECT song, id FROM captions WHERE id % 5 <> 1 AND id % 7 = 3 AND id % 11 <> 5")
def srt_bad_captions(t: Tables):
    return _srt(t)[1]


def _srt(t: Tables):
    clock = lambda ms: F.concat(
        F.lpad(F.floor(ms / 3_600_000).cast("string"), 2, "0"), F.lit(":"), F.lpad((F.floor(ms / 60_000) % 60).cast("string"), 2, "0"), F.lit(":"),
        F.lpad((F.floor(ms / 1000) % 60).cast("string"), 2, "0"), F.lit(","), F.lpad((ms % 1000).cast("string"), 3, "0"),
    )
    start = F.col("song") % 90 * 3_600_000 + F.col("start_ms") % 3_600_000
    end = F.when(F.col("id") % 7 == 3, start).otherwise(start + F.col("duration_ms"))
    said = F.concat(F.when(F.col("id") % 5 == 1, "a ").otherwise("<i>あ </i>"), F.regexp_replace("text", r"\s+", " "))
    time = F.when(F.col("id") % 11 == 5, "no time").otherwise(F.concat(clock(start), F.lit(" --> "), clock(end)))
    lines = F.concat_ws("\r\n", TEXT("id"), time, F.when(F.col("id") % 3 == 0, F.concat(F.lit("tr "), TEXT("song"))), said)
    text = F.concat(F.lit("﻿not a caption\r\n\r\n"), lines, F.lit("\r\n\r\n"))
    docs = t.captions().select("song", F.col("id").alias("turn"), text.alias("value"))
    good, bad = rd.parse_srt(docs)
    return good.select("song", "id", F.md5("text").alias("text_md5"), "translation", "start", "end", "duration"), bad.select("song", "id")


GRID = """g AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY line, part, supp, cents) AS pos, note_dur, unit, note_slur FROM item_elements)"""


def _grids(t: Tables):
    """A TextGrid per order: a tier of words, and one of phones but in every seventh order."""
    e = t.item_elements()
    row = F.struct("line", "part", "supp", "cents", "note_dur", "unit", "note_slur")
    docs = e.groupBy("item_id").agg(F.array_sort(F.collect_list(row)).alias("e"))

    def interval(x, i):
        label = F.when(x["note_slur"] == 0, "").otherwise(F.concat(x["unit"], F.lit(r"\"x")))
        return F.concat(
            F.lit("        intervals ["), (i + 1).cast("string"), F.lit("]:\n            xmin = "), i.cast("string"), F.lit("\n            xmax = "),
            (i + x["note_dur"]).cast("string"), F.lit('\n            text = "'), label, F.lit('" \n'),
        )

    tier = lambda n, name: F.concat(F.lit(f'    item [{n}]:\n        class = "IntervalTier"\n        name = "{name}"\n'), F.array_join(F.transform("e", interval), ""))
    head = F.lit('File type = "ooTextFile"\nitem []:\n')
    text = F.when(F.col("item_id") % 7 == 0, F.concat(head, tier(1, "words"))).otherwise(F.concat(head, tier(1, "words"), tier(2, "phones")))
    return docs.select("item_id", text.alias("value"))


@query(f"""WITH {GRID} SELECT item_id, pos, CAST(pos - 1 AS DOUBLE) AS start, CAST(pos - 1 + note_dur AS DOUBLE) AS "end", CASE WHEN note_slur = 0 THEN '' ELSE unit || '"x' END AS text
    FROM g WHERE item_id % 7 <> 0""")
def textgrid_tier(t: Tables):
    return rd.parse_textgrid(_grids(t), "phones", include_empty=True).withColumn("pos", F.col("pos").cast("bigint"))


@query("SELECT DISTINCT item_id FROM item_elements WHERE item_id % 7 = 0")
def textgrid_missing_tiers(t: Tables):
    return rd.missing_tiers(_grids(t), "phones")


@query(f"WITH {GRID} SELECT item_id, pos - 1 AS pos, note_dur, unit FROM g")
def json_items(t: Tables):
    """An array per order, or an object that wraps it; every element with its position."""
    row = F.struct("line", "part", "supp", "cents", "note_dur", "unit")
    docs = t.item_elements().groupBy("item_id").agg(F.array_sort(F.collect_list(row)).alias("e"))
    items = F.to_json(F.transform("e", lambda x: F.struct(x["note_dur"].alias("note_dur"), x["unit"].alias("unit"))))
    value = F.when(F.col("item_id") % 2 == 0, items).otherwise(F.concat(F.lit('{"made_by": "x", "items": '), items, F.lit("}")))
    found = rd.parse_json_items(docs.select(F.col("item_id").alias("file"), value.alias("value")), "struct<note_dur:bigint,unit:string>")
    return found.select(F.col("file").alias("item_id"), F.col("pos").cast("bigint").alias("pos"), "item.note_dur", "item.unit")


@query("SELECT c_custkey // 20 AS file, CAST(c_custkey AS VARCHAR) AS song_id, c_mktsegment AS segment, c_nationkey AS nation FROM customer")
def song_maps(t: Tables):
    """Reports of twenty customers each, as a map under ``songs``."""
    entry = F.struct(TEXT("c_custkey").alias("key"), F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")).alias("value"))
    docs = t.read("customer").groupBy(F.expr("c_custkey div 20").alias("file")).agg(F.map_from_entries(F.collect_list(entry)).alias("m"))
    value = F.concat(F.lit('{"songs": '), F.to_json("m"), F.lit("}"))
    return rd.parse_song_maps(docs.select("file", value.alias("value")), "struct<segment:string,nation:int>").select("file", "song_id", "report.segment", "report.nation")


@query("""SELECT item_id, count(*) AS phones, sum(ph_dur) / 4.0 AS ph_total, sum(note_dur) / 2.0 AS note_total, sum(note_slur) AS slurs, max_by(unit, (line, part, supp, cents)) AS last_phone
    FROM item_elements GROUP BY item_id""")
def score_documents(t: Tables):
    """Sequence strings with blank runs, parsed to arrays."""
    row = F.struct("line", "part", "supp", "cents", "note_dur", "ph_dur", "note_slur", "unit")
    docs = t.item_elements().groupBy("item_id").agg(F.array_sort(F.collect_list(row)).alias("e"))
    seq = lambda f: F.concat(F.lit(" "), F.array_join(F.transform("e", f), "  "))
    items = docs.select(
        "item_id", seq(lambda x: x["unit"]).alias("ph_seq"), seq(lambda x: (x["ph_dur"] / 4).cast("string")).alias("ph_dur"),
        seq(lambda x: (x["note_dur"] / 2).cast("string")).alias("note_dur"), seq(lambda x: x["note_slur"].cast("string")).alias("note_slur"),
    )
    p = rd.parse_score_items(items)
    slurs = F.aggregate("note_slur", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return p.select("item_id", F.size("ph_seq").cast("bigint").alias("phones"), fn.total(F.col("ph_dur")).alias("ph_total"), fn.total(F.col("note_dur")).alias("note_total"), slurs.alias("slurs"), F.element_at("ph_seq", -1).alias("last_phone"))


@query("""WITH f AS (SELECT page_id // 4 AS job, 'in/' || page_id || CASE page_id % 6 WHEN 0 THEN '.TXT' WHEN 1 THEN '.csv' WHEN 2 THEN '.tsv' WHEN 3 THEN '.mid' WHEN 4 THEN '.midi' ELSE '.log' END AS path, page_id % 6 AS k FROM pages),
    p AS (SELECT job, path, CASE WHEN k < 3 THEN 'lyrics' ELSE 'notes' END AS kind, CASE k WHEN 2 THEN 0 WHEN 1 THEN 1 WHEN 0 THEN 2 WHEN 3 THEN 0 ELSE 1 END AS rank FROM f WHERE k < 5)
    SELECT job, kind, min_by(path, (rank, path)) AS path FROM p GROUP BY job, kind""")
def job_inputs(t: Tables):
    """Four files a job; of one kind the suffix that comes first in its list is taken."""
    ends = {0: ".TXT", 1: ".csv", 2: ".tsv", 3: ".mid", 4: ".midi"}
    end = F.coalesce(F.try_element_at(fn.literal_map(ends), (F.col("page_id") % 6).cast("int")), F.lit(".log"))
    files = t.read("pages").select("page_id", F.concat(F.lit("in/"), TEXT("page_id"), end).alias("path"))
    return rd.discover_inputs(files, {"lyrics": [".tsv", ".csv", ".txt"], "notes": [".mid", ".midi"]}, F.expr("page_id div 4"), F.col("path"))


# -- scalars --------------------------------------------------------------------------


@query("""WITH s AS (SELECT event_id, k, 36 + k % 60 AS midi, CASE WHEN k % 3 = 0 THEN 'rest' ELSE list_extract(['C','C#','D','Eb','E','F','F#','G','Ab','A','Bb','B'], CAST(k % 12 + 1 AS INT)) || ((36 + k % 60) // 12 - 1) || CASE WHEN k % 4 = 1 THEN '+15.5' ELSE '' END END AS name FROM ev)
    SELECT event_id, name, CASE WHEN k % 3 <> 0 THEN midi END AS midi, CASE WHEN k % 3 <> 0 THEN 440 * pow(2, (midi - 69) / 12.0) END AS hz, CASE WHEN k % 3 <> 0 THEN CAST(midi AS DOUBLE) END AS again FROM s""")
def pitch_names(t: Tables):
    """Note names with flats, sharps and cents to numbers, to Hz and back."""
    letters = F.array(*[F.lit(x) for x in ("C", "C#", "D", "Eb", "E", "F", "F#", "G", "Ab", "A", "Bb", "B")])
    k, midi = F.col("k"), 36 + F.col("k") % 60
    name = F.concat(F.get(letters, k % 12), (F.floor(midi / 12) - 1).cast("string"), F.when(k % 4 == 1, "+15.5").otherwise(""))
    rows = t.timed_events().select("event_id", F.when(k % 3 == 0, "rest").otherwise(name).alias("name"))
    rows = rows.withColumn("midi", fn.note_to_midi(F.col("name"))).withColumn("hz", fn.midi_to_hz(F.col("midi")))
    return rows.withColumn("again", F.round(fn.hz_to_midi(F.col("hz")), 6))


@query("""SELECT event_id, CAST(round_even(value * 44100, 0) AS BIGINT) AS sample, CAST(round_even(value * 100 / 8, 0) AS BIGINT) AS eighth FROM events""")
def sample_times(t: Tables):
    """Seconds to samples, halves to even."""
    v = F.col("value")
    return t.read("events").select("event_id", fn.to_sample(v).alias("sample"), fn.to_sample(v * 100 / 8, 1).alias("eighth"))


@query("""SELECT event_id, CASE WHEN event_id % 6 < 2 THEN value END AS number, CASE WHEN event_id % 6 < 2 THEN value ELSE -1.0 END AS defaulted FROM events""")
def safe_numbers(t: Tables):
    """Numbers as text, among words, NaN and infinities."""
    k = F.col("event_id") % 6
    text = F.when(k == 0, TEXT("value")).when(k == 1, F.concat(F.lit(" "), TEXT("value"), F.lit(" "))).when(k == 2, "NaN").when(k == 3, "-Infinity").when(k == 4, F.col("event_type"))
    return t.read("events").select("event_id", fn.safe_double(text).alias("number"), fn.safe_double(text, -1.0).alias("defaulted"))


@query("""SELECT p_partkey, sha256('{"p_brand":"' || p_brand || '","p_name":"' || p_name || '","p_partkey":' || p_partkey || ',"p_size":' || p_size || '}') AS digest FROM part""")
def canonical_records(t: Tables):
    """Digest of the JSON text whose keys stand in name order."""
    return t.read("part").select("p_partkey", F.sha2(fn.canonical_json("p_size", "p_name", "p_partkey", "p_brand"), 256).alias("digest"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'rec' || p_size WHEN 1 THEN 'v1.' || p_size WHEN 2 THEN 'take' || p_size ELSE '.wav' END AS recording_group,
      CASE p_partkey % 4 WHEN 0 THEN 'rec' || p_size || '_32k_mono.wav_' || p_partkey WHEN 1 THEN 'v1.' || p_size || '.flac' WHEN 2 THEN 'take' || p_size ELSE '' END AS stem FROM part""")
def file_stems(t: Tables):
    """Recording groups by marker or name, and names without their folder and suffix."""
    k, size = F.col("p_partkey") % 4, TEXT("p_size")
    name = F.when(k == 0, F.concat(F.lit("rec"), size, F.lit("_32k_mono.wav_"), TEXT("p_partkey"), F.lit(".wav"))).when(k == 1, F.concat(F.lit("a/v1."), size, F.lit(".flac")))
    name = name.when(k == 2, F.concat(F.lit("a/b.c/take"), size, F.lit(".wav"))).otherwise(".wav")
    return t.read("part").select("p_partkey", fn.recording_group(name).alias("recording_group"), fn.wav_stem(name).alias("stem"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN p_size END AS epoch, CASE WHEN p_partkey % 3 < 2 THEN p_partkey * 100 END AS step FROM part""")
def checkpoint_names(t: Tables):
    """Epoch and step from file names; other names give nulls."""
    k = F.col("p_partkey") % 3
    tail = F.concat(F.lit("_e"), TEXT("p_size"), F.lit("_s"), TEXT("p_partkey"), F.lit("00.pth"))
    name = F.when(k == 0, F.concat(F.lit("voice"), tail)).when(k == 1, F.concat(F.lit("a_e/b"), tail)).otherwise(F.concat(F.lit("voice_e"), TEXT("p_size"), F.lit("-s5.pth")))
    return t.read("part").select("p_partkey", fn.checkpoint_numbers(name).alias("n")).select("p_partkey", F.col("n.epoch").alias("epoch"), F.col("n.step").alias("step"))


@query("""SELECT event_id, array_to_string(list_transform(list_filter(['i:', event_type, '', 'sil', 'o:', 'k' || k], lambda x: x <> ''),
      lambda x: CASE x WHEN 'i:' THEN 'i' WHEN 'sil' THEN 'SP' WHEN 'o:' THEN 'o' ELSE x END), ' ') AS phones, event_type IN ('view', 'click') AS settled FROM ev""")
def phone_aliases(t: Tables):
    """Spellings of one phone are made equal; blank phones go; states count as settled by word."""
    raw = F.array(F.lit(" i: "), F.col("event_type"), F.lit("  "), F.lit("sil"), F.lit("o:"), F.concat(F.lit("k"), TEXT("k")))
    state = F.when(F.col("event_type") == "view", "resolved").when(F.col("event_type") == "click", "waived").otherwise("pending")
    return t.timed_events().select("event_id", F.array_join(fn.canonical_phones(raw), " ").alias("phones"), state.isin(*fn.ACCEPTED_STATUSES).alias("settled"))


@query("""WITH r AS (SELECT doc_id, trim(source) AS key FROM documents WHERE doc_id % 5 <> 0 UNION ALL SELECT doc_id, 'doc-' || doc_id FROM documents WHERE doc_id % 5 = 0)
    SELECT key, count(*) AS rows, count(*) > 1 AS twice FROM r GROUP BY key""")
def keyed_rows(t: Tables):
    """Rows by a key or, where it is blank, by a fallback; which keys occur twice."""
    docs = t.read("documents").select("doc_id", F.when(F.col("doc_id") % 5 == 0, "  ").otherwise(F.col("source")).alias("key"), F.concat(F.lit("doc-"), TEXT("doc_id")).alias("fallback"))
    good, twice = rd.keyed_table(docs, "key", "fallback")
    marked = good.groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    return marked.join(twice.select("key", F.lit(True).alias("twice")), "key", "left").fillna(False, ["twice"])

