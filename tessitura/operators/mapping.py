"""Phrases to notes: proportional note counts, phone groups, slurs, structural contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import without_pauses
from .folds import realign_counts
from .intervals import asof
from .manifest import all_reasons, allocate, slices
from .scans import previous, refine, row_number, running_max, scan

SONG = ["song_id"]
REST_GAP_US, LARGE_GAP_US = 250_000, 500_000


def note_counts(phrases: DataFrame, notes: DataFrame, verified_gaps: DataFrame | None = None, hot=None) -> DataFrame:
    """Notes per phrase in proportion to its phones, moved off verified rests where there is room.

    ``phrases``: song_id, phrase, phones (array). A song with fewer notes than phrases
    gets null counts.
    """
    weights = phrases.select("song_id", "phrase", "phones", F.greatest(F.lit(1), F.size(without_pauses(F.col("phones")))).cast("bigint").alias("weight"))
    totals = notes.groupBy("song_id").agg(F.count(F.lit(1)).alias("total"))
    counted = allocate(weights, totals, SONG, "phrase", "weight", hot).select("song_id", "phrase", "phones", F.col("allocated").alias("note_count"))
    if verified_gaps is None:
        return counted.withColumn("realigned", F.lit(False))
    sized = counted.where("note_count is not null").select("song_id", "phrase", F.col("note_count").alias("count"), F.size("phones").cast("bigint").alias("phones"))
    moved = realign_counts(sized, verified_gaps, hot).where("kind = 'COUNT'").select("song_id", "phrase", F.col("value").alias("moved_count"))
    both = counted.join(moved, ["song_id", "phrase"], "left")
    return both.select(
        "song_id", "phrase", "phones", F.coalesce("moved_count", "note_count").alias("note_count"),
        F.coalesce(F.col("moved_count") != F.col("note_count"), F.lit(False)).alias("realigned"),
    )


def assign_notes(counts: DataFrame, notes: DataFrame, hot=None, hot_notes=None) -> DataFrame:
    """Every note with its phrase, place in the phrase, phone group and slur.

    Phones are spread evenly, the first notes take one more; a phrase with fewer phones
    than notes gives empty groups.
    """
    cut = slices(counts.where("note_count > 0"), SONG, ["phrase"], "note_count", hot)
    found = asof(notes, cut, SONG, "note_index", "slice_from", ["phrase", "phones", "note_count", "slice_from", "slice_to"], hot=hot_notes)
    inside = found.where(F.col("note_index") < F.col("mark.slice_to"))
    at = (F.col("note_index") - F.col("mark.slice_from")).alias("phrase_index")
    rows = inside.select(*notes.columns, F.col("mark.phrase").alias("phrase"), at, F.size("mark.phones").cast("bigint").alias("n_phones"), F.col("mark.note_count").alias("note_count"), F.col("mark.phones").alias("phones"))
    each, more = F.expr("n_phones div note_count"), F.expr("n_phones % note_count")
    size = (each + F.when(F.col("phrase_index") < more, 1).otherwise(0)).cast("int")
    begin = (F.col("phrase_index") * each + F.least("phrase_index", more) + 1).cast("int")
    group = F.when(F.col("n_phones") >= F.col("note_count"), F.slice("phones", begin, size)).otherwise(F.array().cast("array<string>"))
    slur = F.when((F.col("phrase_index") == 0) | (F.lower(F.coalesce(F.col("note").cast("string"), F.lit(""))) == "rest") if "note" in notes.columns else F.col("phrase_index") == 0, 0).otherwise(1)
    out = rows.withColumns({"phone_group": group, "phone_count": F.size(group).cast("bigint"), "note_slur": slur.cast("bigint")})
    return out.drop("phones", "n_phones", "note_count")


def mapping_issues(assigned: DataFrame, counts: DataFrame, notes: DataFrame, hot=None) -> DataFrame:
    """``song_id, type, phrase, boundary_index`` of the mapping."""
    pair = scan(assigned, SONG, ["note_index"], [previous("l", F.struct("phrase", "end_us"))], hot)
    gap = F.col("start_us") - F.col("l.end_us")
    same = F.col("phrase") == F.col("l.phrase")
    kind = F.when(same & (gap < 0), "MIDI_NOTE_OVERLAP").when(same & (gap >= LARGE_GAP_US), "INTRA_PHRASE_MIDI_GAP")
    kind = kind.when(~same & (gap >= REST_GAP_US), "REST_BOUNDARY_DETECTED")
    inner = pair.select("song_id", kind.alias("type"), "phrase", F.col("note_index").alias("boundary_index")).where("type is not null")
    short = counts.where(F.size("phones") < F.col("note_count")).select("song_id", F.lit("PHONE_NOTE_GROUPING_FAILED").alias("type"), "phrase", F.lit(None).cast("bigint").alias("boundary_index"))
    failed = counts.where("note_count is null").select("song_id", F.lit("NOTE_ALLOCATION_FAILED").alias("type"), F.lit(None).cast("bigint").alias("phrase"), F.lit(None).cast("bigint").alias("boundary_index")).distinct()
    free = notes.join(assigned, ["song_id", "note_index"], "left_anti").groupBy("song_id").agg(F.count(F.lit(1)).alias("n"))
    left = free.select("song_id", F.lit("UNASSIGNED_MIDI_NOTES").alias("type"), F.lit(None).cast("bigint").alias("phrase"), F.col("n").alias("boundary_index"))
    return inner.unionByName(short).unionByName(failed).unionByName(left)


def mapping_contract(assigned: DataFrame, notes: DataFrame, eps: int = 0, hot=None) -> DataFrame:
    """Per song: the structural checks of a mapping, as the list of failed ones."""

    rows = scan(assigned, SONG, ["note_index"], [running_max("__reach", F.col("end_us")), previous("__note", F.col("note_index"))], hot)
    per_phrase = assigned.groupBy("song_id", "phrase").agg(
        F.min_by("note_slur", "phrase_index").alias("first"), F.count_if(F.col("note_slur") == 0).alias("words")
    ).groupBy("song_id").agg(F.count_if(F.col("first") != 0).alias("bad_first"), F.count_if(F.col("words") != 1).alias("bad_words"))
    timing = (F.col("start_us") < 0) | (F.col("end_us") <= F.col("start_us")) | (F.col("start_us") < F.col("__reach") - eps)
    facts = rows.groupBy("song_id").agg(
        F.count(F.lit(1)).alias("assigned"), F.count_if(timing).alias("bad_timing"), F.min("note_index").alias("lo"), F.max("note_index").alias("hi"),
        F.count_if(F.col("note_index") == F.col("__note")).alias("twice"),
    )
    size = notes.groupBy("song_id").agg(F.count(F.lit(1)).alias("note_count"))
    both = size.join(facts, "song_id", "left").join(per_phrase, "song_id", "left")
    covered = (F.col("assigned") == F.col("note_count")) & (F.col("twice") == 0) & (F.col("lo") == 0) & (F.col("hi") == F.col("note_count") - 1)
    rules = {
        "MAPPING_OR_ASSIGNMENT_MISSING": F.col("assigned").isNull(), "NOTE_INDEX_COVERAGE_INVALID": ~covered & F.col("assigned").isNotNull(),
        "NOTE_SLUR_FIRST_INVALID": F.col("bad_first") > 0, "NOTE_SLUR_WORD_MISMATCH": F.col("bad_words") > 0, "NOTE_TIMING_INVALID": F.col("bad_timing") > 0,
    }
    return both.select("song_id", "note_count", F.coalesce("assigned", F.lit(0)).alias("assigned"), all_reasons(rules).alias("errors"))


def score_skeleton(assigned: DataFrame, phrases: DataFrame, note: str = "pitch") -> DataFrame:
    """Score items from a mapping: one item per phrase, sequences in note order.

    A phrase is one lyric unit of a few notes, so its sequences are short arrays.
    """
    by = F.array_sort(F.collect_list(F.struct("note_index", F.col(note).cast("string").alias("note"), (F.col("end_us") - F.col("start_us")).alias("dur"), "note_slur")))
    items = assigned.groupBy("song_id", "phrase").agg(F.min("start_us").alias("offset_us"), by.alias("n"))
    pick = lambda f: F.array_join(F.transform("n", lambda x: x[f].cast("string")), " ")
    rows = items.join(phrases.select("song_id", "phrase", "phones"), ["song_id", "phrase"])
    return rows.select(
        "song_id", "phrase", "offset_us", F.array_join("phones", " ").alias("ph_seq"), F.size("phones").cast("string").alias("ph_num"),
        pick("note").alias("note_seq"), pick("dur").alias("note_dur_us"), pick("note_slur").alias("note_slur"), F.transform("n", lambda x: x["note_index"]).alias("source_note_indices"),
    )


def boundary_owner(assigned: DataFrame, hot=None) -> DataFrame:
    """``song_id, boundary_index, phrase``: the phrase that owns the notes on both sides of a boundary."""
    rows = scan(assigned, SONG, ["note_index"], [previous("l", F.struct("phrase", "note_index"))], hot)
    both = (F.col("l.phrase") == F.col("phrase")) & (F.col("l.note_index") == F.col("note_index") - 1)
    return rows.where(both).select("song_id", F.col("note_index").alias("boundary_index"), "phrase")


def zip_words(words: DataFrame, items: DataFrame, windows: DataFrame, hot=None):
    """Words and items of each window paired by place and shifted by the window start.

    ``words``: window, at, end (relative, ordered by at). ``items``: window, item. ``windows``:
    window, w_start. Windows whose counts differ give an issue and no spans.
    Returns (spans, issues).
    """
    place = lambda rows, by: scan(rows, ["window"], by, [row_number("place")], refine(hot, rows, ["window"]))
    n = words.select("window", F.lit(1).alias("w"), F.lit(0).alias("i")).unionByName(items.select("window", F.lit(0).alias("w"), F.lit(1).alias("i")))
    counts = n.groupBy("window").agg(F.sum("w").alias("words"), F.sum("i").alias("items"))
    odd = counts.where("words <> items").select("window", F.lit("TIMING_WORD_ITEM_COUNT_MISMATCH").alias("type"), F.lit(None).cast("bigint").alias("item"))
    both = place(words, ["at", "end"]).join(place(items, ["item"]), ["window", "place"]).join(odd.select("window"), "window", "left_anti").join(windows, "window")
    spans = both.select("window", "item", (F.col("w_start") + F.col("at")).alias("start"), (F.col("w_start") + F.col("end")).alias("end"))
    bad = spans.where("end <= start").select("window", F.lit("TIMING_WORD_SPAN_NON_POSITIVE").alias("type"), "item")
    return spans.where("end > start"), odd.unionByName(bad)
