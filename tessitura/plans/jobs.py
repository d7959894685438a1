"""Jobs: whole-corpus compositions of the operators, one DataFrame plan per stage.

Where the work is one song at a time, the song is a key of every plan. Inputs and results
are tables; writing goes through ``sinks.publish``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import models
from ..functions import scalar as fn
from ..operators import consensus as cs
from ..operators import evidence as ev
from ..operators import folds
from ..operators import intervals as iv
from ..operators import issues as iss
from ..operators import manifest as mf
from ..operators import mapping as mp
from ..operators import sequences as sq
from ..operators import windows as wn
from ..operators.contracts import resolve_model_files
SONG = ["song_id"]


def speech_import(named: DataFrame, wavs: DataFrame, train: int = 100, bench: int = 3, rate: int = 32_000):
    """Texts with audio become manifest rows with a split. Returns (manifest, errors).

    ``named``: line, audio_name, text. ``wavs``: audio_name, header columns, sha256.
    """
    both = named.join(wavs, "audio_name", "left")
    wav = (F.col("sample_rate") == rate) & (F.col("channels") == 1) & (F.col("bit_depth") == 16)
    bad = F.when(F.col("frames").isNull(), "AUDIO_MISSING_OR_UNREADABLE").when(~F.coalesce(wav, F.lit(False)), "AUDIO_FORMAT")
    marked = both.withColumn("reason", bad)
    good = marked.where("reason is null").withColumn("duration_sec", F.col("frames") / F.col("sample_rate"))
    split = mf.rank_limited_split(good, "line", "duration_sec", train, bench, 3, 10)
    ids = mf.sequential_ids(split, ["line"], "original-")
    rows = ids.select(
        F.col("seq_id").alias("id"), F.concat(F.lit("audio/"), F.col("audio_name")).alias("audio_relpath"), fn.recording_group(F.col("audio_name")).alias("recording_group"),
        "text", F.lit("JA").alias("language"), "duration_sec", "sample_rate", "channels", "sha256", F.col("assigned").alias("split"), "enough",
    )
    return rows, marked.where("reason is not null").select("line", "audio_name", "reason")


def clip_build(clips: DataFrame, songs: DataFrame, known: DataFrame | None = None, confirmed: str = "confirmed") -> DataFrame:
    """Every clip with the reason it is rejected for, or none. ``known`` clip ids are left out."""
    fresh = clips.join(known.select("clip_id"), "clip_id", "left_anti") if known is not None else clips
    reviewed = mf.review_reasons(fresh, confirmed).withColumnRenamed("reject_reason", "review_reason")
    built = mf.build_reasons(reviewed, songs)
    register = F.when(F.col("f0_median_hz") >= 350, "high").otherwise("mid_low") if "f0_median_hz" in clips.columns else F.lit(None).cast("string")
    return built.withColumns({"reject_reason": F.coalesce("review_reason", "reject_reason"), "register": register}).drop("review_reason")


def freeze(windows: DataFrame, songs: DataFrame, files: DataFrame, eps: int = 1):
    """Accepted and rejected windows of known songs, range errors, and source differences.

    ``songs``: song_id, path, sha256, extent. Returns (accepted, rejected, issues, differences).
    """
    rows = windows.join(songs.select("song_id", "extent"), SONG, "left")
    bad = F.when(F.col("extent").isNull(), "SONG_MISSING").when((F.col("start_us") < 0) | (F.col("end_us") <= F.col("start_us")), "WINDOW_RANGE")
    rows = rows.withColumn("issue", bad.when(F.col("end_us") > F.col("extent") + eps, "WINDOW_BEYOND_SOURCE"))
    ok = rows.where("issue is null").drop("issue", "extent")
    differences = mf.integrity(files, songs.select("path", "sha256"), "path", ["sha256"])
    return ok.where("status = 'accepted'"), ok.where("status <> 'accepted'"), rows.where("issue is not null").select("song_id", "clip_id", "issue"), differences


def note_mapping(phrases: DataFrame, notes: DataFrame, windows: DataFrame, evidence: DataFrame | None = None, hot=None, hot_notes=None):
    """Mapped notes and issues. Gaps outside the accepted windows block nothing; verified rests
    (evidence status REST_CANDIDATE) move notes. Returns (assigned, issues, counts)."""
    gaps = iv.adjacent_gaps(notes, SONG, ["note_index"], mp.LARGE_GAP_US, hot=hot_notes)
    spans = gaps.select("song_id", "boundary_index", F.col("gap_start").alias("start_us"), F.col("gap_end").alias("end_us"))
    active = iv.overlapping_any(spans, iv.union(windows, SONG, hot=hot_notes), SONG, hot=hot_notes).where("overlaps").drop("overlaps")
    verified, found = None, None
    if evidence is not None:
        judged = active.join(evidence.select("song_id", "boundary_index", "status"), ["song_id", "boundary_index"], "left")
        verified = judged.where("status = 'REST_CANDIDATE'").select("song_id", "boundary_index")
        kind = F.when(F.col("status") == "VOCAL_EVIDENCE", "MIDI_GAP_AUDIO_CONFLICT").otherwise("MIDI_GAP_AUDIO_EVIDENCE_INSUFFICIENT")
        found = judged.where("status is null or status <> 'REST_CANDIDATE'").select("song_id", kind.alias("type"), F.lit(None).cast("bigint").alias("phrase"), "boundary_index")
    counts = mp.note_counts(phrases, notes, verified, hot)
    assigned = mp.assign_notes(counts, notes, hot, hot_notes)
    issues = mp.mapping_issues(assigned, counts, notes, hot_notes)
    return assigned, issues if found is None else issues.unionByName(found), counts


def mapping_report(assigned: DataFrame, issues: DataFrame, counts: DataFrame) -> DataFrame:
    """Per song: phrases, mapped notes, blocking issues, DRAFT_READY or BLOCKED."""
    stops = iss.blocking(issues).where("blocking").groupBy("song_id").agg(F.count(F.lit(1)).alias("blocking_issues"))
    p = counts.groupBy("song_id").agg(F.count(F.lit(1)).alias("phrases"))
    n = assigned.groupBy("song_id").agg(F.count(F.lit(1)).alias("mapped_notes"))
    rows = p.join(n, SONG, "left").join(stops, SONG, "left").fillna(0, ["mapped_notes", "blocking_issues"])
    return rows.withColumn("status", F.when(F.col("blocking_issues") == 0, "DRAFT_READY").otherwise("BLOCKED"))


def gap_repair(notes: DataFrame, evidence: DataFrame, max_gap: int, hot=None):
    """Repair candidates and the notes with the candidates applied."""
    repairs = ev.repair_gaps(notes, evidence, max_gap, hot)
    ends = repairs.select("song_id", "note_index", "new_end")
    fixed = notes.join(ends, ["song_id", "note_index"], "left").withColumn("end_us", F.coalesce("new_end", "end_us")).drop("new_end")
    return repairs, fixed


def window_repair(notes: DataFrame, windows: DataFrame, bin_us: int, policy: str = "majority", hot=None):
    """Repaired windows, decisions, and the audit per song. A song passes when nothing is left open."""
    fixed, decisions = folds.repair_windows(notes, windows, bin_us, policy, hot=hot)
    audit = wn.song_audit(notes, fixed, hot=hot)
    opened = decisions.where("outcome = 'UNRESOLVED'").groupBy("song_id").agg(F.count(F.lit(1)).alias("unresolved"))
    report = audit.join(opened, SONG, "left").fillna(0, ["unresolved"])
    status = F.when((F.col("status") == "PASS") & (F.col("unresolved") == 0), "PASS").otherwise("BLOCKED")
    return fixed, decisions, report.withColumn("status", status)


def review_queue(reports: Sequence[DataFrame], contracts: DataFrame, crosscheck: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """One queue of all candidate issues.

    ``reports``: issue rows with position. ``contracts``: song_id, errors (null when the
    mapping passed, which waives its general review). ``crosscheck``: pronunciation rows
    still pending. Issues are normalised, de-duplicated and overlaid with decisions.
    """
    rows = None
    for r in reports:
        n = iss.normalize(r)
        rows = n if rows is None else rows.unionByName(n, allowMissingColumns=True)
    waived = contracts.where("errors is null").select("song_id")
    general = rows.where("type = 'AUTO_NOTE_MAPPING_REVIEW_REQUIRED'").join(waived, SONG, "left_anti")
    rows = rows.where("type <> 'AUTO_NOTE_MAPPING_REVIEW_REQUIRED'").unionByName(general)
    pending = crosscheck.select(
        "song_id", F.lit("g2p_crosscheck").alias("stage"), F.lit(iss.PRONUNCIATION_TYPE).alias("type"), F.col("phrase_id").alias("segment_id"),
        F.concat(F.lit("primary="), "primary_variant", F.lit("; secondary="), "secondary_variant").alias("proposed_value"), "position",
    )
    rows = rows.unionByName(iss.normalize(pending), allowMissingColumns=True)
    keep = [c for c in ("song_id", "stage", "type", "segment_id", "evidence", "proposed_value", "boundary_index") if c in rows.columns]
    queue = iss.deduplicate(rows, "position", keep)
    return iss.replay(queue, decisions) if decisions is not None else queue


def batch_repair(queue: DataFrame, gap_rows: DataFrame, notes: DataFrame, windows: DataFrame, percent: int = 5, hot=None):
    """Decide every root cause: extend a note, or cut the interval, within the prune budget.

    ``gap_rows``: song_id, boundary_index and the columns ``gap_action`` needs. Returns
    (decisions per root, repaired notes, cuts, budget per song).
    """
    roots = iss.roots(queue).where(F.col("type").isin(*iss.GAP_TYPES, *iss.DEPENDENT_TYPES))
    judged = ev.gap_action(gap_rows).select("song_id", "boundary_index", "status", "resolution_action")
    named = roots.withColumn("song_key", F.split_part("root_issue_id", F.lit(":"), F.lit(1)))
    hit = named.join(judged.withColumn("song_key", F.col("song_id").cast("string")), ["song_key", "boundary_index"], "left")
    action = F.coalesce("resolution_action", F.lit("PRUNE_INTERVAL"))
    decisions = hit.select("root_issue_id", "song_id", "boundary_index", action.alias("resolution_action"), F.sha2(F.concat_ws("|", "root_issue_id", action), 256).alias("artifact_sha256"))
    ready = decisions.where("song_id is not null").select("song_id", "boundary_index", F.col("resolution_action").alias("action"))
    fixed, cuts = ev.apply_decisions(notes, ready, hot)
    return decisions, fixed, cuts, wn.prune_budget(cuts, windows, percent, hot=hot)


def segment_plan(windows: DataFrame, exclusions: DataFrame, notes: DataFrame, min_piece: int, max_piece: int, eps: int = 0, hot=None):
    """Pieces with their elements, issues, pause candidates and the coverage contract."""
    pieces, pauses, effective = wn.plan_pieces(windows, exclusions, min_piece, eps, hot)
    elements = wn.window_elements(pieces, notes, eps, hot)
    key = ["song_id", "clip_id", "start_us"]
    sung = elements.where("kind = 'note'").select("song_id", "clip_id", F.col("piece_start").alias("start_us"), F.lit(None).cast("bigint").alias("end_us"), F.lit(1).alias("sung"))
    known = pieces.select(*key, "end_us", F.lit(0).alias("sung")).unionByName(sung).groupBy(*key).agg(F.max("end_us").alias("end_us"), F.max("sung").alias("sung"))
    size = F.col("end_us") - F.col("start_us")
    kind = F.when(F.col("sung") == 0, "ACCEPTED_COVERAGE_WITHOUT_NOTE").when(size > max_piece + eps, "WINDOW_HARD_LIMIT_EXCEEDED")
    issues = known.select(*key, "end_us", kind.when(size < min_piece - eps, "SHORT_WINDOW_AFTER_ACCEPTED_COVERAGE").alias("type")).where("type is not null")
    live = known.where("sung = 1")
    return elements, issues, pauses, wn.coverage_contract(windows, effective, live, eps, hot)


def pronunciation_candidates(lyrics: DataFrame, tokens: Column, allowed: Sequence[str], overrides: DataFrame | None = None) -> DataFrame:
    """Candidate entry per phrase from its raw tokens; an override replaces phones and is flagged.

    ``lyrics``: song_id, phrase_id, surface, reading. ``overrides``: key, value.
    """
    key = F.trim(F.coalesce(F.nullif("surface", F.lit("")), F.col("reading")))
    rows = lyrics.withColumns({"key": key, "raw_tokens": tokens, "latin_text": fn.has_latin(key)})
    rows = cs.map_tokens(rows, "raw_tokens", allowed, True)
    phones = F.filter("m.phones", lambda p: p != "SP")
    flags = F.when(F.col("latin_text"), F.array_union("m.review_flags", F.array(F.lit("latin_text")))).otherwise(F.col("m.review_flags"))
    rows = rows.withColumns({"phones": phones, "review_flags": flags, "unknown": F.filter("m.unknown", lambda p: p != "SP")}).drop("m")
    if overrides is not None:
        rows = rows.join(overrides.select("key", F.col("value").alias("__o")), "key", "left")
        forced = F.col("__o").isNotNull()
        rows = rows.withColumns({
            "phones": F.when(forced, fn.tokens(F.col("__o"))).otherwise(F.col("phones")),
            "review_flags": F.when(forced, F.array_union("review_flags", F.array(F.lit("explicit_lexicon_override")))).otherwise(F.col("review_flags")),
        }).drop("__o")
    return rows.withColumn("dictionary_variant", fn.variant_hash(F.col("key"), F.col("phones")))


def provided_candidates(lyrics: DataFrame, load, split, allowed: Sequence[str], overrides: DataFrame | None = None) -> DataFrame:
    """Candidates with the raw tokens of a user's provider, asked once per distinct key.

    A key the provider refuses or fails on has no tokens; ``provider_status`` and
    ``provider_error`` say so, and an override still gives it phones.
    """
    key = F.trim(F.coalesce(F.nullif("surface", F.lit("")), F.col("reading")))
    none = F.array().cast("array<string>")
    asked = models.with_model(lyrics.withColumn("__key", key), "__key", load, split, "array<string>", none, "provider").drop("__key")
    return pronunciation_candidates(asked, F.col("provider"), allowed, overrides).drop("provider")


def lyric_readiness(songs: DataFrame, lyrics: DataFrame) -> DataFrame:
    """Per song: rows, blank readings, zero counts, READY or the reason it is not."""
    facts = lyrics.groupBy("song_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(F.trim("reading"), F.lit("")) == "").alias("blank_readings"),
        F.count_if(F.coalesce(F.trim("surface"), F.lit("")) == "").alias("blank_surfaces"), F.count_distinct("phrase_id").alias("ids"),
    )
    rows = songs.select("song_id").join(facts, SONG, "left")
    why = F.when(F.col("rows").isNull(), "LYRICS_MISSING").when(F.col("blank_surfaces") > 0, "SURFACE_MISSING").when(F.col("ids") < F.col("rows"), "PHRASE_ID_DUPLICATE")
    return rows.withColumn("status", F.coalesce(why.when(F.col("blank_readings") > 0, "READING_MISSING"), F.lit("READY")))


def training_manifest(items: DataFrame, exclusions: DataFrame, extents: DataFrame, eps: int = 0, hot=None) -> DataFrame:
    """Training rows, given exclusions clipped around them, and the uncovered rest for review.

    ``items``: song_id, name, start_us, end_us.
    """
    given = iv.subtract(exclusions, items, SONG, eps, hot=hot)
    free = iv.uncovered(items.select("song_id", "start_us", "end_us").unionByName(given), extents, SONG, eps, hot=hot)
    parts = [
        items.select("song_id", "name", "start_us", "end_us", F.lit("training").alias("record_type"), F.lit("").alias("reason")),
        given.select("song_id", F.lit(None).cast("string").alias("name"), "start_us", "end_us", F.lit("exclude").alias("record_type"), F.lit("GIVEN").alias("reason")),
        free.select("song_id", F.lit(None).cast("string").alias("name"), "start_us", "end_us", F.lit("exclude").alias("record_type"), F.lit("AUTO_UNLABELED_GAP_REVIEW_REQUIRED").alias("reason")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def timing_repair(notes: DataFrame, spans: DataFrame, bin_us: int, min_piece: int, hot=None):
    """Notes cut at span borders and made continuous, with a fresh audit of the result."""
    cut = wn.split_over_spans(notes.select("song_id", "note_index", "start_us", "end_us"), spans, bin_us, min_piece, hot)
    filled = sq.fill_spans(cut, hot)
    return filled, sq.audit_filled(filled, hot)


def release_plan(register: DataFrame, staged: DataFrame, files: DataFrame):
    """Register rows that verify, as COPY / SKIP / CONFLICT against the staged files."""

    state = resolve_model_files(register, files)
    ok = register.join(state.where("state = 'OK'").select("name"), "name", "left_semi")
    return mf.copy_plan(ok, staged, "name", "sha256"), state.where("state <> 'OK'")


def total_duration(windows: DataFrame, declared: DataFrame) -> DataFrame:
    """Declared total where it is positive, else the sum of the windows."""
    summed = windows.groupBy("song_id").agg(F.sum(F.greatest(F.lit(0), F.col("end_us") - F.col("start_us"))).alias("summed"))
    both = summed.join(declared.select("song_id", F.col("total_us").alias("d")), SONG, "full_outer")
    return both.select("song_id", F.coalesce(F.when(F.col("d") > 0, F.col("d")), "summed", F.lit(0)).alias("total_us"))


def carry_candidates(candidates: DataFrame, windows: DataFrame):
    """Candidates of an older version on the windows of a new one. Returns (rows, clips without a window)."""
    now = windows.select("clip_id", F.col("start_us").alias("window_start"), F.col("end_us").alias("window_end"))
    both = candidates.join(now, "clip_id", "left")
    return both.where("window_start is not null"), both.where("window_start is null").select("clip_id").distinct()
