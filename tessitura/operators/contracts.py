"""Composite contracts. Each returns issue rows or a check table (code, failures, passed)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as fn
from . import intervals as iv
from . import manifest as mf
from .issues import check_row, check_table, settled
from .repairs import voiced_pauses
from .sequences import item_issues

# The fields of the speech manifest.
SPEECH_FIELDS = (
    "id", "audio_relpath", "source", "recording_group", "work", "year", "era", "type", "language", "text", "emotion", "intensity", "register",
    "style", "quality", "rights_status", "status", "reject_reason", "duration_sec", "sample_rate", "channels", "sha256", "split",
)
# Allowed words of the speech manifest and of the model register.
SPEECH_SPLITS = ("smoke_train", "smoke_benchmark", "train", "validation", "benchmark", "reject")
SPEECH_TYPES, SPEECH_STATUSES = ("speech", "singing"), ("accepted", "review", "reject")
RUN_STATUSES = ("ACOUSTIC_READY", "VARIANCE_READY", "BLOCKED")

# Record kinds and quality flags of a training package.
EXCLUDED_KINDS = ("exclude", "exclusion", "excluded", "rest_reclassified", "rest-reclassified")
TRAINING_KINDS = ("training", "segment", "utterance", "sample")
READY_FLAGS = ("true", "PASS", "PASSED", "READY", "TRAINING_READY")
BLOCKED_FLAGS = ("false", "FAIL", "FAILED", "BLOCKED", "NOT_READY", "REJECT")


def _blank(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""


def speech_manifest(rows: DataFrame, wavs: DataFrame, rate: int = 32_000) -> DataFrame:
    """``code, line`` of every violation. ``rows`` has ``line`` and the manifest fields as text;
    ``wavs`` has ``audio_relpath`` and the header columns of the files that exist."""
    have = set(rows.columns)
    absent = [c for c in SPEECH_FIELDS if c not in have]
    full = rows.withColumns({c: F.lit(None).cast("string") for c in absent})
    heads = wavs.select("audio_relpath", "sample_rate", "channels", "bit_depth", F.lit(True).alias("__file"))
    both = full.drop("sample_rate", "channels").join(heads, "audio_relpath", "left")
    good_wav = (F.col("sample_rate") == rate) & (F.col("channels") == 1) & (F.col("bit_depth") == 16)
    no_value = F.lit(False)
    for c in SPEECH_FIELDS:
        if c not in ("reject_reason", "sample_rate", "channels"):
            no_value = no_value | _blank(c)
    rules = {
        "missing_fields": F.lit(bool(absent)), "missing_values": no_value,
        "text_language": _blank("text") | ~F.col("language").eqNullSafe("JA"),
        "invalid_values": ~F.coalesce(F.col("type").isin(*SPEECH_TYPES) & F.col("status").isin(*SPEECH_STATUSES) & F.col("split").isin(*SPEECH_SPLITS), F.lit(False)),
        "reject_reason": (F.col("status") == "reject") & _blank("reject_reason"),
        "text_contains_pipe": F.contains("text", F.lit("|")),
        "invalid_audio_path": ~fn.safe_path(F.col("audio_relpath")) | F.col("__file").isNull(),
        "invalid_wav_format": ~F.coalesce(good_wav, F.lit(False)),
        "reject_in_training": (F.col("status") == "reject") & F.col("split").isin(*mf.SPLITS),
    }
    issues = mf.field_issues(both, "line", rules)
    for c in ("id", "audio_relpath", "sha256"):
        twice = mf.duplicates(full, F.nullif(F.col(c), F.lit("")), c)
        issues = issues.unionByName(twice.select(F.lit(f"duplicate_{c}").alias("code"), F.lit(None).cast(issues.schema["line"].dataType).alias("line")).distinct())
    leak = mf.split_leakage(full.where("recording_group <> ''"), "recording_group")
    return issues.unionByName(leak.select(F.lit("recording_group_leakage").alias("code"), F.lit(None).cast(issues.schema["line"].dataType).alias("line")).distinct())


def singing_manifest(clips: DataFrame, files: DataFrame, required: DataFrame, min_ms: int, max_ms: int, rate: int = 40_000, review: bool = False) -> DataFrame:
    """``code, failures, passed`` of a clip manifest against the files it names.

    ``clips``: clip_id, audio_relpath, audio_sha256, song_id, split, manual_review_status.
    ``files``: audio_relpath, bytes, sha256, sample_rate, channels, bit_depth, duration_ms, peak.
    ``required``: song_id.
    """
    f = files.select("audio_relpath", "bytes", "sha256", "sample_rate", "channels", "bit_depth", F.col("duration_ms").alias("file_ms"), "peak", F.lit(True).alias("__file"))
    safe = fn.safe_path(F.col("audio_relpath"))
    rows = clips.join(f, "audio_relpath", "left")
    here = rows.where(safe & F.col("__file") & (F.col("bytes") > 0))
    wav = (F.col("sample_rate") == rate) & (F.col("channels") == 1) & (F.col("bit_depth") == 16)
    per_song = here.groupBy("song_id").agg(F.sum("file_ms").alias("duration_ms"))
    total = per_song.agg(F.coalesce(F.sum("duration_ms"), F.lit(0)).alias("t"))
    checks = {
        "DUPLICATE_CLIP_ID": mf.duplicates(clips, F.col("clip_id"), "c"),
        "INVALID_AUDIO_PATH": clips.where(~safe),
        "DUPLICATE_AUDIO_PATH": mf.duplicates(clips.where(safe), F.lower("audio_relpath"), "p"),
        "AUDIO_MISSING_OR_EMPTY": rows.where(safe & (F.col("__file").isNull() | (F.col("bytes") == 0))),
        "INVALID_WAV_FORMAT": here.where(~F.coalesce(wav, F.lit(False))),
        "INVALID_CLIP_DURATION": here.where(~F.col("file_ms").between(2_990, 12_010)),
        "CLIPPING": here.where("peak >= 1.0"),
        "PEAK_NOT_SCALED_TO_MINUS_ONE_DBFS": here.where((F.col("peak") > 0) & (20 * F.log10("peak") > -0.98)),
        "AUDIO_HASH_MISMATCH": here.where(~F.col("sha256").eqNullSafe(F.col("audio_sha256"))),
        "DUPLICATE_AUDIO": mf.duplicates(here, F.col("sha256"), "h"),
        "INVALID_SPLIT": here.where(~F.coalesce(F.col("split").isin(*mf.SPLITS), F.lit(False))),
        "SONG_SPLIT_LEAK": mf.split_leakage(here, "song_id"),
        "MISSING_REQUIRED_SONG": required.join(here, "song_id", "left_anti"),
        "TOTAL_DURATION_OUT_OF_RANGE": total.where(~F.col("t").between(min_ms, max_ms)),
        "SONG_OVERREPRESENTED": mf.song_share(per_song).where("over"),
    }
    if review:
        checks["MANUAL_REVIEW_PENDING"] = here.where("manual_review_status = 'pending'")
    return check_table(checks)


def audio_artefacts(files: DataFrame, rate: int, channels: int, tolerance_ms: int = 50) -> DataFrame:
    """``path, type`` of artefacts that break their contract. ``expected_ms`` and ``expected_frames`` may be null."""
    rules = {
        "AUDIO_MISSING": F.coalesce(F.col("bytes"), F.lit(0)) == 0,
        "AUDIO_UNDECODABLE": F.col("frames").isNull(),
        "AUDIO_RATE": F.col("sample_rate") != rate,
        "AUDIO_CHANNELS": F.col("channels") != channels,
        "AUDIO_DURATION": F.abs(F.col("duration_ms") - F.col("expected_ms")) > tolerance_ms,
        "AUDIO_FRAMES": F.col("frames") != F.col("expected_frames"),
        "AUDIO_CLIPPING": F.col("peak") >= 1.0,
        "AUDIO_SILENT": F.col("rms") <= 0,
        "AUDIO_NOT_FINITE": F.isnan("peak") | (F.col("peak") == float("inf")),
    }
    return mf.field_issues(files, "path", rules).withColumnRenamed("code", "type")


def run_audit(
    items: DataFrame, exclusions: DataFrame, extents: DataFrame, reviews: DataFrame, allowed: Sequence[str], eps: int = 1, hot=None,
    sources: DataFrame | None = None, audio: DataFrame | None = None, alignments: DataFrame | None = None, rate: int = fn.SAMPLE_RATE,
) -> DataFrame:
    """Check table of one or many runs: inputs, structure, dense and long items, pauses over voice, timeline, review gate.

    ``items``: song_id, name, start_us, end_us (sample units) and the sequence strings;
    ``extents``: song_id, extent. Optional: ``sources`` (sha256 as registered, current_sha256,
    null for a missing file), ``audio`` (sample_rate, channels, bit_depth), ``alignments``
    (status, textgrid: whether its file is there).
    """
    keys, item = ["song_id"], ["song_id", "name"]
    phones, dur, f0 = fn.tokens(F.col("ph_seq")), fn.numbers(F.col("ph_dur")), fn.numbers(F.col("f0_seq"))
    step = F.coalesce(F.nullif(F.col("f0_timestep").try_cast("double"), F.lit(0.0)), F.lit(0.01))
    length = F.when(F.size(dur) > 0, fn.total(dur)).otherwise(fn.total(fn.numbers(F.col("note_dur"))))
    rows = items.withColumn("__step", step).withColumn("__len", length)
    frames = F.greatest(F.lit(1), F.ceil(F.col("__len") / F.col("__step")))
    # Pauses over voiced frames: sequences as rows, counted by running sums.
    sung = rows.where((F.size(phones) == F.size(dur)) & (F.size(f0) > 0) & (F.col("__step") > 0))
    slots = sung.select(*item, F.posexplode(F.arrays_zip(phones.alias("phone"), dur.alias("dur"))).alias("ph_index", "p")).select(*item, "ph_index", "p.phone", "p.dur")
    heard = sung.select(*item, "__step", F.posexplode(f0).alias("i", "f0")).select(*item, ((F.col("i") + 0.5) * F.col("__step")).alias("at"), "f0")
    cover = items.select("song_id", "start_us", "end_us").unionByName(exclusions.select("song_id", "start_us", "end_us"))
    order = ["start_us", "end_us"]
    checks = {
        "LANGUAGE_PROFILE": extents.where(F.lit(not allowed)),
        "BUILD_EXISTS": extents.join(items, "song_id", "left_anti"),
        "DS_STRUCTURE": item_issues(items, "name", allowed=allowed),
        "VOICED_AS_SP_AP": voiced_pauses(slots, heard, item),
        "DENSE_PHRASE": rows.where((F.col("__len") < 1.0) & (F.size(phones) > 12)),
        "SEGMENT_TOO_LONG": rows.where("__len > 15"),
        "F0_FRAME_MISMATCH": rows.where((F.size(f0) > 0) & (F.abs(frames - F.size(f0)) > 1)),
        "TIMELINE_OVERLAP": iv.adjacent_overlaps(items, keys, order, eps, "name", hot=hot),
        "TIMELINE_COVERAGE": iv.uncovered(cover, extents, keys, eps, hot=hot),
        "TIMELINE_PARTITION": iv.adjacent_overlaps(cover.withColumn("name", F.lit(0)), keys, order, eps, "name", hot=hot),
        "REVIEW_GATE": reviews.where(~settled(F.col("status"))),
        "MODEL_INTERFACE": rows.where((F.size(dur) == 0) | (F.size(f0) == 0)),
    }
    if sources is not None:
        checks["SOURCE_HASHES"] = sources.where("sha256 is not null and current_sha256 is not null and sha256 <> current_sha256")
    if audio is not None:
        fits = (F.col("sample_rate") == rate) & (F.col("channels") == 1) & (F.col("bit_depth") == 16)
        checks["AUDIO_FORMAT"] = audio.where(~F.coalesce(fits, F.lit(False)))
    if alignments is not None:
        checks["MFA_TEXTGRIDS"] = alignments.where(~(F.col("status").eqNullSafe(F.lit("aligned")) & F.coalesce("textgrid", F.lit(False))))
    return check_table(checks)


def run_status(checks: DataFrame, predicts_missing: bool = False) -> DataFrame:
    """ACOUSTIC_READY, VARIANCE_READY (missing inputs are predicted) or BLOCKED."""
    bad = checks.where("not passed").agg(F.count_if(F.col("code") != "MODEL_INTERFACE").alias("other"), F.count_if(F.col("code") == "MODEL_INTERFACE").alias("inputs"))
    variance = (F.col("other") == 0) & F.lit(predicts_missing)
    status = F.when((F.col("other") == 0) & (F.col("inputs") == 0), "ACOUSTIC_READY").when(variance, "VARIANCE_READY").otherwise("BLOCKED")
    return bad.select(status.alias("status"), (F.col("other") + F.col("inputs")).alias("failed_checks"))


def training_package(wavs: DataFrame, transcriptions: DataFrame, manifest: DataFrame, splits: DataFrame, members: DataFrame, checksums: DataFrame, flags: DataFrame, rate: int = 44_100) -> DataFrame:
    """Check table of a training package.

    ``wavs``: name, sample_rate, channels, bit_depth, frames. ``transcriptions``: name and
    the six sequence strings. ``manifest``: name, record_type, review_status, duration_sec.
    ``splits``: label, split, name (prefixes already resolved). ``members`` and
    ``checksums``: path, sha256. ``flags``: key, value of the QA report.
    """
    second = 1.0 / rate
    good = (F.col("sample_rate") == rate) & (F.col("channels") == 1) & (F.col("bit_depth") == 16) & (F.col("frames") > 0)
    ph, num, notes, pd_, nd = fn.tokens(F.col("ph_seq")), fn.integers(F.col("ph_num")), fn.tokens(F.col("note_seq")), fn.numbers(F.col("ph_dur")), fn.numbers(F.col("note_dur"))
    positive = lambda a: (F.size(a) > 0) & F.forall(a, lambda v: v > 0)
    fit = positive(num) & positive(pd_) & positive(nd) & (F.size(ph) == F.size(pd_)) & (F.size(notes) == F.size(nd))
    fit = fit & (F.aggregate(num, F.lit(0).cast("bigint"), lambda a, v: a + v) == F.size(ph))
    fit = fit & (F.abs(fn.total(pd_) - fn.total(nd)) <= second)
    # Only what a check needs of a sequence is joined, never its text.
    t = transcriptions.select("name", fit.alias("fit"), fn.total(pd_).alias("length")).join(wavs.select("name", (F.col("frames") / rate).alias("sec")), "name", "left")
    fit = F.col("fit") & (F.abs(F.col("length") - F.col("sec")) <= second)
    kind = F.lower(F.coalesce("record_type", F.lit("segment")))
    train = manifest.where(~kind.isin(*EXCLUDED_KINDS))
    odd = train.where(~kind.isin(*TRAINING_KINDS) | (F.col("review_status") == "pending") | (F.col("duration_sec") <= 0))
    ready = flags.where(F.col("value").isin(*READY_FLAGS))
    bad = flags.where(F.col("value").isin(*BLOCKED_FLAGS))
    no_ready = ready.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit("ready").alias("key"))
    checks = {
        "TRAINING_WAV_METADATA": wavs.where(~F.coalesce(good, F.lit(False))),
        "TRAINING_TRANSCRIPTIONS_CONTRACT": t.where(~F.coalesce(fit, F.lit(False))),
        "TRAINING_MANIFEST": odd,
        "TRAINING_QA_FINAL": bad.select("key").unionByName(no_ready),
        "TRAINING_UPLOAD_SHA256SUMS": mf.integrity(members, checksums, "path", ["sha256"]),
    }
    return check_table(checks).unionByName(_package_names(wavs, transcriptions, train, splits))


def _package_names(wavs: DataFrame, transcriptions: DataFrame, train: DataFrame, splits: DataFrame) -> DataFrame:
    """Names that are not once on each side of a set, and groups that a split lacks.

    Every name meets its counts on all sides in one aggregation, so the splits are resolved once.
    """
    labels, groups = ("development", "final"), ("train", "validation")
    is_in = {label: F.col("label") == label for label in labels}
    is_in |= {f"{label}_{group}": (F.col("label") == label) & (F.col("split") == group) for label in labels for group in groups}
    sides = ("wav", "csv", "manifest", *is_in)
    counted = lambda rows, tests: rows.select("name", *[F.when(tests.get(s, F.lit(False)), 1).otherwise(0).cast("bigint").alias(s) for s in sides])
    long = counted(splits, is_in)
    for side, rows in {"wav": wavs, "csv": transcriptions, "manifest": train}.items():
        long = long.unionByName(counted(rows, {side: F.lit(True)}))
    counts = long.groupBy("name").agg(*[F.sum(s).alias(s) for s in sides])

    def odd(*of: str) -> Column:
        here, uneven = F.lit(False), F.lit(False)
        for s in of:
            here, uneven = here | (F.col(s) > 0), uneven | (F.col(s) != 1)
        return F.count_if(here & uneven)

    failures = {"TRAINING_NAME_SETS": odd("wav", "csv", "manifest")}
    for label in labels:
        failures[f"TRAINING_SPLIT_{label.upper()}"] = odd("csv", label)
        train_, validation = (F.when(F.max(f"{label}_{group}") > 0, 0).otherwise(1) for group in groups)
        failures[f"TRAINING_SPLIT_{label.upper()}_GROUPS"] = train_ + validation
    return check_row(counts, failures)


def resolve_split_entries(entries: DataFrame, names: DataFrame) -> DataFrame:
    """Split entries to names: an entry that is a name means itself, else every name it prefixes.

    Names are looked up by their prefixes of the lengths that occur, so this stays an
    equi-join; the lengths travel as one row. ``entries``: label, split, entry.
    """
    exact = entries.join(names.select(F.col("name").alias("entry")), "entry", "left_semi").select("label", "split", F.col("entry").alias("name"))
    rest = entries.join(names.select(F.col("name").alias("entry")), "entry", "left_anti")
    sizes = rest.agg(F.collect_set(F.length("entry")).alias("sizes"))
    cuts = names.crossJoin(F.broadcast(sizes)).select("name", F.explode(F.filter("sizes", lambda n: n <= F.length("name"))).alias("n"))
    cuts = cuts.select("name", F.substring("name", F.lit(1), F.col("n")).alias("entry"))
    return exact.unionByName(rest.join(cuts, "entry").select("label", "split", "name"))


def candidate_entries(entries: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """``phrase_id, type`` for incomplete, unknown, wrongly hashed and Latin candidates."""
    phones = F.coalesce("phones", F.array().cast("array<string>"))
    raw = F.coalesce("raw_tokens", F.array().cast("array<string>"))
    unknown = F.exists(phones, lambda p: ~p.isin(*allowed)) if allowed else F.lit(False)
    rules = {
        "CANDIDATE_ENTRY_INCOMPLETE": (F.coalesce("key", F.lit("")) == "") | (F.size(raw) == 0) | (F.size(phones) == 0),
        "CANDIDATE_UNKNOWN_PHONEME": unknown,
        "CANDIDATE_VARIANT_HASH_MISMATCH": ~F.col("dictionary_variant").eqNullSafe(fn.variant_hash(F.coalesce("key", F.lit("")), phones)),
        "LATIN_READING_REQUIRES_REVIEW": F.coalesce(F.col("latin_text"), F.lit(False)),
    }
    return mf.field_issues(entries, "phrase_id", rules).withColumnRenamed("code", "type")


def phone_inventory(phones: DataFrame, expected: int) -> DataFrame:
    """Check table of an inventory: exact count, unique, no padding symbol."""
    size = phones.agg(F.count(F.lit(1)).alias("n"))
    return check_table(
        {"PHONE_COUNT": size.where(F.col("n") != expected), "PHONE_UNIQUE": mf.duplicates(phones, F.col("phone"), "phone"), "PHONE_PADDING": phones.where("phone = '<PAD>'")}
    )


def unknown_phones(items: DataFrame, inventory: DataFrame, index: str = "item_index") -> DataFrame:
    """One row per phone of an item that the inventory lacks, with its place."""
    used = items.select(index, F.posexplode(fn.tokens(F.col("ph_seq"))).alias("place", "phone"))
    return used.join(inventory.select("phone"), "phone", "left_anti").select(index, "place", "phone", F.lit("UNKNOWN_PHONEME").alias("type"))


def model_manifest(files: DataFrame, roles: Sequence[str]) -> DataFrame:
    """``name, type`` of register rows with a bad role, name, size or hash."""
    rules = {
        "ROLE_INVALID": ~F.coalesce(F.col("role").isin(*roles), F.lit(False)),
        "NAME_UNSAFE": ~fn.safe_path(F.col("name")) | F.contains(F.col("name"), F.lit("/")),
        "BYTES_INVALID": F.coalesce(F.col("bytes") <= 0, F.lit(True)),
        "SHA256_INVALID": ~F.coalesce(F.col("sha256").rlike("^[0-9a-f]{64}$"), F.lit(False)),
    }
    return mf.field_issues(files, "name", rules).withColumnRenamed("code", "type")


def resolve_model_files(register: DataFrame, files: DataFrame) -> DataFrame:
    """Register rows against the files found: MISSING, AMBIGUOUS, bytes and hash mismatches, or OK."""
    found = files.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("bytes").alias("now_bytes"), F.min("sha256").alias("now_sha"))
    state = F.when(F.col("n").isNull(), "MISSING").when(F.col("n") > 1, "AMBIGUOUS").when(F.col("now_bytes") != F.col("bytes"), "BYTES_MISMATCH")
    return register.join(found, "name", "left").select("name", state.when(F.col("now_sha") != F.col("sha256"), "SHA256_MISMATCH").otherwise("OK").alias("state"))


def status_words(rows: DataFrame, column: str = "status", allowed: Sequence[str] = RUN_STATUSES) -> DataFrame:
    """Rows whose status is not in the vocabulary."""
    return rows.where(~F.coalesce(F.col(column).isin(*allowed), F.lit(False)))


# Files that mark a training package.
PACKAGE_MARKERS = (
    "dataset/raw/transcriptions.csv", "metadata/manifest.jsonl", "reports/qa_final.json", "splits/development.json", "splits/final.json",
)


def package_type(members: DataFrame) -> DataFrame:
    """``archive, package_type``: a training package has all markers, every other one is a legacy package."""
    hits = [F.max(F.when(F.col("member") == m, 1).otherwise(0)) for m in PACKAGE_MARKERS]
    total = sum(hits[1:], hits[0])
    return members.groupBy("archive").agg(total.alias("n")).select("archive", F.when(F.col("n") == len(PACKAGE_MARKERS), "training_dataset_v1").otherwise("legacy").alias("package_type"))


def legacy_package(members: DataFrame, items: DataFrame, checksums: DataFrame) -> DataFrame:
    """Check table of an older package. ``members``: path, sha256; ``items``: name and sequence strings."""
    absent = lambda name: members.agg(F.count_if(F.col("path") == name).alias("n")).where("n = 0")
    listed = checksums.select("path", F.col("sha256").alias("want")).join(members, "path", "left")
    contract = item_issues(items, "name").where(F.col("type").rlike("^(PH_NUM|NON_POSITIVE_PH_NUM|NOTE_|NON_POSITIVE_NOTE|UNKNOWN_NOTE|MISSING_FIELD:(lang|ph|note))"))
    no_items = members.agg(F.count_if(F.col("path").endswith(".ds")).alias("n")).where("n = 0")
    return check_table(
        {"DS_PRESENT": no_items, "DS_PARSE": contract, "MANIFEST_PRESENT": absent("manifest.jsonl"), "QA_PRESENT": absent("qa.json"), "HASH": listed.where(~F.col("sha256").eqNullSafe(F.col("want")))}
    )


def final_dataset(transcriptions: DataFrame, manifest: DataFrame, wavs: DataFrame, coverage: DataFrame, rate: int = 44_100) -> DataFrame:
    """Check table of a built training set.

    ``manifest``: name, record_type, review_status, note_slur. ``coverage``: rows of the
    coverage contract with their state.
    """
    eps = 1.0 / rate
    ph, num, notes = fn.tokens(F.col("ph_seq")), fn.integers(F.col("ph_num")), fn.tokens(F.col("note_seq"))
    pd_, nd, slur = fn.numbers(F.col("ph_dur")), fn.numbers(F.col("note_dur")), fn.tokens(F.col("note_slur"))
    same = (F.size(ph) == F.size(pd_)) & (F.aggregate(num, F.lit(0).cast("bigint"), lambda a, v: a + v) == F.size(ph)) & (F.size(notes) == F.size(nd))
    length = F.forall(F.concat(pd_, nd), lambda v: v > 0) & (F.abs(fn.total(pd_) - fn.total(nd)) <= eps)
    good = (F.col("sample_rate") == rate) & (F.col("channels") == 1) & (F.col("bit_depth") == 16)
    # Only what a check needs of a sequence is joined, never its text; all checks of rows are one pass.
    train = manifest.where("record_type = 'training'").select(
        "name", F.size(slur).alias("__slurs"), F.forall(slur, lambda v: v.isin("0", "1")).alias("__slur_words"), F.lit(True).alias("__listed")
    )
    heads = wavs.select("name", good.alias("__good"), (F.col("frames") / rate).alias("sec"), F.lit(True).alias("__wav"))
    facts = transcriptions.select("name", same.alias("__same"), length.alias("__length"), fn.total(nd).alias("__total"), F.size(notes).alias("__notes"))
    rows = facts.join(train, "name", "left").join(heads, "name", "left")
    slurs = (F.col("__slurs") == F.col("__notes")) & F.col("__slur_words")
    broken = lambda test: F.count_if(~F.coalesce(test, F.lit(False)))
    checked = check_row(
        rows,
        {
            "TRAINING_ROWS": F.when(F.count(F.lit(1)) == 0, 1).otherwise(0),
            "MANIFEST_ROW_MISSING": broken(F.col("__listed")), "SEQUENCE_CONTRACT": broken(F.col("__same")), "DURATION_CONTRACT": broken(F.col("__length")),
            "WAV_DECODE": broken(F.col("__wav")), "WAV_FORMAT": F.count_if(F.col("__wav") & ~F.col("__good")),
            "WAV_DURATION_CONTRACT": F.count_if(F.col("__wav") & (F.abs(F.col("sec") - F.col("__total")) > eps)),
            "NOTE_SLUR_CONTRACT": F.count_if(F.col("__listed") & ~F.coalesce(slurs, F.lit(False))),
        },
    )
    return checked.unionByName(check_table({"SOURCE_COVERAGE_CONTRACT": coverage.where("state <> 'EQUAL'"), "PENDING_ZERO": manifest.where("review_status = 'pending'")}))


def batch_repair(queue: DataFrame, notes: DataFrame, locks: DataFrame, cuts: DataFrame, budget: DataFrame, before: DataFrame, after: DataFrame, eps: int = 1, hot=None) -> DataFrame:
    """Check table of an applied batch repair.

    ``before`` / ``after``: path, sha256 of files the repair must not touch; ``budget``: rows
    of ``prune_budget``.
    """
    traced = F.col("root_issue_id").isNotNull() & F.col("resolution_action").isNotNull() & F.col("artifact_sha256").isNotNull()
    late = iv.running_max_violations(notes, ["song_id"], ["note_index"], eps, hot=hot)
    changed = before.join(after.select("path", F.col("sha256").alias("now")), "path", "left").where(~F.col("sha256").eqNullSafe(F.col("now")))
    return check_table(
        {
            "QUEUE_RESOLVED": queue.where(~settled(F.col("status"))), "QUEUE_TRACE_FIELDS": queue.where(~traced),
            "NOTE_DURATION": notes.where("end_us <= start_us"), "NOTE_ORDER": late,
            "LOCK_STATUS": locks.where(~F.coalesce(F.col("status").isin("LOCKED", "EXCLUDED"), F.lit(False))),
            "CUT_INTERVALS": cuts.where("end_us <= start_us or start_us is null or end_us is null"),
            "SOURCE_PRESERVED": changed, "PRUNE_BUDGET": budget.where("status <> 'WITHIN_BUDGET'").select("status").distinct(),
        }
    )


def candidate_stage(sources: DataFrame, entries: DataFrame, allowed: Sequence[str], assigned: DataFrame, reported: DataFrame, issues: DataFrame, decided: DataFrame, hot=None) -> DataFrame:
    """Check table of a candidate set: sources unchanged, phones allowed, mapping complete, issues decided.

    ``sources``: path, sha256, now_sha256. ``reported``: song_id, mapped_notes. ``decided``: issue_id.
    """
    counts = assigned.groupBy("song_id").agg(F.count(F.lit(1)).alias("n"))
    timing = iv.running_max_violations(assigned, ["song_id"], ["note_index"], 0, hot=hot)
    bad = assigned.where("start_us < 0 or end_us <= start_us or note_slur not in (0, 1)")
    return check_table(
        {
            "SOURCE_HASH": sources.where(~F.col("sha256").eqNullSafe(F.col("now_sha256"))),
            "G2P_FILES": entries.where(F.exists("phones", lambda p: ~p.isin(*allowed)) | (F.size("phones") == 0)),
            "NOTE_FILES": reported.join(counts, "song_id", "left").where(~F.col("n").eqNullSafe(F.col("mapped_notes")) & (F.col("mapped_notes") > 0)),
            "NOTE_TIMING": bad.select("song_id").unionByName(timing.select("song_id")),
            "CANDIDATE_REPORTS": issues.join(decided.select("issue_id"), "issue_id", "left_anti"),
        }
    )
