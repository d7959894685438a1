"""Manifests, packages and candidate sets held against their contracts, and the jobs around them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..operators import contracts as ct
from ..operators import sequences as sq
from ..operators import signal as sg
from ..operators.scans import row_number, scan
from . import jobs
from .job_queries import ITEM_SQL, model_files, score_items
from .registry import QUERIES, query
from .sequence_queries import gap_rows
from .timeline_queries import MINUTE_US
from .views import Tables


def _every(column: str, n: int, rest: int = 0) -> Column:
    return F.col(column) % n == rest


def _table(checks: dict[str, str]) -> str:
    """A check table in SQL: per code a query that gives the number of failures."""
    return "SELECT code, failures, failures = 0 AS passed FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS code, CAST(({q}) AS BIGINT) AS failures" for c, q in checks.items()) + ")"


# -- manifests ------------------------------------------------------------------------

SPEECH = """r AS (SELECT doc_id AS line, CASE WHEN doc_id % 50 = 0 THEN 'same' ELSE 'id' || doc_id END AS id, CASE WHEN doc_id % 9 = 0 THEN '../' || doc_id ELSE 'a/' || doc_id || '.wav' END AS path, source AS grp, text, sha256(text) AS sha,
      CASE lang WHEN 'fr' THEN 'JA' ELSE lang END AS language, CASE doc_id % 7 WHEN 0 THEN 'reject' WHEN 1 THEN 'odd' ELSE 'accepted' END AS status, CASE WHEN doc_id % 14 = 0 THEN 'noise' ELSE '' END AS why,
      CASE WHEN doc_id % 13 = 0 THEN 'none' WHEN doc_id % 10 < 8 THEN 'train' WHEN doc_id % 10 = 8 THEN 'validation' ELSE 'benchmark' END AS split, doc_id % 15 = 0 AS no_year, doc_id % 9 <> 0 AND doc_id % 8 <> 0 AS here, doc_id % 6 <> 0 AS rate_ok FROM documents)"""


@query(f"""WITH {SPEECH} SELECT unnest(list_filter([CASE WHEN no_year OR trim(coalesce(text, '')) = '' THEN 'missing_values' END, CASE WHEN trim(coalesce(text, '')) = '' OR language <> 'JA' THEN 'text_language' END,
      CASE WHEN status = 'odd' OR split = 'none' THEN 'invalid_values' END, CASE WHEN status = 'reject' AND why = '' THEN 'reject_reason' END, CASE WHEN contains(text, '|') THEN 'text_contains_pipe' END,
      CASE WHEN NOT here THEN 'invalid_audio_path' END, CASE WHEN NOT (here AND rate_ok) THEN 'invalid_wav_format' END, CASE WHEN status = 'reject' AND split <> 'none' THEN 'reject_in_training' END], lambda x: x IS NOT NULL)) AS code, line FROM r
    UNION ALL SELECT DISTINCT 'duplicate_id', CAST(NULL AS BIGINT) FROM (SELECT id FROM r GROUP BY id HAVING count(*) > 1) UNION ALL SELECT DISTINCT 'duplicate_audio_relpath', NULL FROM (SELECT path FROM r GROUP BY path HAVING count(*) > 1)
    UNION ALL SELECT DISTINCT 'duplicate_sha256', NULL FROM (SELECT sha FROM r GROUP BY sha HAVING count(*) > 1)
    UNION ALL SELECT DISTINCT 'recording_group_leakage', NULL FROM (SELECT grp FROM r WHERE split <> 'none' AND grp <> '' GROUP BY grp HAVING count(DISTINCT split) > 1)""")
def speech_manifest(t: Tables):
    """Documents as speech rows: every rule both fires and holds."""
    i = F.col("doc_id")
    part = F.when(_every("doc_id", 13), "none").when(i % 10 < 8, "train").when(i % 10 == 8, "validation").otherwise("benchmark")
    given = {
        "id": F.when(_every("doc_id", 50), "same").otherwise(F.concat(F.lit("id"), i.cast("string"))),
        "audio_relpath": F.when(_every("doc_id", 9), F.concat(F.lit("../"), i.cast("string"))).otherwise(F.concat(F.lit("a/"), i.cast("string"), F.lit(".wav"))),
        "recording_group": F.col("source"), "source": F.lit("v"), "text": F.col("text"), "sha256": F.sha2("text", 256), "language": F.when(F.col("lang") == "fr", "JA").otherwise(F.col("lang")),
        "status": F.when(i % 7 == 0, "reject").when(i % 7 == 1, "odd").otherwise("accepted"), "reject_reason": F.when(i % 14 == 0, "noise").otherwise(""), "split": part,
        "year": F.when(_every("doc_id", 15), " ").otherwise("2001"), "type": F.lit("speech"),
    }
    rows = t.read("documents").select(i.alias("line"), *[given.get(c, F.lit("v")).alias(c) for c in ct.SPEECH_FIELDS])
    heads = rows.where("line % 9 <> 0 and line % 8 <> 0").select("audio_relpath", F.when(F.col("line") % 6 == 0, 44_100).otherwise(32_000).alias("sample_rate"), F.lit(1).alias("channels"), F.lit(16).alias("bit_depth"))
    return ct.speech_manifest(rows, heads)


SINGING = """c AS (SELECT clip_id, song_id, audio_sha256, split, CASE WHEN clip_id % 9 = 0 THEN '/' || clip_id WHEN clip_id % 50 = 1 THEN 'c/DUP.wav' WHEN clip_id % 50 = 2 THEN 'c/dup.wav' ELSE 'c/' || clip_id || '.wav' END AS path FROM clips WHERE clip_id % 40 <> 39
      UNION ALL SELECT clip_id, song_id, audio_sha256, 'else', 'again/' || clip_id FROM clips WHERE clip_id % 40 = 7),
    h AS (SELECT *, CASE WHEN clip_id % 17 = 0 THEN 2000 ELSE 3000 + clip_id % 10 * 1000 END AS ms, CASE WHEN clip_id % 19 = 0 THEN 1.0 WHEN clip_id % 23 = 0 THEN 0.95 ELSE 0.5 END AS peak, CASE WHEN clip_id % 7 = 0 THEN 'x' || clip_id ELSE audio_sha256 END AS fsha
      FROM c WHERE path = 'c/' || clip_id || '.wav' AND clip_id % 11 <> 0 AND clip_id % 13 <> 0),
    s AS (SELECT song_id, sum(ms) AS ms FROM h GROUP BY song_id)"""


@query(f"WITH {SINGING} " + _table({
    "DUPLICATE_CLIP_ID": "SELECT count(*) FROM (SELECT clip_id FROM c GROUP BY clip_id HAVING count(*) > 1)",
    "INVALID_AUDIO_PATH": "SELECT count(*) FROM c WHERE path LIKE '/%'",
    "DUPLICATE_AUDIO_PATH": "SELECT count(*) FROM (SELECT lower(path) FROM c WHERE path NOT LIKE '/%' GROUP BY lower(path) HAVING count(*) > 1)",
    "AUDIO_MISSING_OR_EMPTY": "SELECT count(*) FROM c WHERE path NOT LIKE '/%' AND NOT (path = 'c/' || clip_id || '.wav' AND clip_id % 11 <> 0 AND clip_id % 13 <> 0)",
    "INVALID_WAV_FORMAT": "SELECT count(*) FROM h WHERE clip_id % 29 = 0", "INVALID_CLIP_DURATION": "SELECT count(*) FROM h WHERE ms < 2990 OR ms > 12010", "CLIPPING": "SELECT count(*) FROM h WHERE peak >= 1",
    "PEAK_NOT_SCALED_TO_MINUS_ONE_DBFS": "SELECT count(*) FROM h WHERE peak > 0.9", "AUDIO_HASH_MISMATCH": "SELECT count(*) FROM h WHERE fsha <> audio_sha256",
    "DUPLICATE_AUDIO": "SELECT count(*) FROM (SELECT fsha FROM h GROUP BY fsha HAVING count(*) > 1)", "INVALID_SPLIT": "SELECT count(*) FROM h WHERE split NOT IN ('train', 'validation', 'benchmark')",
    "SONG_SPLIT_LEAK": "SELECT count(*) FROM (SELECT song_id FROM h WHERE split <> 'else' GROUP BY song_id HAVING count(DISTINCT split) > 1)",
    "MISSING_REQUIRED_SONG": "SELECT count(*) FROM (SELECT DISTINCT song_id || CASE WHEN clip_id % 2 = 0 THEN '' ELSE '-b' END AS q FROM clips) WHERE q NOT IN (SELECT song_id FROM h)",
    "TOTAL_DURATION_OUT_OF_RANGE": "SELECT CASE WHEN (SELECT sum(ms) FROM h) BETWEEN 0 AND 60000 THEN 0 ELSE 1 END",
    "SONG_OVERREPRESENTED": "SELECT count(*) FROM s WHERE ms * 3 > (SELECT sum(ms) FROM s)",
    "MANUAL_REVIEW_PENDING": "SELECT count(*) FROM h WHERE clip_id % 31 = 0",
}))
def singing_manifest(t: Tables):
    i = F.col("clip_id")
    name = F.concat(F.lit("c/"), i.cast("string"), F.lit(".wav"))
    path = F.when(i % 9 == 0, F.concat(F.lit("/"), i.cast("string"))).when(i % 50 == 1, "c/DUP.wav").when(i % 50 == 2, "c/dup.wav").otherwise(name)
    review = F.when(i % 31 == 0, "pending").otherwise("accepted").alias("manual_review_status")
    base = t.clips()
    clips = base.where("clip_id % 40 <> 39").select("clip_id", path.alias("audio_relpath"), "audio_sha256", "song_id", "split", review)
    again = base.where("clip_id % 40 = 7").select("clip_id", F.concat(F.lit("again/"), i.cast("string")).alias("audio_relpath"), "audio_sha256", "song_id", F.lit("else").alias("split"), review)
    files = base.where("clip_id % 40 <> 39 and clip_id % 9 <> 0 and clip_id % 50 not in (1, 2) and clip_id % 11 <> 0").select(
        name.alias("audio_relpath"), F.when(i % 13 == 0, 0).otherwise(44).alias("bytes"), F.when(i % 7 == 0, F.concat(F.lit("x"), i.cast("string"))).otherwise(F.col("audio_sha256")).alias("sha256"), F.lit(40_000).alias("sample_rate"),
        F.when(i % 29 == 0, 2).otherwise(1).alias("channels"), F.lit(16).alias("bit_depth"), F.when(i % 17 == 0, 2000).otherwise(3000 + i % 10 * 1000).alias("duration_ms"), F.when(i % 19 == 0, 1.0).when(i % 23 == 0, 0.95).otherwise(0.5).alias("peak"),
    )
    required = base.select(F.concat("song_id", F.when(i % 2 == 0, "").otherwise("-b")).alias("song_id")).distinct()
    return ct.singing_manifest(clips.unionByName(again), files, required, 0, 60_000, review=True)


# -- packages -------------------------------------------------------------------------

# Orders as training items; every rule is broken by the orders whose number one prime divides.
PACKAGE = """p AS (SELECT item_id AS i, 's' || lpad(CAST(item_id AS VARCHAR), 8, '0') AS name, count(*) AS n FROM item_elements GROUP BY item_id)"""


ROWS_PER_TASK = 1_000_000


def _package(t: Tables):
    i = F.col("item_id")
    name = F.concat(F.lit("s"), F.lpad(i.cast("string"), 8, "0")).alias("name")
    # Spread by rows: ids pack so well that by bytes alone tens of millions of them would come to one task.
    rows = t.item_elements()
    parts = max(int(t.spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS_PER_TASK))
    e = rows.repartition(parts, "item_id").groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("line", "part", "supp", "cents", "note_dur", "unit"))).alias("e"), F.sum("note_dur").alias("seconds"))
    seq = lambda f: F.array_join(F.transform("e", f), " ")
    phone = F.when(i % 13 == 0, 0).when(i % 5 == 0, 1).otherwise(2)
    length = lambda x: F.when(phone == 0, F.lit(0).cast("bigint")).when(phone == 1, x["note_dur"] + 1).otherwise(x["note_dur"])
    text = e.select(
        i, name, seq(lambda x: x["unit"]).alias("ph_seq"), seq(lambda x: length(x).cast("string")).alias("ph_dur"), F.concat(F.when(i % 7 == 0, "1 ").otherwise(""), seq(lambda x: F.lit("1"))).alias("ph_num"),
        seq(lambda x: F.lit("C4")).alias("note_seq"), seq(lambda x: x["note_dur"].cast("string")).alias("note_dur"), seq(lambda x: F.when(i % 29 == 0, "2").otherwise("0")).alias("note_slur"), "seconds",
    )
    wavs = text.where("item_id % 19 <> 0").select("name", F.when(i % 17 == 0, 48_000).otherwise(44_100).alias("sample_rate"), F.lit(1).alias("channels"), F.lit(16).alias("bit_depth"), (44_100 * (F.col("seconds") + F.when(i % 11 == 0, 1).otherwise(0))).alias("frames"))
    return text, wavs


@query(f"WITH {PACKAGE} " + _table({
    "TRAINING_WAV_METADATA": "SELECT count(*) FROM p WHERE i % 19 <> 0 AND i % 17 = 0",
    "TRAINING_TRANSCRIPTIONS_CONTRACT": "SELECT count(*) FROM p WHERE i % 13 = 0 OR i % 5 = 0 OR i % 7 = 0 OR i % 19 = 0 OR i % 11 = 0",
    "TRAINING_NAME_SETS": "SELECT count(*) FROM p WHERE i % 19 = 0 OR i % 23 = 0", "TRAINING_MANIFEST": "SELECT count(*) FROM p WHERE i % 23 <> 0 AND (i % 29 = 0 OR i % 31 = 0 OR i % 37 = 0)",
    "TRAINING_QA_FINAL": "SELECT count(*) FROM supplier WHERE s_suppkey % 3 = 1",
    "TRAINING_UPLOAD_SHA256SUMS": "SELECT count(*) FROM members m FULL JOIN registered r USING (path) WHERE m.sha256 IS DISTINCT FROM r.sha256",
    "TRAINING_SPLIT_DEVELOPMENT": "SELECT count(*) FROM p WHERE i % 41 = 0", "TRAINING_SPLIT_DEVELOPMENT_GROUPS": "SELECT 0",
    "TRAINING_SPLIT_FINAL": "SELECT count(*) FROM p WHERE i // 100 % 2 = 1", "TRAINING_SPLIT_FINAL_GROUPS": "SELECT 1",
}))
def training_package(t: Tables):
    """Items with prefix entries in their splits; one prefix stands for a hundred names."""
    i = F.col("item_id")
    text, wavs = _package(t)
    kind = F.when(i % 23 == 0, "exclude").when(i % 29 == 0, "weird").when(i % 4 == 0, F.lit(None)).otherwise("Training")
    manifest = text.select("name", kind.alias("record_type"), F.when(i % 31 == 0, "pending").otherwise("accepted").alias("review_status"), F.when(i % 37 == 0, 0.0).otherwise(1.0).alias("duration_sec"))
    whole = text.where("item_id % 41 <> 0").select(F.lit("development").alias("label"), F.when(i % 2 == 0, "train").otherwise("validation").alias("split"), F.col("name").alias("entry"))
    heads = text.where("item_id div 100 % 2 = 0").select(F.lit("final").alias("label"), F.lit("train").alias("split"), F.substring("name", 1, 7).alias("entry")).distinct()
    splits = ct.resolve_split_entries(whole.unionByName(heads), text.select("name"))
    flag = F.when(F.col("s_suppkey") % 3 == 0, "PASS").when(F.col("s_suppkey") % 3 == 1, "BLOCKED").otherwise("other")
    flags = t.read("supplier").select(F.col("s_name").alias("key"), flag.alias("value"))
    return ct.training_package(wavs, text.drop("item_id", "seconds"), manifest, splits, t.members().select("path", "sha256"), t.registered().select("path", "sha256"), flags)


@query(f"""WITH {PACKAGE} """ + _table({
    "TRAINING_ROWS": "SELECT 0", "MANIFEST_ROW_MISSING": "SELECT count(*) FROM p WHERE i % 23 = 0", "SEQUENCE_CONTRACT": "SELECT count(*) FROM p WHERE i % 7 = 0", "DURATION_CONTRACT": "SELECT count(*) FROM p WHERE i % 13 = 0 OR i % 5 = 0",
    "WAV_DECODE": "SELECT count(*) FROM p WHERE i % 19 = 0", "WAV_FORMAT": "SELECT count(*) FROM p WHERE i % 19 <> 0 AND i % 17 = 0", "WAV_DURATION_CONTRACT": "SELECT count(*) FROM p WHERE i % 19 <> 0 AND i % 11 = 0",
    "NOTE_SLUR_CONTRACT": "SELECT count(*) FROM p WHERE i % 23 <> 0 AND i % 29 = 0", "SOURCE_COVERAGE_CONTRACT": f"SELECT count(*) FROM ({QUERIES['coverage_contract'].sql}) WHERE state <> 'EQUAL'", "PENDING_ZERO": "SELECT count(*) FROM p WHERE i % 31 = 0",
}))
def final_dataset(t: Tables):
    i = F.col("item_id")
    text, wavs = _package(t)
    manifest = text.select("name", F.when(i % 23 == 0, "exclude").otherwise("training").alias("record_type"), F.when(i % 31 == 0, "pending").otherwise("accepted").alias("review_status"), "note_slur")
    return ct.final_dataset(text.drop("item_id", "note_slur", "seconds"), manifest, wavs, QUERIES["coverage_contract"].build(t))


LEGACY = "m AS (SELECT CASE WHEN page_id % 5 = 0 THEN 'd/' || page_id || '.ds' WHEN page_id = 3 THEN 'manifest.jsonl' ELSE 'f/' || page_id END AS path, sha256, page_id FROM members)"


@query(f"WITH {LEGACY}, {ITEM_SQL} " + _table({
    "DS_PRESENT": "SELECT 0", "MANIFEST_PRESENT": "SELECT CASE WHEN (SELECT count(*) FROM m WHERE path = 'manifest.jsonl') = 0 THEN 1 ELSE 0 END", "QA_PRESENT": "SELECT 1",
    "DS_PARSE": "SELECT sum(CASE WHEN np <> 64 THEN 1 ELSE 0 END + CASE WHEN sl[1] <> 0 THEN 1 ELSE 0 END + CASE WHEN len(list_filter(sl, lambda v: v = 0)) <> 1 THEN 1 ELSE 0 END + CASE WHEN list_min(nd) <= 0 THEN 1 ELSE 0 END) FROM it",
    "HASH": "SELECT count(*) FROM m WHERE page_id % 11 <> 0 AND (page_id % 7 = 0 OR page_id % 4 = 2)",
}))
def legacy_package(t: Tables):
    i = F.col("page_id")
    path = F.when(i % 5 == 0, F.concat(F.lit("d/"), i.cast("string"), F.lit(".ds"))).when(i == 3, "manifest.jsonl").otherwise(F.concat(F.lit("f/"), i.cast("string")))
    members = t.members().select(i, path.alias("path"), "sha256")
    checksums = t.registered().select(i, path.alias("path"), "sha256")
    return ct.legacy_package(members.where(i % 4 != 2).drop("page_id"), score_items(t), checksums.drop("page_id"))


@query("""WITH m AS (SELECT p_partkey, p_size, p_type, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) AS k, p_brand || '/' || p_type AS archive FROM part)
    SELECT archive, CASE WHEN count(*) >= 5 THEN 'training_dataset_v1' ELSE 'legacy' END AS package_type FROM m GROUP BY archive""")
def package_types(t: Tables):
    """The first parts of a brand and type carry the marker names of a training package."""
    p = t.read("part").select(F.concat_ws("/", "p_brand", "p_type").alias("archive"), "p_partkey")
    ranked = scan(p, ["archive"], ["p_partkey"], [row_number("k")])
    marks = F.array(*[F.lit(x) for x in ct.PACKAGE_MARKERS])
    return ct.package_type(ranked.select("archive", F.coalesce(F.get(marks, (F.col("k") - 1).cast("int")), F.lit("other.txt")).alias("member")))


@query("SELECT p_partkey, p_type AS status FROM part WHERE p_type NOT IN ('PROMO', 'SMALL')")
def status_words(t: Tables):
    return ct.status_words(t.read("part").select("p_partkey", F.col("p_type").alias("status")), allowed=("PROMO", "SMALL"))


# -- candidates -----------------------------------------------------------------------

ENTRIES = r"""e0 AS (SELECT p_partkey AS i, CASE WHEN p_partkey % 11 = 0 THEN '' ELSE p_name END AS key, CASE WHEN p_partkey % 17 = 0 THEN [] ELSE string_split(split_part(p_name, ' ', 1), '') END AS ph FROM part),
    en AS (SELECT *, i % 11 = 0 OR i % 7 = 0 OR i % 17 = 0 AS incomplete, len(list_filter(ph, lambda x: x IN ('g', 'w'))) > 0 AS unknown FROM e0)"""
ALLOWED = [c for c in "abcdefghijklmnopqrstuvwxyz" if c not in "gw"]


def _entries(t: Tables):
    i = F.col("p_partkey")
    none = F.array().cast("array<string>")
    key = F.when(i % 11 == 0, "").otherwise(F.col("p_name"))
    rows = t.read("part").select(i.alias("phrase_id"), key.alias("key"), F.when(i % 17 == 0, none).otherwise(F.split(F.split_part("p_name", F.lit(" "), F.lit(1)), "")).alias("phones"), F.when(i % 7 == 0, none).otherwise(F.split("p_name", "")).alias("raw_tokens"), (i % 3 == 0).alias("latin_text"))
    variant = fn.variant_hash(F.col("key"), F.col("phones"))
    return rows.withColumn("dictionary_variant", F.when(F.col("phrase_id") % 5 == 0, F.reverse(variant)).otherwise(variant))


@query(f"""WITH {ENTRIES} SELECT i AS phrase_id, unnest(list_filter([CASE WHEN incomplete THEN 'CANDIDATE_ENTRY_INCOMPLETE' END, CASE WHEN unknown THEN 'CANDIDATE_UNKNOWN_PHONEME' END,
      CASE WHEN i % 5 = 0 THEN 'CANDIDATE_VARIANT_HASH_MISMATCH' END, CASE WHEN i % 3 = 0 THEN 'LATIN_READING_REQUIRES_REVIEW' END], lambda x: x IS NOT NULL)) AS type FROM en""")
def candidate_entries(t: Tables):
    return ct.candidate_entries(_entries(t), ALLOWED)


@query(f"""WITH {ENTRIES}, n AS (SELECT song_id, count(*) AS n FROM mono_notes GROUP BY song_id) """ + _table({
    "SOURCE_HASH": "SELECT count(*) FROM members m LEFT JOIN registered r USING (path) WHERE r.sha256 IS DISTINCT FROM m.sha256", "G2P_FILES": "SELECT count(*) FROM en WHERE unknown OR len(ph) = 0",
    "NOTE_FILES": "SELECT count(*) FROM n WHERE song_id % 3 = 0 AND song_id % 5 <> 0",
    "NOTE_TIMING": "SELECT (SELECT count(*) FROM mono_notes WHERE end_us <= start_us OR note_index % 50 = 7) + (SELECT count(*) FROM (SELECT *, max(end_us) OVER (PARTITION BY song_id ORDER BY note_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM mono_notes) WHERE start_us < m)",
    "CANDIDATE_REPORTS": "SELECT count(*) FROM (SELECT DISTINCT issue_id FROM issues WHERE issue_id NOT IN (SELECT issue_id FROM issues WHERE status = 'accepted'))",
}))
def candidate_stage(t: Tables):
    now = t.registered().select("path", F.col("sha256").alias("now_sha256"))
    sources = t.members().select("path", "sha256").join(now, "path", "left")
    assigned = t.mono_notes().withColumn("note_slur", F.when(F.col("note_index") % 50 == 7, 2).otherwise(F.col("note_index") % 2))
    count = F.count(F.lit(1)) + F.when(F.col("song_id") % 3 == 0, 1).otherwise(0)
    reported = t.notes().groupBy("song_id").agg(F.when(F.col("song_id") % 5 == 0, 0).otherwise(count).alias("mapped_notes"))
    issues = t.issues()
    return ct.candidate_stage(sources, _entries(t), ALLOWED, assigned, reported, issues.select("issue_id").distinct(), issues.where("status = 'accepted'").select("issue_id").distinct(), t.hot_songs)


# -- jobs -----------------------------------------------------------------------------

IMPORT = """r AS (SELECT doc_id AS line, source || '_32k_mono.wav_' || doc_id || '.wav' AS audio_name, source, text, doc_id % 12 + 1 AS sec, doc_id % 9 = 0 AS gone, doc_id % 7 = 0 AS other FROM documents), g AS (SELECT *, row_number() OVER (ORDER BY line) AS n FROM r WHERE NOT gone AND NOT other),
    b AS (SELECT line FROM g WHERE n > 100 AND sec BETWEEN 3 AND 10 ORDER BY line LIMIT 3)"""


def _imported(t: Tables):
    i = F.col("doc_id")
    docs = t.read("documents")
    name = F.concat("source", F.lit("_32k_mono.wav_"), i.cast("string"), F.lit(".wav")).alias("audio_name")
    wavs = docs.where("doc_id % 9 <> 0").select(name, F.when(i % 7 == 0, 16_000).otherwise(32_000).alias("sample_rate"), F.lit(1).alias("channels"), F.lit(16).alias("bit_depth"), ((i % 12 + 1) * 32_000).alias("frames"), F.md5("text").alias("sha256"))
    return jobs.speech_import(docs.select(i.alias("line"), name, "text"), wavs)


@query(f"""WITH {IMPORT} SELECT 'original-' || CASE WHEN n < 1000000 THEN lpad(CAST(n AS VARCHAR), 6, '0') ELSE CAST(n AS VARCHAR) END AS id, 'audio/' || audio_name AS audio_relpath, source AS recording_group, md5(text) AS sha256, CAST(sec AS DOUBLE) AS duration_sec,
      CASE WHEN n <= 100 THEN 'smoke_train' WHEN line IN (SELECT line FROM b) THEN 'smoke_benchmark' ELSE 'train' END AS split, (SELECT count(*) FROM b) >= 3 AS enough FROM g""")
def speech_import(t: Tables):
    return _imported(t)[0].select("id", "audio_relpath", "recording_group", "sha256", "duration_sec", "split", "enough")


@query(f"WITH {IMPORT} SELECT line, audio_name, CASE WHEN gone THEN 'AUDIO_MISSING_OR_UNREADABLE' ELSE 'AUDIO_FORMAT' END AS reason FROM r WHERE gone OR other")
def speech_import_errors(t: Tables):
    return _imported(t)[1]


FROZEN = """x AS (SELECT song_id, max(end_us) - 43200000000 AS extent FROM windows WHERE song_id % 7 <> 0 GROUP BY song_id), f AS (SELECT w.*, CASE WHEN (start_us // 86400000000) % 3 = 0 THEN 'rejected' ELSE 'accepted' END AS status,
      CASE WHEN extent IS NULL THEN 'SONG_MISSING' WHEN (start_us // 86400000000) % 5 = 0 THEN 'WINDOW_RANGE' WHEN end_us > extent THEN 'WINDOW_BEYOND_SOURCE' END AS issue FROM windows w LEFT JOIN x USING (song_id))"""


def _frozen(t: Tables):
    day = F.expr("start_us div 86400000000")
    windows = t.windows()
    songs = windows.where("song_id % 7 <> 0").groupBy("song_id").agg((F.max("end_us") - 43_200_000_000).alias("extent")).select("*", F.col("song_id").cast("string").alias("path"), F.lit("h").alias("sha256"))
    rows = windows.withColumn("status", F.when(day % 3 == 0, "rejected").otherwise("accepted")).withColumn("end_us", F.when(day % 5 == 0, F.col("start_us") - 1).otherwise(F.col("end_us")))
    files = songs.where("song_id % 5 <> 1").select("path", F.when(F.col("song_id") % 4 == 0, "other").otherwise("h").alias("sha256"))
    return jobs.freeze(rows, songs, files, 0)


@query(f"WITH {FROZEN} SELECT song_id, clip_id, status FROM f WHERE issue IS NULL")
def frozen_windows(t: Tables):
    accepted, rejected, _, _ = _frozen(t)
    return accepted.unionByName(rejected).select("song_id", "clip_id", "status")


@query(f"WITH {FROZEN} SELECT song_id, clip_id, issue FROM f WHERE issue IS NOT NULL")
def frozen_window_issues(t: Tables):
    return _frozen(t)[2]


@query(f"WITH {FROZEN} SELECT CAST(song_id AS VARCHAR) AS path, CASE WHEN song_id % 5 = 1 THEN 'MISSING' ELSE 'sha256_mismatch' END AS kind FROM x WHERE song_id % 5 = 1 OR song_id % 4 = 0")
def frozen_differences(t: Tables):
    return _frozen(t)[3]


@query("""SELECT w.clip_id, w.start_us AS window_start, w.end_us AS window_end, w.song_id % 4 AS score FROM windows w WHERE (w.start_us // 86400000000) % 4 <> 1""")
def carried_candidates(t: Tables):
    """Candidates of every window, on the windows of a version that dropped some days."""
    windows = t.windows()
    kept = windows.where("start_us div 86400000000 % 4 <> 1")
    return jobs.carry_candidates(windows.select("clip_id", (F.col("song_id") % 4).alias("score")), kept)[0]


@query("SELECT clip_id FROM windows WHERE (start_us // 86400000000) % 4 = 1")
def candidates_without_window(t: Tables):
    windows = t.windows()
    return jobs.carry_candidates(windows.select("clip_id", F.lit(1).alias("score")), windows.where("start_us div 86400000000 % 4 <> 1"))[1]


@query(f"SELECT n.song_id, n.note_index, n.pitch, n.start_us, coalesce(r.new_end, n.end_us) AS end_us FROM notes n LEFT JOIN ({QUERIES['gap_repairs'].sql}) r ON r.song_id = n.song_id AND r.note_index = n.note_index")
def gap_repaired_notes(t: Tables):
    """All notes, those left of a repaired gap extended to the next one."""
    fixed = jobs.gap_repair(t.notes(), gap_rows(t), 600 * MINUTE_US, t.hot_songs)[1]
    return fixed.select("song_id", "note_index", "pitch", "start_us", "end_us")


VERIFIED = f"v AS ({QUERIES['model_files_verify'].sql})"


def _release(t: Tables):
    i = F.col("name")
    register, found = model_files(t)
    staged = register.where(i % 3 != 1).select("name", F.when(i % 2 == 0, "older").otherwise(F.col("sha256")).alias("sha256"))
    return jobs.release_plan(register, staged, found)


@query(f"""WITH {VERIFIED} SELECT name, sha256, CASE WHEN name % 3 = 1 THEN 'COPY' WHEN name % 2 = 0 THEN 'CONFLICT' ELSE 'SKIP' END AS action
    FROM v JOIN (SELECT page_id AS name, CASE WHEN page_id % 7 = 0 THEN 'x' ELSE sha256 END AS sha256 FROM members) USING (name) WHERE state = 'OK'""")
def release_plan(t: Tables):
    """Register rows that verify, against what is staged already."""
    return _release(t)[0]


@query(f"WITH {VERIFIED} SELECT name, state FROM v WHERE state <> 'OK'")
def release_problems(t: Tables):
    return _release(t)[1]


@query("""WITH b AS (SELECT clip_id AS "left", clip_id + 1 AS "right", duration_ms // 700 * 700 AS frame FROM clips)
    SELECT "left", "right", frame, CASE WHEN frame > 0 THEN frame // 700 END AS left_chunk, CASE WHEN frame < c.duration_ms THEN frame // 700 + 1 END AS right_chunk FROM b LEFT JOIN clips c ON c.clip_id = "right" """)
def boundary_chunks(t: Tables):
    """Chunks that end and start at a frame where two clips could meet."""
    clips = t.clips().select("clip_id", "duration_ms")
    chunks = sg.chunk_plan(clips.withColumnRenamed("clip_id", "region"), ["region"], "duration_ms", 700, 50, 60)
    bounds = clips.select(F.col("clip_id").alias("left"), (F.col("clip_id") + 1).alias("right"), (F.expr("duration_ms div 700") * 700).alias("frame"))
    return sg.boundary_chunks(bounds, chunks)


@query("""WITH d AS (SELECT item_id, CASE WHEN note_slur = 0 THEN 0 ELSE note_dur END AS v, (line, part, supp, cents) AS pl, CASE item_id % 4 WHEN 0 THEN 0.5 WHEN 1 THEN 3 WHEN 2 THEN -1 ELSE 0 END AS gap FROM item_elements),
    s AS (SELECT item_id, CAST(sum(v) AS DOUBLE) AS total, CAST(max_by(v, pl) FILTER (WHERE v > 0) AS DOUBLE) AS last, CAST(any_value(gap) AS DOUBLE) AS gap FROM d GROUP BY item_id)
    SELECT item_id, CASE WHEN abs(gap) <= 1 AND last + gap > 0 THEN total + gap ELSE total END AS total, CASE WHEN abs(gap) <= 1 AND last + gap > 0 THEN last + gap ELSE last END AS last FROM s""")
def reconciled_lengths(t: Tables):
    """The last sounding element takes a small difference to the target length."""
    i = F.col("item_id")
    row = F.struct("line", "part", "supp", "cents", F.when(F.col("note_slur") == 0, 0.0).otherwise(F.col("note_dur").cast("double")).alias("v"))
    items = t.item_elements().groupBy("item_id").agg(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["v"]).alias("d"))
    gap = F.when(i % 4 == 0, 0.5).when(i % 4 == 1, 3.0).when(i % 4 == 2, -1.0).otherwise(0.0)
    fixed = items.select("item_id", sq.reconcile_length(F.col("d"), fn.total(F.col("d")) + gap, 1.0).alias("d"))
    return fixed.select("item_id", fn.total(F.col("d")).alias("total"), F.try_element_at(F.filter("d", lambda v: v > 0), F.lit(-1)).alias("last"))


NORMAL = """n AS (SELECT item_id, list(unit ORDER BY line, part, supp, cents) AS u, list(cents / 700.0 * CASE line % 3 WHEN 0 THEN 1 WHEN 1 THEN 1e-9 ELSE 1e8 END ORDER BY line, part, supp, cents) AS x, list(note_dur ORDER BY line, part, supp, cents) AS d FROM item_elements GROUP BY item_id)"""


@query(f"""WITH {NORMAL} SELECT CASE WHEN item_id % 3 = 0 THEN 'song' ELSE 'n' || item_id END AS name, array_to_string(u, ' ') AS ph_seq, array_to_string(list_transform(x, lambda v: printf('%.10g', v)), ' ') AS ph_dur,
      array_to_string(list_transform(u, lambda v: '1'), ' ') AS ph_num, array_to_string(u, ' ') AS note_seq, array_to_string(d, ' ') AS note_dur FROM n""")
def training_columns(t: Tables):
    """Items with loose blanks and long numbers, normalised, in the columns of a training table."""
    return sq.training_columns(sq.normalize_items(_loose_items(t), "song", 0.0))


@query("SELECT item_id, CASE WHEN item_id % 4 = 0 THEN 2.5 ELSE 0.75 END AS \"offset\", '' AS text, CASE WHEN item_id % 5 = 0 THEN 'en' ELSE 'ja' END AS lang, CASE WHEN item_id % 7 = 0 THEN 0.01 ELSE 0.005 END AS f0_timestep, '220 0.5' AS f0_seq FROM item_elements GROUP BY item_id")
def normalized_items(t: Tables):
    """What absent fields of an item become."""
    return sq.normalize_items(_loose_items(t), "song", 0.75).select("item_id", "offset", "text", "lang", "f0_timestep", "f0_seq")


def _loose_items(t: Tables):
    i = F.col("item_id")
    factor = F.when(F.col("line") % 3 == 0, 1.0).when(F.col("line") % 3 == 1, 1e-9).otherwise(1e8)
    row = F.struct("line", "part", "supp", "cents", "unit", "note_dur", (F.col("cents") / 700.0 * factor).alias("x"))
    e = t.item_elements().groupBy("item_id").agg(F.array_sort(F.collect_list(row)).alias("e"))
    seq = lambda f: F.concat(F.lit(" "), F.array_join(F.transform("e", f), " \t "))
    return e.select(
        i, F.when(i % 3 != 0, F.concat(F.lit("n"), i.cast("string"))).alias("name"), F.when(i % 4 == 0, "2.5").alias("offset"), F.when(i % 5 == 0, "en").alias("lang"), F.when(i % 7 != 0, "0.005").alias("f0_timestep"),
        seq(lambda x: x["unit"]).alias("ph_seq"), seq(lambda x: F.lit("1")).alias("ph_num"), seq(lambda x: x["unit"]).alias("note_seq"), seq(lambda x: x["note_dur"].cast("string")).alias("note_dur"),
        seq(lambda x: x["x"].cast("string")).alias("ph_dur"), F.lit("220.0  0.50").alias("f0_seq"),
    )
