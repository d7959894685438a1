"""Manifest, integrity, split and issue queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..operators import issues as iss
from ..operators import manifest as mf
from ..operators import trees as tr
from ..operators.scans import row_number, scan
from ..sources import versions
from ..sources.records import csv_records, csv_table
from .registry import query
from .views import Tables


@query("""SELECT clip_id, nullif(concat_ws(',', CASE WHEN status <> 'accepted' THEN 'status_not_accepted' END,
    CASE WHEN singer_status <> 'confirmed' THEN 'singer_not_confirmed' END,
    CASE WHEN quality <> 'clean' THEN 'quality_not_clean' END), '') AS reject_reason FROM clips""")
def clip_review_reasons(t: Tables):
    return mf.review_reasons(t.clips()).select("clip_id", "reject_reason")


def _songs(t: Tables):
    """Songs of the clips: every fifth source is unknown, some have no split or no file."""
    n = F.regexp_extract("song_id", r"(\d+)", 1).cast("bigint")
    songs = t.clips().select("song_id").distinct().where(n % 5 != 0)
    split = F.when(n % 7 == 1, F.lit("")).otherwise("train")
    return songs.select("song_id", split.alias("song_split"), F.when(n % 9 == 2, F.lit("")).otherwise(F.col("song_id")).alias("source_path"))


SONGS = r"""songs AS (SELECT song_id, CASE WHEN n % 7 = 1 THEN '' ELSE 'train' END AS song_split,
    CASE WHEN n % 9 = 2 THEN '' ELSE song_id END AS source_path
    FROM (SELECT DISTINCT song_id, CAST(regexp_extract(song_id, '(\d+)', 1) AS BIGINT) AS n FROM clips) WHERE n % 5 <> 0)"""


@query(f"""WITH {SONGS} SELECT clip_id, CASE WHEN song_split IS NULL THEN 'song_missing' WHEN song_split = '' THEN 'split_unassigned'
    WHEN duration_ms NOT BETWEEN 3000 AND 12000 THEN 'duration_out_of_range' WHEN source_path = '' THEN 'source_missing' END AS reject_reason
    FROM clips LEFT JOIN songs USING (song_id)""")
def clip_first_reason(t: Tables):
    return mf.build_reasons(t.clips(), _songs(t)).select("clip_id", "reject_reason")


@query(f"""WITH {SONGS} SELECT clip_id, song_id, 'song_missing' AS type FROM clips c WHERE NOT EXISTS (SELECT 1 FROM songs s WHERE s.song_id = c.song_id)""")
def unmatched_lookup(t: Tables):
    return t.clips().join(_songs(t), "song_id", "left_anti").select("clip_id", "song_id", F.lit("song_missing").alias("type"))


@query("""WITH r AS (SELECT clip_id AS line, unnest(list_filter([
      CASE WHEN language <> 'fr' THEN 'text_language' END,
      CASE WHEN status = 'review' THEN 'invalid_values' END,
      CASE WHEN status = 'rejected' AND split <> 'benchmark' THEN 'reject_in_training' END,
      CASE WHEN duration_ms < 100 THEN 'missing_values' END], lambda x: x IS NOT NULL)) AS code FROM clips)
    SELECT line, code FROM r""")
def manifest_errors(t: Tables):
    return mf.field_issues(t.clips().withColumnRenamed("clip_id", "line"), "line", _rules())


def _rules():
    return {
        "text_language": F.col("language") != "fr",
        "invalid_values": ~F.col("status").isin("accepted", "rejected"),
        "reject_in_training": (F.col("status") == "rejected") & (F.col("split") != "benchmark"),
        "missing_values": F.col("duration_ms") < 100,
    }


@query("""SELECT code, count(*) AS rows, min(line) AS first_line, max(line) AS last_line FROM (
    SELECT clip_id AS line, 'text_language' AS code FROM clips WHERE language <> 'fr'
    UNION ALL SELECT clip_id, 'invalid_values' FROM clips WHERE status = 'review'
    UNION ALL SELECT clip_id, 'reject_in_training' FROM clips WHERE status = 'rejected' AND split <> 'benchmark'
    UNION ALL SELECT clip_id, 'missing_values' FROM clips WHERE duration_ms < 100) GROUP BY code""")
def error_report(t: Tables):
    return mf.error_report(mf.field_issues(t.clips().withColumnRenamed("clip_id", "line"), "line", _rules()))


@query(r"""SELECT page_id, NOT (path = '' OR path LIKE '/%' OR regexp_matches(path, '^[A-Za-z]:') OR regexp_matches(path, '(^|/)\.\.(/|$)')) AS safe
    FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN '/' || replace(path, ':', '') WHEN 1 THEN 'a/../' || path ELSE path END AS path FROM members)""")
def path_safety(t: Tables):
    kind = F.col("page_id") % 4
    path = F.when(kind == 0, F.concat(F.lit("/"), F.replace("path", F.lit(":"), F.lit(""))))
    path = path.when(kind == 1, F.concat(F.lit("a/../"), F.col("path"))).otherwise(F.col("path"))
    return t.members().select("page_id", path.alias("path")).select("page_id", fn.safe_path(F.col("path")).alias("safe"))


@query("""SELECT 'audio_sha256' AS field, audio_sha256 AS value, count(*) AS copies FROM clips GROUP BY audio_sha256 HAVING count(*) > 1
    UNION ALL SELECT 'clip_id', CAST(clip_id AS VARCHAR), count(*) FROM clips GROUP BY clip_id HAVING count(*) > 1""")
def duplicates(t: Tables):
    c = t.clips().select("clip_id", "audio_sha256")
    return mf.duplicates(c, F.col("audio_sha256"), "audio_sha256").unionByName(mf.duplicates(c, F.col("clip_id").cast("string"), "clip_id"))


@query("""SELECT audio_sha256, count(DISTINCT split) AS split_count, concat_ws(',', CASE WHEN bool_or(split = 'train') THEN 'train' END,
    CASE WHEN bool_or(split = 'validation') THEN 'validation' END, CASE WHEN bool_or(split = 'benchmark') THEN 'benchmark' END) AS splits
    FROM clips GROUP BY audio_sha256 HAVING count(DISTINCT split) > 1""")
def split_leakage(t: Tables):
    return mf.split_leakage(t.clips().select("audio_sha256", "split"), "audio_sha256")


@query("""SELECT song_id, duration_ms, total_ms, round(duration_ms / total_ms, 6) AS share, duration_ms * 3 > total_ms AS over FROM (
    SELECT song_id, CAST(sum(duration_ms) AS BIGINT) AS duration_ms, CAST(sum(sum(duration_ms)) OVER () AS BIGINT) AS total_ms
    FROM clips GROUP BY song_id)""")
def song_share(t: Tables):
    return mf.song_share(t.clips().select("song_id", "duration_ms"))


@query("""SELECT category, CAST(sum(n) AS BIGINT) AS clips, CAST(sum(CASE WHEN n > 0 THEN 1 ELSE 0 END) AS BIGINT) AS songs,
       sum(n) < 3 OR sum(CASE WHEN n > 0 THEN 1 ELSE 0 END) < 2 AS insufficient FROM (
    SELECT 'high' AS category, song_id, sum(CASE WHEN duration_ms >= 9500 THEN 1 ELSE 0 END) AS n FROM clips GROUP BY song_id
    UNION ALL SELECT 'clean', song_id, sum(CASE WHEN quality = 'clean' THEN 1 ELSE 0 END) FROM clips GROUP BY song_id
    UNION ALL SELECT 'none', song_id, sum(CASE WHEN duration_ms < 0 THEN 1 ELSE 0 END) FROM clips GROUP BY song_id) GROUP BY category""")
def coverage_categories(t: Tables):
    groups = {"high": F.col("duration_ms") >= 9500, "clean": F.col("quality") == "clean", "none": F.col("duration_ms") < 0}
    return mf.coverage(t.clips(), groups, "song_id")


@query("""SELECT clip_id, CASE WHEN duration_ms >= 9500 THEN 'true' ELSE 'false' END AS long_note,
    CASE WHEN duration_ms < 400 THEN 'weak' WHEN duration_ms >= 3500 THEN 'high' ELSE 'mid_low' END AS register FROM clips""")
def threshold_buckets(t: Tables):
    register = F.when(F.col("duration_ms") < 400, "weak").when(F.col("duration_ms") >= 3500, "high").otherwise("mid_low")
    long_note = F.when(F.col("duration_ms") >= 9500, "true").otherwise("false")
    return t.clips().select("clip_id", long_note.alias("long_note"), register.alias("register"))


@query("""SELECT c.clip_id, c.audio_sha256 FROM clips c WHERE NOT EXISTS (SELECT 1 FROM clips o JOIN labels l ON l.doc_id = o.clip_id
    WHERE o.audio_sha256 = c.audio_sha256 AND l.quality = 1)""")
def append_only_new(t: Tables):
    known = t.clips().where("status = 'accepted'").select("audio_sha256")
    return t.clips().join(known, "audio_sha256", "left_anti").select("clip_id", "audio_sha256")


@query("SELECT DISTINCT doc_id AS clip_id FROM labels l WHERE NOT EXISTS (SELECT 1 FROM clips c WHERE c.clip_id = l.doc_id AND c.split = 'train')")
def missing_required(t: Tables):
    need = t.read("labels").select(F.col("doc_id").alias("clip_id")).distinct()
    return need.join(t.clips().where("split = 'train'").select("clip_id"), "clip_id", "left_anti")


@query("""SELECT m.page_id, 'UNREGISTERED' AS kind FROM members m ANTI JOIN registered r ON m.page_id = r.page_id
    UNION ALL SELECT m.page_id, 'sha256_mismatch' FROM members m JOIN registered r ON m.page_id = r.page_id WHERE m.sha256 <> r.sha256
    UNION ALL SELECT r.page_id, 'MISSING' FROM registered r ANTI JOIN members m ON m.page_id = r.page_id""")
def integrity_mismatches(t: Tables):
    return mf.integrity(t.members(), t.registered(), "page_id", ["sha256"])


@query("""SELECT CAST(sum(CASE WHEN a = b THEN 1 ELSE 0 END) AS BIGINT) AS equal, CAST(sum(CASE WHEN a <> b THEN 1 ELSE 0 END) AS BIGINT) AS different,
    CAST(sum(CASE WHEN b IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unreferenced, CAST(sum(CASE WHEN a IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing,
    sum(CASE WHEN a = b THEN 0 ELSE 1 END) = 0 AS passed
    FROM (SELECT m.sha256 AS a, r.sha256 AS b FROM members m FULL JOIN registered r USING (path))""")
def checksum_reconcile(t: Tables):
    return mf.reconcile(t.members(), t.registered(), "path", "sha256")


@query("""SELECT m.path, m.sha256, CASE WHEN r.sha256 IS NULL THEN 'COPY' WHEN r.sha256 = m.sha256 THEN 'SKIP' ELSE 'CONFLICT' END AS action
    FROM members m LEFT JOIN registered r USING (path)""")
def copy_plan(t: Tables):
    return mf.copy_plan(t.members(), t.registered(), "path", "sha256")


@query("""SELECT clip_id, CASE WHEN starts_with(name, 'src1') THEN 'train' WHEN starts_with(name, 'src2_') OR starts_with(name, 'src9_') THEN 'validation'
    WHEN starts_with(name, 'src3_') THEN 'benchmark' END AS assigned FROM (SELECT clip_id, song_id || '_' || clip_id AS name FROM clips)""")
def split_by_prefix(t: Tables):
    policy = [("src1", "train"), ("src2_", "validation"), ("src9_", "validation"), ("src3_", "benchmark")]
    named = t.clips().select("clip_id", F.concat_ws("_", "song_id", F.col("clip_id").cast("string")).alias("name"))
    return mf.split_by_prefix(named, "name", policy).drop("name")


@query("""SELECT id, CAST(sum(a) AS BIGINT) AS audio, CAST(sum(l) AS BIGINT) AS labelled, CAST(sum(n) AS BIGINT) AS listed FROM (
    SELECT clip_id AS id, 1 AS a, 0 AS l, 0 AS n FROM clips UNION ALL SELECT doc_id, 0, 1, 0 FROM labels
    UNION ALL SELECT clip_id, 0, 0, 1 FROM clips WHERE split <> 'benchmark') GROUP BY id HAVING sum(a) <> 1 OR sum(l) <> 1 OR sum(n) <> 1""")
def id_set_equality(t: Tables):
    c = t.clips().select(F.col("clip_id").alias("id"), "split")
    return mf.id_sets({"audio": c, "labelled": t.read("labels").select(F.col("doc_id").alias("id")), "listed": c.where("split <> 'benchmark'")}, "id")


@query("""WITH r AS (SELECT *, row_number() OVER (ORDER BY clip_id) AS rn FROM clips),
    b AS (SELECT clip_id FROM r WHERE rn > 100 AND duration_ms BETWEEN 300 AND 1000 ORDER BY clip_id LIMIT 3)
    SELECT clip_id, CASE WHEN rn <= 100 THEN 'smoke_train' WHEN clip_id IN (SELECT clip_id FROM b) THEN 'smoke_benchmark' ELSE 'train' END AS assigned,
           (SELECT count(*) FROM b) >= 3 AS enough FROM r""")
def rank_limited_split(t: Tables):
    rows = t.clips().select("clip_id", "duration_ms")
    return mf.rank_limited_split(rows, "clip_id", "duration_ms", 100, 3, 300, 1000).drop("duration_ms")


@query("SELECT clip_id, 'original-' || lpad(CAST(row_number() OVER (ORDER BY audio_sha256, clip_id) AS VARCHAR), 6, '0') AS seq_id FROM clips")
def sequential_ids(t: Tables):
    return mf.sequential_ids(t.clips().select("clip_id", "audio_sha256"), ["audio_sha256", "clip_id"], "original-").drop("audio_sha256")


@query("""WITH w AS (SELECT song, id, blanks + 1 AS weight FROM captions),
    f AS (SELECT song, count(*) AS n, CAST(sum(weight) AS BIGINT) AS sw, CAST(sum(duration_ms) // 1000 + count(*) AS BIGINT) AS total
          FROM (SELECT *, blanks + 1 AS weight FROM captions) GROUP BY song),
    q AS (SELECT w.song, id, weight, n, total, (total - n) * weight // sw AS fl, (total - n) * weight % sw AS rem FROM w JOIN f USING (song)),
    r AS (SELECT *, row_number() OVER (PARTITION BY song ORDER BY rem DESC, id) AS rn, sum(fl) OVER (PARTITION BY song) AS given FROM q)
    SELECT song, id, weight, total, CAST(1 + fl + CASE WHEN rn <= total - n - given THEN 1 ELSE 0 END AS BIGINT) AS allocated FROM r""")
def largest_remainder(t: Tables):
    c = t.captions()
    rows = c.select("song", "id", (F.col("blanks") + 1).alias("weight"))
    totals = c.groupBy("song").agg((F.expr("sum(duration_ms) div 1000") + F.count(F.lit(1))).alias("total"))
    return mf.allocate(rows, totals, ["song"], "id", "weight", t.hot_conversations)


# Buckets at the depth that the number of members asks for, then every level above, up to eight.
TREE = """m AS MATERIALIZED (SELECT DISTINCT path, sha256, sha256(path) AS place, sha256(path || chr(9) || sha256) AS entry FROM members),
    d AS MATERIALIZED (SELECT min(k) AS depth FROM range(0, 9) AS r(k), (SELECT count(*) AS n FROM m) WHERE n <= 64 * pow(16, k)),
    t8 AS (SELECT substr(place, 1, 8) AS node, sha256(string_agg(entry, chr(10) ORDER BY entry)) AS h, count(*) AS n FROM m, d WHERE depth = 8 GROUP BY ALL)""" + "".join(
    f""", t{k} AS (SELECT substr(place, 1, {k}) AS node, sha256(string_agg(entry, chr(10) ORDER BY entry)) AS h, count(*) AS n FROM m, d WHERE depth = {k} GROUP BY ALL
      UNION ALL SELECT substr(node, 1, {k}), sha256(string_agg(substr(node, {k + 1}, 1) || ' ' || h, chr(10) ORDER BY node)), sum(n) FROM t{k + 1} GROUP BY ALL)"""
    for k in range(7, -1, -1)
)


@query(f"WITH {TREE} SELECT h AS fingerprint, CAST(n AS BIGINT) AS members, depth FROM t0, d")
def tree_fingerprint(t: Tables):
    return tr.tree_fingerprint(t.members())


@query("""WITH l AS (SELECT DISTINCT path, sha256 FROM registered), r AS (SELECT DISTINCT path, sha256 FROM members)
    SELECT path, sha256 AS digest, 'REMOVED' AS state FROM l WHERE (path, sha256) NOT IN (SELECT (path, sha256) FROM r)
    UNION ALL SELECT path, sha256, 'ADDED' FROM r WHERE (path, sha256) NOT IN (SELECT (path, sha256) FROM l)""")
def tree_diff(t: Tables):
    return tr.tree_diff(t.registered(), t.members())


@query("""WITH b AS (SELECT path, list(sha256 ORDER BY sha256) AS l FROM registered GROUP BY path), n AS (SELECT path, list(sha256 ORDER BY sha256) AS l FROM members GROUP BY path)
    SELECT coalesce(n.path, b.path) AS path, CASE WHEN b.path IS NULL THEN 'NEW' WHEN n.path IS NULL THEN 'GONE' WHEN n.l = b.l THEN 'SAME' ELSE 'CHANGED' END AS change FROM n FULL JOIN b ON n.path = b.path""")
def publish_changes(t: Tables):
    """What the next version has to build: keys whose inputs are new, changed or gone."""
    now, before = (versions.fingerprints(rows.select("path", "sha256"), ["path"]) for rows in (t.members(), t.registered()))
    return versions.changes(now, before, ["path"])


@query("""WITH i AS (SELECT DISTINCT user_id AS job, event_type AS path, md5(CAST(event_id AS VARCHAR)) AS sha256 FROM events),
    b AS (SELECT job, substr(sha256(path), 1, 3) AS b, sha256(string_agg(sha256(path || chr(9) || sha256), chr(10) ORDER BY sha256(path || chr(9) || sha256))) AS h, count(*) AS n FROM i GROUP BY ALL),
    c AS (SELECT job, sha256(string_agg(b || ' ' || h, chr(10) ORDER BY b)) AS content, CAST(sum(n) AS BIGINT) AS n FROM b GROUP BY job)
    SELECT c_custkey AS job, sha256(sha256('{"c_mktsegment":"' || c_mktsegment || '","c_nationkey":' || c_nationkey || '}') || chr(10) || coalesce(content, '')) AS fingerprint, coalesce(n, 0) AS inputs
    FROM customer LEFT JOIN c ON job = c_custkey""")
def job_fingerprints(t: Tables):
    jobs = t.read("customer").select(F.col("c_custkey").alias("job"), "c_nationkey", "c_mktsegment")
    inputs = t.read("events").select(F.col("user_id").alias("job"), F.col("event_type").alias("path"), F.md5(F.col("event_id").cast("string")).alias("sha256"))
    return tr.job_fingerprints(jobs, inputs, "job", ["c_nationkey", "c_mktsegment"])


@query("SELECT conv_id, CAST(turn AS VARCHAR) AS turn, role, text FROM conversations")
def csv_split_records(t: Tables):
    return csv_table(_csv_records(t), ["turn", "role", "text"])[0].select(F.col("file").alias("conv_id"), "turn", "role", "text")


@query("""SELECT conv_id, count(*) AS lines, CAST(sum(len(text) - len(replace(text, chr(10), '')) + 1) AS BIGINT) AS physical FROM conversations GROUP BY conv_id""")
def csv_lines_per_record(t: Tables):
    lines, records = _csv_lines(t), _csv_records(t)
    heads = records.where("record > 0").groupBy(F.col("file").alias("conv_id")).agg(F.count(F.lit(1)).alias("lines"))
    return heads.join(lines.where("line > 1").groupBy(F.col("file").alias("conv_id")).agg(F.count(F.lit(1)).alias("physical")), "conv_id")


@query("""SELECT conv_id AS file, role, count(*) AS rows FROM conversations GROUP BY ALL HAVING count(*) > 1""")
def csv_duplicate_keys(t: Tables):
    table, issues = csv_table(_csv_records(t), ["role"], "role")
    return issues.where("type = 'DUPLICATE_KEY'").join(table, ["file", "line"]).groupBy("file", "role").agg(F.count(F.lit(1)).alias("rows"))


def _csv_lines(t: Tables):
    """Every conversation as the lines of a CSV file: a header, then turns whose texts hold line ends and quotes."""
    c = t.read("conversations")
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    row = F.concat_ws(",", F.col("turn").cast("string"), "role", quoted)
    parts = c.select(F.col("conv_id").alias("file"), "turn", F.posexplode(F.split(row, "\n")).alias("k", "value"))
    heads = c.select(F.col("conv_id").alias("file")).distinct().select("file", F.lit(-1).cast("bigint").alias("turn"), F.lit(0).alias("k"), F.lit("turn,role,text").alias("value"))
    rows = parts.unionByName(heads)
    return scan(rows, ["file"], ["turn", "k"], [row_number("line")], t.hot("conversations", "conv_id", "file")).select("file", "line", "value")


def _csv_records(t: Tables):
    return csv_records(_csv_lines(t), hot=t.hot("conversations", "conv_id", "file"))[0]


@query("""SELECT CASE WHEN path LIKE '%/fr/%' THEN 'config' WHEN path LIKE '%/en/%' THEN 'weights' ELSE 'asset' END AS role,
    count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes FROM members GROUP BY ALL""")
def file_roles(t: Tables):
    role = F.when(F.col("path").contains("/fr/"), "config").when(F.col("path").contains("/en/"), "weights").otherwise("asset")
    return t.members().groupBy(role.alias("role")).agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))


@query("""SELECT page_id, unnest(list_filter([CASE WHEN path LIKE '%.example.net%' THEN 'forbidden_host' END,
    CASE WHEN bytes > 3000 THEN 'oversize' END, CASE WHEN path LIKE '%#%' THEN 'fragment' END], lambda x: x IS NOT NULL)) AS reason FROM members""")
def file_policy(t: Tables):
    rules = {"forbidden_host": F.col("path").contains(".example.net"), "oversize": F.col("bytes") > 3000, "fragment": F.col("path").contains("#")}
    return mf.field_issues(t.members(), "page_id", rules).withColumnRenamed("code", "reason")


@query("""SELECT value, first_list, first_at FROM (SELECT value, li AS first_list, pos AS first_at, row_number() OVER (PARTITION BY value ORDER BY li, pos) AS rn FROM (
    SELECT audio_sha256 AS value, 0 AS li, clip_id AS pos FROM clips WHERE split = 'train' UNION ALL SELECT audio_sha256, 1, clip_id FROM clips WHERE split <> 'train')) WHERE rn = 1""")
def ordered_union(t: Tables):
    c = t.clips().select(F.col("audio_sha256").alias("value"), F.col("clip_id").alias("at"), "split")
    out = mf.ordered_union([c.where("split = 'train'"), c.where("split <> 'train'")], "value", "at")
    return out.select("value", F.col("first.list").alias("first_list"), F.col("first.at").alias("first_at"))


@query("""SELECT split, count(*) AS clips, CAST(sum(CASE WHEN status = 'accepted' THEN 1 ELSE 0 END) AS BIGINT) AS accepted,
    CAST(sum(CASE WHEN status = 'review' THEN 1 ELSE 0 END) AS BIGINT) AS review FROM clips GROUP BY split""")
def split_counts(t: Tables):
    return t.clips().groupBy("split").agg(
        F.count(F.lit(1)).alias("clips"), F.count_if(F.col("status") == "accepted").alias("accepted"), F.count_if(F.col("status") == "review").alias("review")
    )


@query("""WITH s AS (SELECT song_id, bool_and(status = 'accepted') AS ready, count(*) AS clips FROM clips GROUP BY song_id)
    SELECT song_id, clips, CASE WHEN ready THEN 'READY' ELSE 'BLOCKED' END AS status FROM s
    UNION ALL SELECT '*', CAST(sum(clips) AS BIGINT), CASE WHEN bool_and(ready) THEN 'READY' ELSE 'BLOCKED' END FROM s""")
def status_rollup(t: Tables):
    song = t.clips().groupBy("song_id").agg(F.count(F.lit(1)).alias("clips"), F.bool_and(F.col("status") == "accepted").alias("ready"))
    whole = song.agg(F.lit("*").alias("song_id"), F.sum("clips").alias("clips"), F.bool_and("ready").alias("ready"))
    return song.unionByName(whole).select("song_id", "clips", F.when(F.col("ready"), "READY").otherwise("BLOCKED").alias("status"))


@query("""SELECT o_custkey AS job, o_orderkey AS version, o_orderstatus AS status FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def latest_version(t: Tables):
    o = t.read("orders")
    return o.groupBy(F.col("o_custkey").alias("job")).agg(F.max("o_orderkey").alias("version"), F.max_by("o_orderstatus", "o_orderkey").alias("status"))


@query("""SELECT a.song_id, max(a.k) AS iteration FROM (SELECT DISTINCT song_id, k FROM ev WHERE event_type = 'click') a
    JOIN (SELECT DISTINCT song_id, k FROM ev WHERE event_type = 'view') b USING (song_id, k) GROUP BY a.song_id""")
def latest_complete_pair(t: Tables):
    e = t.timed_events().where("event_type in ('click', 'view')")
    pairs = e.groupBy("song_id", "k").agg(F.count_if(F.col("event_type") == "click").alias("a"), F.count_if(F.col("event_type") == "view").alias("b"))
    return pairs.where("a > 0 and b > 0").groupBy("song_id").agg(F.max("k").alias("iteration"))


# -- issues ---------------------------------------------------------------------------


@query("""SELECT position, 'ds-' || substr(sha1(song_id || '|events|' || type || '|' || segment_id || '||||'), 1, 12) AS issue_id, blocking FROM (
    SELECT *, type IN ('INTRA_PHRASE_MIDI_GAP', 'MIDI_GAP_AUDIO_CONFLICT') AS blocking FROM issues)""")
def issue_ids(t: Tables):
    made = iss.normalize(t.issues().drop("issue_id").withColumn("stage", F.lit(None).cast("string")), "events")
    return iss.blocking(made).select("position", "issue_id", "blocking")


SHARED = """shared AS (SELECT 'ds-' || substr(sha1(song_id || '|' || boundary_index), 1, 12) AS issue_id, song_id, type, boundary_index, segment_id, status, position FROM issues),
    dedup AS (SELECT s.issue_id, song_id, type, boundary_index, segment_id, CASE WHEN status = 'accepted' THEN status ELSE coalesce(later, status) END AS status, s.position, copies
        FROM (SELECT *, row_number() OVER (PARTITION BY issue_id ORDER BY position) AS rn, count(*) OVER (PARTITION BY issue_id) AS copies FROM shared) s
        LEFT JOIN (SELECT issue_id, min(status) AS later FROM shared WHERE status = 'accepted' GROUP BY issue_id) l ON l.issue_id = s.issue_id WHERE rn = 1)"""


def _dedup(t: Tables):
    shared = t.issues().withColumn("issue_id", fn.short_sha1("ds-", F.col("song_id"), F.col("boundary_index")))
    return iss.deduplicate(shared, "position", ["song_id", "type", "boundary_index", "segment_id"])


@query(f"WITH {SHARED} SELECT * FROM dedup")
def issue_dedup(t: Tables):
    return _dedup(t)


@query(f"WITH {SHARED} SELECT count(*) AS issue_count, CAST(sum(CASE WHEN status <> 'accepted' THEN 1 ELSE 0 END) AS BIGINT) AS pending_count, 'BLOCKED' AS status FROM dedup")
def review_queue_summary(t: Tables):
    return iss.pending_summary(_dedup(t))


DEDUP = """u AS (SELECT issue_id, song_id, type, boundary_index, segment_id, position, type = 'INTRA_PHRASE_MIDI_GAP' AS dep,
        CASE WHEN type IN ('MIDI_GAP_AUDIO_CONFLICT', 'INTRA_PHRASE_MIDI_GAP') THEN song_id || ':boundary:' || boundary_index
             WHEN type = 'PRONUNCIATION_CROSSCHECK_MISMATCH' THEN song_id || ':phrase:' || segment_id ELSE song_id || ':issue:' || issue_id END AS root_issue_id
        FROM (SELECT *, row_number() OVER (PARTITION BY issue_id ORDER BY position) AS rn FROM issues) WHERE rn = 1),
    m AS (SELECT *, first_value(issue_id) OVER w AS root_original_issue_id, first_value(type) OVER w AS root_type, first_value(boundary_index) OVER w AS root_boundary,
        count(*) OVER (PARTITION BY root_issue_id) AS members FROM u WINDOW w AS (PARTITION BY root_issue_id ORDER BY dep, issue_id))"""


def _unique(t: Tables):
    return iss.deduplicate(t.issues(), "position", ["song_id", "type", "boundary_index", "segment_id"])


@query(f"WITH {DEDUP} SELECT DISTINCT root_issue_id, root_original_issue_id, root_type AS type, root_boundary AS boundary_index, members FROM m")
def root_causes(t: Tables):
    return iss.roots(_unique(t))


@query(f"WITH {DEDUP} SELECT issue_id, root_issue_id, root_original_issue_id, members, issue_id = root_original_issue_id AS is_root FROM m")
def root_membership(t: Tables):
    return iss.membership(_unique(t)).select("issue_id", "root_issue_id", "root_original_issue_id", "members", "is_root")


@query(f"""WITH {DEDUP} SELECT issue_id, CASE WHEN root_boundary % 2 = 0 THEN 'resolved' ELSE 'pending' END AS status,
    CASE WHEN root_boundary % 2 = 0 THEN root_issue_id END AS root_issue_id, CASE WHEN root_boundary % 2 = 0 THEN 'PRUNE_INTERVAL' END AS resolution_action,
    CASE WHEN root_boundary % 2 = 0 THEN sha256(root_issue_id) END AS artifact_sha256 FROM m""")
def decision_replay(t: Tables):
    unique = _unique(t)
    members = iss.membership(unique)
    even = iss.roots(unique).where("boundary_index % 2 = 0").select("root_issue_id")
    decisions = members.select("issue_id", "root_issue_id", "position").join(even, "root_issue_id").select(
        "issue_id", "root_issue_id", F.lit("PRUNE_INTERVAL").alias("resolution_action"), F.sha2("root_issue_id", 256).alias("artifact_sha256"), "position"
    )
    queue = unique.withColumn("status", F.lit("pending"))
    return iss.replay(queue, decisions).select("issue_id", "status", "root_issue_id", "resolution_action", "artifact_sha256")


@query("""SELECT type, status, count(*) AS n FROM (SELECT type, status FROM issues WHERE NOT (type = 'OTHER_ISSUE' OR starts_with(type, 'MIDI_'))
    UNION ALL SELECT 'MIDI_NOTE_OVERLAP', 'pending' FROM notes WHERE pitch = 60) GROUP BY ALL""")
def stage_issue_replace(t: Tables):
    fresh = t.notes().where("pitch = 60").select(F.lit("MIDI_NOTE_OVERLAP").alias("type"), F.lit("pending").alias("status"))
    kept = iss.replace_stage(t.issues().select("type", "status"), fresh, ["OTHER_ISSUE"], ["MIDI_"])
    return kept.groupBy("type", "status").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT code, failures, failures = 0 AS passed FROM (
    SELECT 'UNIQUE_HASH' AS code, count(*) AS failures FROM (SELECT audio_sha256 FROM clips GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'UNIQUE_ID', count(*) FROM (SELECT clip_id FROM clips GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'SPLIT_ISOLATION', count(*) FROM (SELECT audio_sha256 FROM clips GROUP BY 1 HAVING count(DISTINCT split) > 1)
    UNION ALL SELECT 'POSITIVE_DURATION', count(*) FROM clips WHERE duration_ms <= 0)""")
def check_table(t: Tables):
    c = t.clips()
    return iss.check_table({
        "UNIQUE_HASH": mf.duplicates(c, F.col("audio_sha256"), "h"), "UNIQUE_ID": mf.duplicates(c, F.col("clip_id"), "i"),
        "SPLIT_ISOLATION": mf.split_leakage(c, "audio_sha256"), "POSITIVE_DURATION": c.where("duration_ms <= 0"),
    })


@query("""WITH a AS (SELECT song, row_number() OVER (PARTITION BY song ORDER BY id) AS place, id AS left_id FROM captions WHERE id % 2 = 0),
    b AS (SELECT song, row_number() OVER (PARTITION BY song ORDER BY id) AS place, id AS right_id FROM captions WHERE id % 2 = 1)
    SELECT song, place, left_id, right_id, left_id IS NULL OR right_id IS NULL AS mismatch FROM a FULL JOIN b USING (song, place)""")
def zip_with_mismatch(t: Tables):
    c, hot = t.captions().select("song", "id"), t.hot_conversations
    side = lambda rows, name: scan(rows, ["song"], ["id"], [row_number("place")], hot).withColumnRenamed("id", name)
    both = side(c.where("id % 2 = 0"), "left_id").join(side(c.where("id % 2 = 1"), "right_id"), ["song", "place"], "full_outer")
    return both.withColumn("mismatch", F.col("left_id").isNull() | F.col("right_id").isNull())


@query("""WITH p AS (SELECT song AS song_id, id AS phrase, blanks % 5 + 1 AS note_count FROM captions),
    s AS (SELECT *, CAST(sum(note_count) OVER (PARTITION BY song_id ORDER BY phrase ROWS UNBOUNDED PRECEDING) AS BIGINT) AS slice_to FROM p)
    SELECT n.song_id, n.note_index, s.phrase FROM notes n LEFT JOIN s ON s.song_id = n.song_id AND n.note_index >= slice_to - note_count AND n.note_index < slice_to""")
def slice_assignment(t: Tables):
    from ..operators import intervals as iv

    phrases = t.captions().select(F.col("song").alias("song_id"), F.col("id").alias("phrase"), (F.col("blanks") % 5 + 1).alias("note_count"))
    hot = t.hot("conversations", "conv_id", "song_id")
    cut = mf.slices(phrases, ["song_id"], ["phrase"], "note_count", hot)
    notes = t.notes().select("song_id", "note_index")
    found = iv.asof(notes, cut, ["song_id"], "note_index", "slice_from", ["phrase", "slice_to"], hot=t.hot_songs)
    phrase = F.when(F.col("note_index") < F.col("mark.slice_to"), F.col("mark.phrase"))
    return found.select("song_id", "note_index", phrase.alias("phrase"))
