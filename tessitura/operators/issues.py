"""Review issues: normal form, de-duplication, root causes, replayed decisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import ACCEPTED_STATUSES, first_filled, short_sha1

# Issue types that share a boundary as their cause.
GAP_TYPES = ("MIDI_GAP_AUDIO_CONFLICT", "MIDI_GAP_AUDIO_EVIDENCE_INSUFFICIENT")
DEPENDENT_TYPES = ("INTRA_PHRASE_MIDI_GAP",)
PRONUNCIATION_TYPE = "PRONUNCIATION_CROSSCHECK_MISMATCH"
BLOCKING_TYPES = (
    "MIDI_NOTE_OVERLAP", "INTRA_PHRASE_MIDI_GAP", "MIDI_GAP_AUDIO_CONFLICT",
    "MIDI_GAP_AUDIO_EVIDENCE_INSUFFICIENT", "AUTO_BOUNDARY_REALIGNMENT_FAILED",
)
# The order of these fields defines an issue id.
ID_FIELDS = ("song_id", "stage", "type", "segment_id", "start_sec", "end_sec", "evidence", "proposed_value")
TEXT_FIELDS = ("confidence", "resolution", *ID_FIELDS)


def settled(status: Column) -> Column:
    return F.lower(F.coalesce(status, F.lit("pending"))).isin(*ACCEPTED_STATUSES)


def normalize(issues: DataFrame, default_stage: str = "") -> DataFrame:
    """Fixed shape with defaults and a stable id; unknown columns are kept."""
    have = set(issues.columns)
    text = lambda c: F.col(c).cast("string") if c in have else F.lit(None).cast("string")
    filled = {
        c: F.coalesce(text(c), F.lit("")) for c in TEXT_FIELDS
    } | {
        "stage": F.coalesce(first_filled(text("stage")), F.lit(default_stage)),
        "type": F.coalesce(text("type"), F.lit("UNKNOWN_ISSUE")),
        "evidence": F.coalesce(first_filled(text("evidence"), text("message")), F.lit("")),
        "status": F.coalesce(first_filled(text("status")), F.lit("pending")),
        "__id": text("issue_id"),
    }
    rows = issues.withColumns(filled)
    made = short_sha1("ds-", *[F.col(c) for c in ID_FIELDS])
    return rows.withColumn("issue_id", F.coalesce(first_filled(F.col("__id")), made)).drop("__id")


def deduplicate(issues: DataFrame, position: str, keep: Sequence[str]) -> DataFrame:
    """First copy of each id; an unsettled first copy takes over the first settled status.

    A ``resolution`` among the kept columns comes from the same copy as the status.
    """
    at = F.col(position)
    done = F.when(settled(F.col("status")), at)
    out = issues.groupBy("issue_id").agg(
        F.min_by(F.struct(*keep, "status"), at).alias("first"),
        F.min_by(F.struct("status", *(["resolution"] if "resolution" in keep else [])), done).alias("later"),
        F.min(position).alias(position),
        F.count(F.lit(1)).alias("copies"),
    )
    takes = ~settled(F.col("first.status")) & F.col("later").isNotNull()
    taken = lambda c: F.when(takes, F.col(f"later.{c}")).otherwise(F.col(f"first.{c}")).alias(c)
    kept = [taken(c) if c == "resolution" else F.col(f"first.{c}").alias(c) for c in keep]
    return out.select("issue_id", *kept, taken("status"), position, "copies")


def root_key(issues: DataFrame) -> Column:
    """Shared cause of an issue: its boundary, its pair of pronunciations, its phrase, or itself."""
    have = set(issues.columns)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit("")
    said = F.concat_ws(" ", text("evidence"), text("proposed_value"))
    one = F.regexp_extract(said, "primary=([0-9a-fA-F]+)", 1)
    two = F.regexp_extract(said, "secondary=([0-9a-fA-F]+)", 1)
    song = text("song_id")
    key = F.when(F.col("type").isin(*GAP_TYPES, *DEPENDENT_TYPES), F.concat(song, F.lit(":boundary:"), text("boundary_index")))
    pron = F.when((one != "") & (two != ""), F.concat(song, F.lit(":pron:"), one, F.lit(":"), two))
    pron = pron.otherwise(F.concat(song, F.lit(":phrase:"), text("segment_id")))
    return key.when(F.col("type") == PRONUNCIATION_TYPE, pron).otherwise(F.concat(song, F.lit(":issue:"), text("issue_id")))


def roots(issues: DataFrame) -> DataFrame:
    """One row per cause. The root is the lowest id among members that do not depend on another."""
    rank = F.struct(F.col("type").isin(*DEPENDENT_TYPES).alias("dependent"), F.col("issue_id"))
    keyed = issues.withColumn("root_issue_id", root_key(issues))
    return keyed.groupBy("root_issue_id").agg(
        F.min(rank)["issue_id"].alias("root_original_issue_id"),
        F.min_by("type", rank).alias("type"),
        F.min_by("boundary_index", rank).alias("boundary_index"),
        F.count(F.lit(1)).alias("members"),
    )


def membership(issues: DataFrame) -> DataFrame:
    """Every issue with its cause and the root's id.

    The dependents of an issue are the other rows of its cause. They stay rows: written
    out as a list on each member, a cause of n issues would need n * n entries.
    """
    keyed = issues.withColumn("root_issue_id", root_key(issues))
    named = keyed.join(roots(issues).select("root_issue_id", "root_original_issue_id", "members"), "root_issue_id")
    return named.withColumn("is_root", F.col("issue_id") == F.col("root_original_issue_id"))


def replay(issues: DataFrame, decisions: DataFrame, position: str = "position") -> DataFrame:
    """Overlay stored decisions (one row per issue id; the last one counts) on the queue."""
    last = decisions.groupBy("issue_id").agg(
        F.max_by(F.struct("root_issue_id", "resolution_action", "artifact_sha256"), position).alias("d")
    )
    rows = issues.join(last, "issue_id", "left")
    return rows.withColumns(
        {
            "status": F.when(F.col("d").isNotNull(), "resolved").otherwise(F.col("status")),
            "root_issue_id": F.col("d.root_issue_id"),
            "resolution_action": F.col("d.resolution_action"),
            "artifact_sha256": F.col("d.artifact_sha256"),
        }
    ).drop("d")


def replace_stage(issues: DataFrame, fresh: DataFrame, types: Sequence[str], prefixes: Sequence[str]) -> DataFrame:
    """Drop the issues a stage produced before, keep the rest, add its new ones."""
    gone = F.col("type").isin(*types)
    for p in prefixes:
        gone = gone | F.col("type").startswith(p)
    return issues.where(~gone).unionByName(fresh, allowMissingColumns=True)


def blocking(issues: DataFrame) -> DataFrame:
    stops = F.col("type").isin(*BLOCKING_TYPES) | F.col("type").endswith("FAILED")
    return issues.withColumn("blocking", stops)


def pending_summary(issues: DataFrame) -> DataFrame:
    out = issues.agg(F.count(F.lit(1)).alias("issue_count"), F.count_if(~settled(F.col("status"))).alias("pending_count"))
    return out.withColumn("status", F.when(F.col("pending_count") == 0, "REVIEW_CLEAR").otherwise("BLOCKED"))


def check_row(rows: DataFrame, failures: dict[str, Column]) -> DataFrame:
    """Check table of aggregates that one pass over ``rows`` gives: code, failing rows, passed."""
    counts = rows.agg(*[n.cast("bigint").alias(code) for code, n in failures.items()])
    each = F.explode(F.array(*[F.struct(F.lit(code).alias("code"), F.col(code).alias("failures")) for code in failures]))
    return counts.select(each.alias("c")).select("c.code", "c.failures", (F.col("c.failures") == 0).alias("passed"))


def check_table(checks: dict[str, DataFrame]) -> DataFrame:
    """Union of one-row aggregates: code, failing rows, passed."""
    out = None
    for code, rows in checks.items():
        one = rows.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(code).alias("code"), "failures", (F.col("failures") == 0).alias("passed")
        )
        out = one if out is None else out.unionByName(one)
    return out
