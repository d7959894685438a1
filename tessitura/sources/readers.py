"""Readers: tables, lists, captions, tiers, score documents, file inventories, audio headers.

Text formats are read with Spark's text source and parsed with column functions. Files
whose records span lines (captions, tiers, JSON documents) are one row per file: such a
file describes one recording. Only WAV and ZIP decoding needs Python, in Arrow batches.
"""

from __future__ import annotations

import hashlib
import io
import re
import wave
import zipfile
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import clean_caption, clock_seconds, has_kana, integers, numbers, tokens
from ..operators.scans import previous, row_number, scan
from ..session import ensure_checkpoint_dir
from .records import csv_records, csv_table

BOM = "﻿"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def _unmark(text: Column) -> Column:
    return F.regexp_replace(text, f"^{BOM}", "")


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, line, value``: lines with their 1-based number inside their file.

    Files stay splittable: inside a block rows are in file order, blocks are ordered by
    their start, and the number is an ordered scan per file (chunked for a huge file).
    """
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__at"), "value"
    )
    numbered = scan(rows, ["file"], ["__block", "__at"], [row_number("line")])
    value = F.when(F.col("line") == 1, _unmark(F.col("value"))).otherwise(F.col("value"))
    return numbered.select("file", "line", value.alias("value"))


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, sep: str = ",") -> DataFrame:
    """Header and optional BOM, all strings; a missing path gives an empty table of ``columns``.

    Files are split between tasks; line ends inside quotes stay in their field
    (``records.csv_table`` also reports open quotes and rows of another length). Without
    ``columns`` those of the first file's header are taken.
    """
    if not _exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns or ["value"]]))
    found, _ = csv_records(numbered_lines(spark, path), sep)
    if columns is None:
        head = found.where("record = 0").agg(F.min_by("fields", "file").alias("h")).first()["h"]
        columns = [c.strip() for c in head or ["value"]]
    return csv_table(found, columns)[0].select(*columns)


def keyed_table(rows: DataFrame, key: str, fallback: str | None = None):
    """Rows with a usable key, and the keys that occur twice. Returns (rows, duplicates)."""
    name = F.coalesce(F.nullif(F.trim(key), F.lit("")), F.nullif(F.trim(fallback), F.lit("")) if fallback else F.lit(None))
    good = rows.withColumn(key, name).where(F.col(key).isNotNull())
    return good, good.groupBy(key).count().where("count > 1")


def text_lines(docs: DataFrame, file: str, text: str) -> DataFrame:
    """``file, line, value`` of texts in a column, for the line parsers below; null texts have no lines."""
    body = F.regexp_replace(_unmark(F.col(text)), "\r\n?", "\n")
    return docs.select(F.col(file).alias("file"), F.posexplode(F.split(body, "\n")).alias("at", "value")).select("file", (F.col("at") + 1).alias("line"), "value")


def parse_lyrics_tsv(rows: DataFrame, hot=None) -> DataFrame:
    """``file, line, phrase_id, surface, reading, note_count`` of numbered lines; the first of a file
    names the columns, ids default to p001, p002, ... by the row's place."""
    cells = rows.withColumn("cells", F.split("value", "\t"))
    heads = cells.where("line = 1").select(F.col("file").alias("h_file"), F.col("cells").alias("head"))
    body = cells.where("line > 1 and trim(value) <> ''").join(heads, F.col("file") == F.col("h_file"))
    cell = lambda name: F.trim(F.coalesce(F.try_element_at("cells", F.array_position(F.transform("head", lambda h: F.trim(h)), name).cast("int")), F.lit("")))
    safe = lambda name: F.when(F.array_contains(F.transform("head", lambda h: F.trim(h)), name), cell(name)).otherwise("")
    ranked = scan(body.select("file", "line", *[safe(c).alias(c) for c in ("phrase_id", "surface", "reading", "note_count")]), ["file"], ["line"], [row_number("n")], hot)
    return ranked.select(
        "file", "line", F.coalesce(F.nullif("phrase_id", F.lit("")), F.format_string("p%03d", "n")).alias("phrase_id"), "surface", "reading",
        F.coalesce(F.col("note_count").try_cast("double").cast("bigint"), F.lit(0)).alias("note_count"),
    )


def read_lyrics_tsv(spark: SparkSession, path: str) -> DataFrame:
    return parse_lyrics_tsv(numbered_lines(spark, path))


def parse_jsonl(lines: DataFrame, schema: str):
    """Strict JSON Lines. Returns (rows with file and line, bad lines with file, line and reason)."""
    rows = lines.where("trim(value) <> ''")
    parsed = rows.withColumn("v", F.try_parse_json("value"))
    is_object = F.schema_of_variant("v").startswith("OBJECT")
    reason = F.when(F.col("v").isNull(), "INVALID_JSON").when(~is_object, "NOT_AN_OBJECT")
    parsed = parsed.withColumn("reason", reason)
    good = parsed.where("reason is null").select("file", "line", F.from_json("value", schema).alias("r")).select("file", "line", "r.*")
    return good, parsed.where("reason is not null").select("file", "line", "reason")


def read_jsonl(spark: SparkSession, path: str, schema: str):
    return parse_jsonl(numbered_lines(spark, path), schema)


def _whole_texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), _unmark(F.col("value")).alias("value"))


def parse_json_items(docs: DataFrame, item_schema: str, wrappers: Sequence[str] = ("items", "phones", "f0")) -> DataFrame:
    """Array documents, or objects that wrap the array; one row per element with its position."""
    array = f"array<{item_schema}>"
    wrapped = [F.get_json_object("value", f"$.{w}") for w in wrappers]
    is_array = F.ltrim("value").startswith("[")
    text = F.when(is_array, F.col("value")).otherwise(F.coalesce(*wrapped))
    return docs.select("file", F.posexplode(F.from_json(text, array)).alias("pos", "item"))


def read_json_items(spark: SparkSession, path: str, item_schema: str, wrappers: Sequence[str] = ("items", "phones", "f0")) -> DataFrame:
    return parse_json_items(_whole_texts(spark, path), item_schema, wrappers)


def parse_song_maps(docs: DataFrame, value_schema: str, field: str = "songs") -> DataFrame:
    """Reports that map song ids to structs: one row per song."""
    table = F.from_json(F.get_json_object("value", f"$.{field}"), f"map<string,{value_schema}>")
    return docs.select("file", F.explode(table).alias("song_id", "report"))


def read_song_maps(spark: SparkSession, path: str, value_schema: str, field: str = "songs") -> DataFrame:
    return parse_song_maps(_whole_texts(spark, path), value_schema, field)


def parse_list(lines: DataFrame, language: str | None = None):
    """Four fields split at bars, the rest of the line in the last. Returns (rows, bad lines)."""
    rows = lines.where("trim(value) <> ''").withColumn("f", F.split("value", r"\|", 4))
    names = ("audio_path", "speaker", "language", "text")
    blank = F.exists("f", lambda x: F.trim(x) == "")
    bad = F.when(F.size("f") != 4, "FIELD_COUNT").when(blank, "BLANK_FIELD")
    if language:
        bad = bad.when(F.upper(F.trim(F.get("f", 2))) != language, "LANGUAGE")
    marked = rows.withColumn("reason", bad)
    good = marked.where("reason is null").select("file", "line", *[F.trim(F.get("f", i)).alias(n) for i, n in enumerate(names)])
    return good, marked.where("reason is not null").select("file", "line", "reason")


def short_lists(good: DataFrame, files: DataFrame, least: int = 3) -> DataFrame:
    """``file, rows`` of the lists named in ``files`` that hold fewer than ``least`` good rows."""
    counted = files.select("file").join(good.groupBy("file").agg(F.count(F.lit(1)).alias("rows")), "file", "left")
    return counted.fillna(0, ["rows"]).where(F.col("rows") < least)


def read_list(spark: SparkSession, path: str, language: str | None = None):
    return parse_list(numbered_lines(spark, path), language)


def parse_name_text(lines: DataFrame):
    """Tab lines of audio name, phones, note, text. Returns (rows, bad lines)."""
    rows = lines.where("trim(value) <> ''").withColumn("f", F.split("value", "\t", 4))
    bad = (F.size("f") != 4) | (F.trim(F.get("f", 0)) == "") | (F.trim(F.coalesce(F.get("f", 3), F.lit(""))) == "")
    good = rows.where(~bad).select("file", "line", F.trim(F.get("f", 0)).alias("audio_name"), F.get("f", 1).alias("phones"), F.trim(F.get("f", 3)).alias("text"))
    return good, rows.where(bad).select("file", "line", F.lit("FIELD_COUNT_OR_BLANK").alias("reason"))


def read_name_text(spark: SparkSession, path: str):
    return parse_name_text(numbered_lines(spark, path))


def merge_lines(lines: DataFrame) -> DataFrame:
    """Parts of one table in file order: blank lines and repeated headers dropped, one header kept first.

    Columns: ``part, line, value``; sort by them to write. Part files name their order.
    """
    rows = lines.where("trim(value) <> ''")
    at = F.struct("file", "line")
    both = rows.withColumns({"head": rows.agg(F.min_by("value", at)).scalar(), "at": rows.agg(F.min(at)).scalar()})
    keep = (F.col("value") != F.col("head")) | (at == F.col("at"))
    return both.where(keep).select(F.col("file").alias("part"), "line", "value")


def merge_parts(spark: SparkSession, path: str) -> DataFrame:
    return merge_lines(numbered_lines(spark, path))


def parse_dictionary(lines: DataFrame, layer: int = 0) -> DataFrame:
    """``file, key, value, layer, position``: comments skipped, tab or blank separated; feed to ``layered``."""
    rows = lines.withColumn("t", F.trim("value")).where("t <> '' and not startswith(t, '#')")
    tab = F.contains("t", F.lit("\t"))
    key = F.when(tab, F.trim(F.split_part("t", F.lit("\t"), F.lit(1)))).otherwise(F.regexp_extract("t", r"^(\S+)", 1))
    rest = F.when(tab, F.regexp_replace("t", "^[^\t]*\t", "")).otherwise(F.regexp_replace("t", r"^\S+\s*", ""))
    value = F.array_join(tokens(rest), " ")
    return rows.where(tab | F.col("t").rlike(r"\s")).select("file", key.alias("key"), value.alias("value"), F.lit(layer).cast("bigint").alias("layer"), F.col("line").alias("position"))


def read_dictionary(spark: SparkSession, path: str, layer: int = 0) -> DataFrame:
    return parse_dictionary(numbered_lines(spark, path), layer).drop("file")


def phone_inventory(dictionary: DataFrame) -> DataFrame:
    return dictionary.select(F.explode(tokens(F.col("value"))).alias("phone")).distinct()


# -- captions and tiers ---------------------------------------------------------------

# Fixed value: the time line of the SRT format.
SRT_TIME = r"^(\d{1,2}:\d{2}:\d{2}[,.]\d{3})\s+-->\s+(\d{1,2}:\d{2}:\d{2}[,.]\d{3})$"


def parse_srt(docs: DataFrame, text: str = "value"):
    """Captions of whole SRT texts: first line with kana is the text, the first other line its translation.

    Returns (captions, bad captions whose end is not after their start).
    """
    clean = F.regexp_replace(F.regexp_replace(_unmark(F.col(text)), "\r\n", "\n"), "\r", "\n")
    keep = [c for c in docs.columns if c != text]
    blocks = docs.select(*keep, F.explode(F.split(clean, r"\n{2,}")).alias("block"))
    rows = blocks.select(*keep, F.filter(F.transform(F.split("block", "\n"), lambda x: F.trim(x)), lambda x: x != "").alias("l")).where("size(l) >= 3")
    body = F.transform(F.slice("l", 3, F.size("l")), clean_caption)
    rows = rows.select(*keep, F.get("l", 0).try_cast("bigint").alias("id"), F.get("l", 1).alias("time"), body.alias("body")).where("id is not null")
    rows = rows.where(F.col("time").rlike(SRT_TIME))
    said = F.get(F.filter("body", has_kana), 0)
    rows = rows.withColumn("text", said).where("text is not null")
    at = lambda i: clock_seconds(F.regexp_extract("time", SRT_TIME, i))
    out = rows.select(
        *keep, "id", "text", F.get(F.filter("body", lambda x: x != F.col("text")), 0).alias("translation"),
        F.bround(at(1), 3).alias("start"), F.bround(at(2), 3).alias("end"),
    )
    out = out.withColumn("duration", F.bround(F.col("end") - F.col("start"), 3))
    return out.where("end > start"), out.where("end <= start")


def read_srt(spark: SparkSession, path: str):
    docs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return parse_srt(docs)


def parse_textgrid(docs: DataFrame, tier: str, include_empty: bool = False, text: str = "value") -> DataFrame:
    """Intervals of one named tier of whole TextGrid texts: ``start, end, text`` with their position."""
    keep = [c for c in docs.columns if c != text]
    items = docs.select(*keep, F.explode(F.filter(F.split(_unmark(F.col(text)), r"(?m)^\s*item \[\d+\]:"), lambda _, k: k > 0)).alias("item"))
    name = F.regexp_extract("item", r'(?m)^\s*name\s*=\s*"?([^"\r\n]*)"?', 1)
    found = items.where(F.trim(name) == tier).select(*keep, F.posexplode(F.split("item", r"(?m)^\s*intervals \[\d+\]:")).alias("pos", "part")).where("pos > 0")
    field = lambda n: F.regexp_extract("part", rf"(?m)^\s*{n}\s*=\s*([^\r\n]+)", 1)
    label = F.trim(field("text"))
    label = F.when(label.rlike('^".*"$'), F.replace(F.expr("substring(__l, 2, length(__l) - 2)"), F.lit('\\"'), F.lit('"'))).otherwise(F.col("__l"))
    rows = found.withColumn("__l", F.trim(field("text"))).where("__l <> ''")
    rows = rows.select(*keep, "pos", F.trim(field("xmin")).try_cast("double").alias("start"), F.trim(field("xmax")).try_cast("double").alias("end"), label.alias("text"))
    rows = rows.where("start is not null and end is not null")
    return rows if include_empty else rows.where("text <> ''")


def missing_tiers(docs: DataFrame, tier: str, text: str = "value") -> DataFrame:
    """Documents without the named tier."""
    return docs.where(~F.col(text).rlike(rf'(?m)^\s*name\s*=\s*"?{tier}"?\s*$')).drop(text)


def parse_lab(lines: DataFrame):
    """``file, line, start, end, phone`` from lines of three blank-separated fields. Returns (rows, bad lines)."""
    rows = lines.where("trim(value) <> ''").withColumn("f", tokens(F.col("value")))
    rows = rows.withColumns({"start": F.get("f", 0).try_cast("double"), "end": F.get("f", 1).try_cast("double")})
    bad = F.when(F.size("f") != 3, "FIELD_COUNT").when(F.col("start").isNull() | F.col("end").isNull(), "NOT_A_NUMBER")
    marked = rows.withColumn("reason", bad)
    good = marked.where("reason is null").select("file", "line", "start", "end", F.get("f", 2).alias("phone"))
    return good, marked.where("reason is not null").select("file", "line", "reason")


def read_lab(spark: SparkSession, path: str) -> DataFrame:
    """The good lines of LAB files; ``parse_lab`` also reports the others."""
    return parse_lab(numbered_lines(spark, path))[0]


def lab_breaks(lab: DataFrame, eps: float = 1 / 44_100, hot=None) -> DataFrame:
    """Lines that do not start where the line before ended."""

    rows = scan(lab, ["file"], ["line"], [previous("__end", F.col("end"))], hot)
    return rows.where(F.abs(F.col("start") - F.col("__end")) > eps).drop("__end")


def parse_score_items(items: DataFrame) -> DataFrame:
    """Sequence strings of score items to arrays."""

    have = set(items.columns)
    out = {c: tokens(F.col(c)) for c in ("ph_seq", "note_seq") if c in have}
    out |= {c: numbers(F.col(c)) for c in ("ph_dur", "note_dur", "f0_seq") if c in have}
    out |= {c: integers(F.col(c)) for c in ("ph_num", "note_slur") if c in have}
    return items.withColumns(out)


# -- files ----------------------------------------------------------------------------


def _listed(spark: SparkSession, path: str, suffixes: Sequence[str] | None) -> tuple[DataFrame, DataFrame]:
    """Files below a folder as the file source lists them, and the paths of the empty ones.

    The source plans no task for an empty file, so those are the names its index holds
    beyond the files it reads; their time is not known there. Hidden names are left out.
    """
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    names = [(re.sub("^file:/+", "file:/", unquote(n)),) for n in rows.inputFiles()]
    every = spark.createDataFrame(names, "path string")
    if suffixes:
        wanted = F.lower("path").rlike("(" + "|".join(x.lower().replace(".", r"\.") for x in suffixes) + ")$")
        rows, every = rows.where(wanted), every.where(wanted)
    return rows, every.join(rows.select("path"), "path", "left_anti")


def inventory(spark: SparkSession, path: str, suffixes: Sequence[str] | None = None) -> DataFrame:
    """``path, bytes, modified, sha256, empty`` of all files below a folder, each up to 2 GB."""
    rows, empty = _listed(spark, path, suffixes)
    read = rows.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"), F.lit(False).alias("empty"))
    return read.unionByName(empty.select("path", F.lit(0).cast("bigint").alias("bytes"), F.lit(None).cast("timestamp").alias("modified"), F.sha2(F.lit(b""), 256).alias("sha256"), F.lit(True).alias("empty")))


FAN_OUT = 1024


def block_inventory(spark: SparkSession, path: str, block_bytes: int = 64 << 20, suffixes: Sequence[str] | None = None) -> DataFrame:
    """``path, bytes, modified, blocks, digest, readable`` of files of any size below a folder.

    A file is read by byte ranges, each by whichever task is free, 1 MB at a time, so no file
    has to fit a cell or a task. A SHA-256 over all bytes cannot be put together from ranges:
    ``digest`` is the root of a tree over the ranges' SHA-256 (hex texts of up to 1024 children
    joined and hashed again until one is left; one range is its own root, an empty file the
    digest of no bytes). It depends on ``block_bytes``. A file with a range that could not be
    read keeps its row without a digest.
    """
    rows, empty = _listed(spark, path, suffixes)
    rows = rows.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")).unionByName(
        empty.select("path", F.lit(0).cast("bigint").alias("bytes"), F.lit(None).cast("timestamp").alias("modified"))
    )
    blocks = F.greatest(F.lit(1), F.ceil(F.col("bytes") / block_bytes)).cast("bigint")
    files = rows.withColumn("blocks", blocks)
    ranges = files.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("at"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            out = []
            for p, size, at in zip(batch["path"], batch["bytes"], batch["at"]):
                left, h = min(block_bytes, size - at * block_bytes), hashlib.sha256()
                try:
                    # The listing names local files "file:/a b", which is no escaped URI.
                    system, name = (fs.LocalFileSystem(), "/" + p[5:].lstrip("/")) if p.startswith("file:") else fs.FileSystem.from_uri(p)
                    with system.open_input_file(name) as f:
                        f.seek(at * block_bytes)
                        while left > 0:
                            piece = f.read(min(left, 1 << 20))
                            if not piece:
                                raise OSError("file ends early")
                            h.update(piece)
                            left -= len(piece)
                    out.append((p, at, h.hexdigest()))
                except (OSError, ValueError):
                    out.append((p, at, None))
            yield pd.DataFrame(out, columns=["path", "at", "digest"])

    # Ranges of one file go to different tasks; digests are few and small from here on.
    level = ranges.repartition("path", "at").mapInPandas(read, "path string, at long, digest string")
    ensure_checkpoint_dir(spark)
    level = level.checkpoint()  # bytes are read once, whatever the height of the trees
    most = files.agg(F.max("blocks")).first()[0] or 1
    while most > 1:
        joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "digest"))), lambda x: x["digest"]), "")
        whole = F.count("digest") == F.count(F.lit(1))
        single = F.col("blocks") <= 1
        sized = level.join(files.select("path", "blocks"), "path") if "blocks" not in level.columns else level
        up = sized.groupBy("path", F.expr(f"at div {FAN_OUT}").alias("up"), "blocks").agg(joined.alias("j"), whole.alias("ok"), F.min("digest").alias("one"))
        level = up.select(
            "path", F.col("up").alias("at"), F.ceil(F.col("blocks") / FAN_OUT).cast("bigint").alias("blocks"),
            F.when(F.col("ok"), F.when(single, F.col("one")).otherwise(F.sha2("j", 256))).alias("digest"),
        )
        most = -(-most // FAN_OUT)
    roots = level.select("path", "digest")
    return files.join(roots, "path", "left").withColumn("readable", F.col("digest").isNotNull())


def discover_inputs(files: DataFrame, kinds: dict[str, Sequence[str]], job: Column, name: Column) -> DataFrame:
    """Per job and input kind the file whose suffix comes first in the kind's list."""
    picks = []
    for kind, suffixes in kinds.items():
        for rank, suffix in enumerate(suffixes):
            picks.append(F.when(F.lower(name).endswith(suffix), F.struct(F.lit(kind).alias("kind"), F.lit(rank).alias("rank"))))
    rows = files.select(job.alias("job"), "path", F.explode(F.array_compact(F.array(*picks))).alias("p"))
    return rows.groupBy("job", F.col("p.kind").alias("kind")).agg(F.min_by("path", F.struct("p.rank", "path")).alias("path"))


WAV_SCHEMA = "path string, sample_rate long, channels long, bit_depth long, frames long, duration_sec double, decodable boolean"


def wav_headers(spark: SparkSession, path: str) -> DataFrame:
    """Header contract of WAV files; what cannot be decoded keeps a row with nulls."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for p, content in zip(batch["path"], batch["content"]):
                try:
                    with wave.open(io.BytesIO(content), "rb") as w:
                        rate, n = w.getframerate(), w.getnframes()
                        out.append((p, rate, w.getnchannels(), w.getsampwidth() * 8, n, n / rate, True))
                except (OSError, EOFError, wave.Error, ZeroDivisionError):
                    out.append((p, None, None, None, None, None, False))
            yield pd.DataFrame(out, columns=["path", "sample_rate", "channels", "bit_depth", "frames", "duration_sec", "decodable"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.wav").load(path)
    return files.select("path", "content").mapInPandas(decode, WAV_SCHEMA)


FRAME_SCHEMA = "path string, channel int, frame long, rate int, samples array<float>"


def wav_frames(spark: SparkSession, path: str, frame_sec: float = 0.01) -> DataFrame:
    """16-bit PCM to frames of fixed length, one row per (file, channel, frame), values in -1..1."""
    import numpy as np

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"]):
                with wave.open(io.BytesIO(content), "rb") as w:
                    rate, channels = w.getframerate(), w.getnchannels()
                    size, frame = max(1, int(round(rate * frame_sec))), 0
                    if w.getsampwidth() != 2:
                        continue
                    while True:
                        raw = w.readframes(size * 500)  # bounded blocks, so a long file never becomes one batch
                        if not raw:
                            break
                        block = np.frombuffer(raw, dtype="<i2").reshape(-1, channels).astype(np.float32) / 32768.0
                        parts = [block[i : i + size] for i in range(0, len(block), size)]
                        yield pd.DataFrame(
                            [(p, c, frame + i, rate, part[:, c]) for i, part in enumerate(parts) for c in range(channels)],
                            columns=["path", "channel", "frame", "rate", "samples"],
                        )
                        frame += len(parts)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.wav").load(path)
    return files.select("path", "content").mapInPandas(decode, FRAME_SCHEMA)


def archive_members(spark: SparkSession, path: str) -> DataFrame:
    """``archive, member, safe, content`` of ZIP files and plain folders alike."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for info in z.infolist():
                        if not info.is_dir():
                            yield pd.DataFrame([(p, info.filename, z.read(info))], columns=["archive", "member", "content"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    zips = files.where(F.lower("path").endswith(".zip")).select("path", "content").mapInPandas(unpack, "archive string, member string, content binary")
    base = F.lit(path.rstrip("/") + "/")
    plain = files.where(~F.lower("path").endswith(".zip")).select(base.alias("archive"), F.regexp_replace("path", "^[a-z]+:/*" + path.rstrip("/").lstrip("/") + "/", "").alias("member"), "content")
    both = zips.unionByName(plain)
    norm = F.regexp_replace(F.translate("member", "\\", "/"), r"^(\./)+", "")
    unsafe = norm.startswith("/") | norm.rlike(r"(^|/)\.\.(/|$)") | (norm == "")
    return both.select("archive", norm.alias("member"), (~unsafe).alias("safe"), "content")


