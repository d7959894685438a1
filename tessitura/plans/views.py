"""Logical tables of the engine as views over the provided parquet tables.

Times are BIGINT microseconds. The DuckDB text of every view stands in ``SQL_VIEWS``
of ``catalogue_sql`` with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import scans
from ..operators.scans import HotKeys, find_hot_keys, following, row_number, scan

SONG = ["song_id"]
DAY_US = 86_400_000_000
HOUR_US = 3_600_000_000


class Tables:
    """Reads one scale-factor folder; every view selects only the columns it needs."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._hot: dict = {}

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def hot(self, table: str, column: str, alias: str) -> HotKeys:
        """Hot keys of a raw column, counted once per reader and reused by derived views."""
        if (table, column) not in self._hot:
            rows = self.read(table).select(F.col(column).alias(alias))
            self._hot[table, column] = find_hot_keys(rows, [alias])
        return self._hot[table, column]

    @property
    def hot_songs(self) -> HotKeys:
        return self.hot("events", "user_id", "song_id")

    @property
    def hot_conversations(self) -> HotKeys:
        return self.hot("conversations", "conv_id", "song")

    # -- timeline ---------------------------------------------------------------

    def timed_events(self) -> DataFrame:
        ts = F.unix_micros(F.col("ts").cast("timestamp"))
        return self.read("events").select(
            F.col("user_id").alias("song_id"),
            "event_id",
            "event_type",
            "value",
            ts.alias("start_us"),
            F.regexp_extract("props", r"(\d+)", 1).cast("bigint").alias("k"),
        )

    def notes(self) -> DataFrame:
        rows = scan(self.timed_events(), SONG, ["start_us", "event_id"], [row_number("n")], self.hot_songs)
        return rows.select(
            "song_id",
            (F.col("n") - 1).alias("note_index"),
            F.col("event_type").alias("track"),
            (48 + F.col("k") % 25).alias("pitch"),
            "start_us",
            (F.col("start_us") + F.round(F.col("value") * 100).cast("bigint") * 6_000_000).alias("end_us"),
        )

    def mono_notes(self) -> DataFrame:
        """Notes cut at the next start: no overlaps; a note of no length may remain."""
        rows = scan(self.notes(), SONG, ["start_us", "note_index"], [following("next_us", F.col("start_us"))], self.hot_songs)
        return rows.withColumn("end_us", F.least("end_us", "next_us")).drop("next_us")

    def windows(self) -> DataFrame:
        """Two accepted windows per day with events: 00:00-12:00 and 12:00-20:00."""
        days = self.timed_events().select("song_id", F.floor(F.col("start_us") / DAY_US).alias("day")).distinct()
        part = F.explode(
            F.array(
                F.struct(F.lit("a").alias("p"), F.lit(0).alias("from"), F.lit(12).alias("to")),
                F.struct(F.lit("b").alias("p"), F.lit(12).alias("from"), F.lit(20).alias("to")),
            )
        )
        return days.select("song_id", "day", part.alias("w")).select(
            "song_id",
            F.format_string("%d-%d%s", "song_id", "day", "w.p").alias("clip_id"),
            (F.col("day") * DAY_US + F.col("w.from") * HOUR_US).alias("start_us"),
            (F.col("day") * DAY_US + F.col("w.to") * HOUR_US).alias("end_us"),
        )

    def exclusions(self) -> DataFrame:
        return self.notes().where("track = 'error'").select("song_id", "start_us", "end_us")

    def on_off(self) -> DataFrame:
        """Click is note-on, view is note-off, signup is a tempo event."""
        kind = F.when(F.col("event_type") == "click", "on").when(F.col("event_type") == "view", "off")
        return self.timed_events().where("event_type in ('click', 'view')").select(
            F.col("song_id").alias("track"), "event_id", "start_us", (F.col("k") % 8).alias("pitch"), kind.alias("kind")
        )

    # -- manifest ---------------------------------------------------------------

    def clips(self) -> DataFrame:
        docs = self.read("documents").select(
            F.col("doc_id").alias("clip_id"),
            F.col("source").alias("song_id"),
            F.sha2("text", 256).alias("audio_sha256"),
            F.col("n_chars").alias("duration_ms"),
            F.col("lang").alias("language"),
        )
        labels = self.read("labels").select(F.col("doc_id").alias("clip_id"), "quality", "toxic")
        status = F.when(F.col("quality") == 1, "accepted").when(F.col("quality") == 0, "rejected").otherwise("review")
        split = F.when(F.col("clip_id") % 10 < 8, "train").when(F.col("clip_id") % 10 == 8, "validation")
        return docs.join(labels, "clip_id", "left").select(
            *docs.columns,
            status.alias("status"),
            F.when(F.col("toxic") == 0, "confirmed").otherwise("uncertain").alias("singer_status"),
            F.when(F.col("duration_ms") >= 500, "clean").otherwise("artifact").alias("quality"),
            split.when(F.col("clip_id") % 10 == 9, "benchmark").alias("split"),
        )

    def members(self) -> DataFrame:
        return self.read("pages").select(
            "page_id", F.col("url").alias("path"), F.sha2("html", 256).alias("sha256"), F.length("html").cast("bigint").alias("bytes")
        )

    def registered(self) -> DataFrame:
        """Members as an older register knows them: some absent, some with another hash."""
        pages = self.read("pages").where("page_id % 11 <> 0")
        changed = F.when(F.col("page_id") % 7 == 0, F.sha2(F.concat("html", F.lit("x")), 256)).otherwise(F.sha2("html", 256))
        return pages.select("page_id", F.col("url").alias("path"), changed.alias("sha256"))

    # -- issues -----------------------------------------------------------------

    def issues(self) -> DataFrame:
        e = self.timed_events()
        name = F.when(F.col("event_type") == "error", "MIDI_GAP_AUDIO_CONFLICT")
        name = name.when(F.col("event_type") == "signup", "INTRA_PHRASE_MIDI_GAP")
        name = name.when(F.col("event_type") == "view", "PRONUNCIATION_CROSSCHECK_MISMATCH").otherwise("OTHER_ISSUE")
        raw = F.concat_ws("|", F.col("song_id").cast("string"), "event_type", F.col("k").cast("string"))
        return e.select(
            F.concat(F.lit("ds-"), F.substring(F.sha1(raw), 1, 12)).alias("issue_id"),
            F.col("song_id").cast("string").alias("song_id"),
            name.alias("type"),
            F.col("k").alias("boundary_index"),
            F.concat_ws("-", "event_type", F.col("k").cast("string")).alias("segment_id"),
            F.when(F.col("event_type") == "purchase", "accepted").otherwise("pending").alias("status"),
            F.col("event_id").alias("position"),
        )

    # -- pronunciation ----------------------------------------------------------

    def variants(self) -> DataFrame:
        """Three renderings of each turn: plain, without stops and commas, without accents."""
        low = F.lower("text")
        c = self.read("conversations")
        kind = F.explode(
            F.array(
                F.struct(F.lit("a").alias("backend"), low.alias("line")),
                F.struct(F.lit("b").alias("backend"), F.regexp_replace(low, "[.,]", "").alias("line")),
                F.struct(F.lit("c").alias("backend"), F.translate(low, "é", "e").alias("line")),
            )
        )
        return c.select("conv_id", "turn", kind.alias("v")).select("conv_id", "turn", "v.backend", "v.line")

    def dictionary(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_brand").alias("key"),
            F.col("p_type").alias("value"),
            (F.col("p_size") % 3).cast("bigint").alias("layer"),
            F.col("p_partkey").alias("position"),
        )

    # -- sequences --------------------------------------------------------------

    def item_elements(self) -> DataFrame:
        """Elements of score items, one row per note, with a unique order inside the item."""
        li = self.read("lineitem")
        return li.select(
            F.col("l_orderkey").alias("item_id"),
            F.col("l_linenumber").cast("bigint").alias("line"),
            F.col("l_partkey").alias("part"),
            F.col("l_suppkey").alias("supp"),
            F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
            F.col("l_quantity").cast("bigint").alias("note_dur"),
            (F.round("l_extendedprice").cast("bigint") % 50).alias("ph_dur"),
            F.when(F.col("l_returnflag") == "R", 0).otherwise(1).cast("bigint").alias("note_slur"),
            F.col("l_linestatus").alias("unit"),
        )

    ITEM_ORDER = ("line", "part", "supp", "cents")

    @property
    def hot_items(self) -> HotKeys:
        return self.hot("lineitem", "l_orderkey", "item_id")

    # -- frames and captions ----------------------------------------------------

    def frames(self) -> DataFrame:
        return self.read("embeddings").select(
            F.col("label").cast("bigint").alias("song_id"), F.col("vec_id").alias("frame"), F.col("embedding").alias("samples")
        )

    def frame_values(self) -> DataFrame:
        """One row per sample: x, voiced flag and pitch 220 * 2^x."""
        return self.frames().select("song_id", "frame", F.posexplode("samples").alias("idx", "x")).select(
            "song_id",
            "frame",
            F.col("idx").cast("bigint").alias("idx"),
            F.col("x").cast("double").alias("x"),
            (F.col("x") > 0).alias("voiced"),
            (F.lit(220.0) * F.pow(F.lit(2.0), F.col("x").cast("double"))).alias("f0"),
        )

    def captions(self) -> DataFrame:
        """Turns as captions; a caption starts where the earlier ones of its song end."""
        c = self.read("conversations").select(
            F.col("conv_id").alias("song"),
            F.col("turn").alias("id"),
            "text",
            (F.greatest(F.lit(1), F.length("text")) * 50).cast("bigint").alias("duration_ms"),
        )
        timed = scan(c, ["song"], ["id", "text"], [scans.running_sum("start_ms", F.col("duration_ms"), inclusive=False)], self.hot_conversations)
        marks = lambda ch: (F.length("text") - F.length(F.replace("text", F.lit(ch), F.lit("")))).cast("bigint")
        return timed.select(
            "song", "id", "text", "duration_ms",
            F.coalesce("start_ms", F.lit(0).cast("bigint")).alias("start_ms"),
            marks(",").alias("commas"), marks(".").alias("stops"), marks(" ").alias("blanks"),
        )
