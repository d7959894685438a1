"""Benchmark decontamination by question templates.

Words lose their outer punctuation and their case; numbers become ``<num>``, unit words
after a number ``<unit>``, capitalised words inside a sentence ``<name>``. Windows of
``WIDTH`` template words of every benchmark item are hashed and joined with the windows of
all documents, and so are the same windows as plain words in lower case. A window with
fewer than half literal words would fit too much, so it has its plain form alone. An item
shorter than a window is one window of its own length.

A capitalised word that may open a sentence (at the start of the text, after an end mark, a
line end or ':') can be a literal or a name. Windows of items have all combinations of
these readings; windows of documents have three: literal after end marks only, literal at
all openings, and name everywhere. A window with such a name keeps ``WIDTH // 2`` literal
words at least. Thus equal words meet wherever they stand.

Along one alignment of a document with an item, each slot value of the item must always
stand against the same value of the document, and the other way round. Where a slot changes
its value, windows that contradict the commonest mapping are not counted, and what is left
counts only if it holds a run of ``RUN`` windows. A document is a leak of an item when at
least ``COVERAGE`` of the item's windows are left, or, whatever their share, ``RUN`` windows
in a row. Passages of the question re-asked with other numbers, names or units are found as
well as plain copies.

The hashes of the item windows go to every task while they are at most
``BROADCAST_WINDOWS`` (8 bytes each); then only documents' hits are shuffled. Beyond that
size every document window is a row of the join. Both ways give the same rows.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, fresh_name, table, text_rows

WIDTH = 8
COVERAGE = 0.5
RUN = 10
BROADCAST_WINDOWS = 2_000_000
# Unit words that count as units after a number.
UNITS = frozenset("mm cm m km in ft mi g kg mg lb oz l ml s sec min h hr hrs hours minutes seconds days weeks months years meters metres miles feet inches grams kilograms pounds liters litres dollars euros cents percent degrees".split())
CHUNK = 1 << 20


def _table(members) -> np.ndarray:
    made = np.zeros(256, dtype=bool)
    made[list(members)] = True
    return made


_SPACE, _DIGIT, _SMALL = _table([*range(9, 14), 32]), _table(range(48, 58)), _table(range(97, 123))
_ALNUM = _table([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])
_NUMERIC, _ENDS, _QUOTES = _table([*range(48, 58), *b".,:/-"]), _table(b".!?"), _table(b"\"')]}")
_RNG = np.random.default_rng(20)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHOWN = _RNG.integers(1, 1 << 63, 4, dtype=np.uint64)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        made = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, f)])) for f in (_FACTOR, _INVERSE)]
    return made[0], made[1]


def _lower(text: str) -> str:
    """Lower case with every character's number of UTF-8 bytes kept."""
    low = text.lower()
    if low.isascii() or len(low.encode()) == len(text.encode()) and len(low) == len(text):
        return low
    return "".join(x if len((x := c.lower()).encode()) == len(c.encode()) else c for c in text)


class Words:
    """Words of some texts as arrays: hash of the core, slot kind, text number, core's place.

    Words are runs without ASCII blanks; a core is a word without its outer ASCII marks,
    in lower case; words of marks alone are left out.
    """

    def __init__(self, texts: list[str]):
        self.low = "\n".join(map(_lower, texts)).encode()
        original, low = np.frombuffer("\n".join(texts).encode(), dtype=np.uint8), np.frombuffer(self.low, dtype=np.uint8)
        blank = _SPACE[original]
        edges = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]])))
        starts, ends = edges[::2], edges[1::2]
        inner = np.flatnonzero(_ALNUM[original])
        low_at = np.searchsorted(inner, starts)
        full = low_at < np.searchsorted(inner, ends)
        marks = original[ends - 1] if len(ends) else original[:0]
        before = original[np.maximum(ends - 2, starts)] if len(ends) else original[:0]
        stops = np.concatenate([[0], np.cumsum(_ENDS[marks] | _QUOTES[marks] & _ENDS[before])])
        kept = np.flatnonzero(full)
        self.first = inner[low_at[kept]]
        self.last = inner[np.searchsorted(inner, ends[kept]) - 1] + 1
        sizes = np.array([len(t.encode()) + 1 for t in texts], dtype=np.int64)
        self.text = np.searchsorted(np.cumsum(sizes), self.first, "right")
        opens = np.concatenate([[True], (stops[kept[1:]] > stops[kept[:-1]]) | (self.text[1:] != self.text[:-1])])[: len(kept)]
        lines = np.cumsum(original == 10)[self.first]
        colons = np.concatenate([[0], np.cumsum((marks == 58) | _QUOTES[marks] & (before == 58))])
        self.may_open = opens.copy()
        self.may_open[1:] |= (lines[1:] > lines[:-1]) | (colons[kept[1:]] > colons[kept[:-1]])
        self.plain = self._hashes(low)
        kinds = self._kinds(original, low)
        self.may_open &= kinds == 3
        #: Readings of all words: 0 literal, 1 number, 2 unit, 3 name, 4 name that may be an opening word.
        self.named = np.where(self.may_open, 4, kinds).astype(np.int8)
        self.literal = np.where(self.may_open, 0, kinds).astype(np.int8)
        self.usual = np.where(opens & (kinds == 3), 0, self.named).astype(np.int8)

    def _hashes(self, low: np.ndarray) -> np.ndarray:
        """Polynomial hashes of the cores from running sums over pieces of the bytes."""
        made = np.zeros(len(self.first), dtype=np.uint64)
        done = 0
        with np.errstate(over="ignore"):
            while done < len(made):
                base = self.first[done]
                upto = max(int(np.searchsorted(self.last, base + CHUNK, "right")), done + 1)
                a, b = self.first[done:upto] - base, self.last[done:upto] - base
                up, down = _powers(CHUNK) if b[-1] <= CHUNK else _powers.__wrapped__(int(b[-1]))
                sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[low[base : base + b[-1]]] * up[: b[-1]])])
                made[done:upto] = (sums[b] - sums[a]) * down[a]
                done = upto
            made = (made ^ made >> np.uint64(32)) * _FACTOR
        return made ^ made >> np.uint64(29)

    def _kinds(self, original: np.ndarray, low: np.ndarray) -> np.ndarray:
        """0 literal, 1 number, 2 unit, 3 capitalised."""
        a, b = self.first, self.last
        turned = np.concatenate([original != low, [False] * 3])
        lead = original[a]
        capital = turned[a] | (lead >= 0xC2) & turned[a + 1] | (lead >= 0xE0) & turned[a + 2]
        kinds = np.zeros(len(a), dtype=np.int8)
        maybe = np.flatnonzero(capital)
        if len(maybe):
            # Words all in capitals are loud, not names.
            small = np.concatenate([[0], np.cumsum(_SMALL[original] | (original >= 0xC2) & ~(turned[:-3] | turned[1:-2] | turned[2:-1]))])
            loud = (small[b[maybe]] == small[a[maybe]]) & (b[maybe] - a[maybe] > 1)
            kinds[maybe[~loud]] = 3
        for k in np.flatnonzero(_DIGIT[lead]).tolist():
            if _NUMERIC[original[a[k] : b[k]]].all():
                kinds[k] = 1
                if k + 1 < len(a) and self.text[k + 1] == self.text[k] and self.core(k + 1) in UNITS:
                    kinds[k + 1] = 2
        return kinds

    def core(self, k: int) -> str:
        return self.low[self.first[k] : self.last[k]].decode("utf-8", "replace")

    def whole(self, width: int) -> np.ndarray:
        """Starts of the runs of ``width`` words which lie in one text."""
        n = max(len(self.first) - width + 1, 0)
        return np.flatnonzero(self.text[:n] == self.text[width - 1 :]) if n else np.zeros(0, dtype=np.int64)

    def windows(self, width: int):
        """Yields ``(kinds, hashes, usable)`` of every run of ``width`` words for each reading of a document."""
        yield np.zeros_like(self.usual), ~_windows(self.plain, width), np.ones(max(len(self.first) - width + 1, 0), dtype=bool)
        for kinds in (self.usual, self.literal, self.named):
            usable = _usable(kinds, width)
            if kinds is not self.usual:
                usable &= _sums(kinds != self.usual, width) > 0
            yield kinds, _windows(self._shown(kinds), width), usable

    def readings(self, at: int, width: int):
        """Yields ``(kinds, hash)`` of one window for all readings of an item."""
        run = slice(at, at + width)
        yield np.zeros(width, dtype=np.int8), ~_windows(self.plain[run], width)[0]
        places = np.flatnonzero(self.may_open[run])
        for chosen in product((False, True), repeat=len(places)):
            kinds = self.literal[run].copy()
            kinds[places[list(chosen)]] = 4
            if _usable(kinds, width)[0]:
                yield kinds, _windows(np.where(kinds == 0, self.plain[run], _SHOWN[np.minimum(kinds, 3)]), width)[0]

    def _shown(self, kinds: np.ndarray) -> np.ndarray:
        return np.where(kinds == 0, self.plain, _SHOWN[np.minimum(kinds, 3)])

    def described(self, at: int, kinds: np.ndarray):
        """Template of the window at ``at`` whose words have ``kinds``, and its slots: kind, place (a digit), value."""
        shown, slots = [], []
        for k, kind in enumerate(kinds.tolist()):
            core = self.core(at + k)
            shown.append(("", "<num>", "<unit>", "<name>", "<name>")[kind] or core)
            if kind:
                slots.append(f"{kind}{k}{core}")
        return " ".join(shown), slots


def _sums(flags: np.ndarray, width: int) -> np.ndarray:
    """Set flags in every run of ``width``."""
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[width:] - sums[:-width] if len(flags) >= width else np.zeros(0, dtype=np.int64)


def _usable(kinds: np.ndarray, width: int) -> np.ndarray:
    """Whether the template of every run of ``width`` words has enough literal words."""
    slots = _sums(kinds > 0, width)
    return (2 * slots <= width) & ((_sums(kinds == 4, width) == 0) | (width - slots >= WIDTH // 2))


def _windows(values: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of every run of ``width`` values, built from runs of doubled width."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        made, done, run, size, factor = None, 0, values * _FACTOR ^ values >> np.uint64(31), 1, _FACTOR
        while size <= width:
            if width & size:
                part = run[done : done + n]
                made, done = part if made is None else made * factor + part, done + size
            size *= 2
            if size <= width:
                run = run[: len(run) - size // 2] * factor + run[size // 2 :]
                factor = factor * factor
        return made ^ made >> np.uint64(29)


_SHAPE = "id long, digest binary, width int, pos long, n long, hash long, template string, slots array<string>"


def _scan(rows: DataFrame, widths: list[int] | None, known=None) -> DataFrame:
    """Windows of ``id, text`` rows; only hashes in the broadcast array ``known``, if given.

    Without ``widths`` a text's window is as wide as the text, up to ``WIDTH``.
    """

    def found(ids, texts, wanted, quick):
        words = Words(texts)
        bounds = np.searchsorted(words.text, np.arange(len(texts) + 1))
        digests: dict[int, bytes] = {}
        for width in widths or [min(WIDTH, max(1, len(words.first)))]:
            for k, kinds, made in seen(words, width, wanted, quick):
                t = int(words.text[k])
                if t not in digests:
                    digests[t] = hashlib.sha256(texts[t].encode()).digest()
                yield (ids[t], digests[t], width, k - int(bounds[t]), int(bounds[t + 1] - bounds[t]) - width + 1, int(made.view(np.int64)), *words.described(k, kinds))

    def seen(words, width, wanted, quick):
        whole = words.whole(width)
        if widths is None:
            for k in whole.tolist():
                for kinds, made in words.readings(k, width):
                    yield k, kinds, made
            return
        for kinds, hashes, usable in words.windows(width):
            at = whole[usable[whole]]
            if wanted is not None:
                at = at[quick[(hashes[at] >> np.uint64(44)).astype(np.int64)]]
                at = at[np.isin(hashes[at], wanted)]
            for k in at.tolist():
                yield k, kinds[k : k + width], hashes[k]

    def run(batches):
        wanted = known.value if known is not None else None
        quick = np.zeros(1 << 20, dtype=bool)
        if wanted is not None:
            quick[(wanted >> np.uint64(44)).astype(np.int64)] = True
        out = []
        for batch in batches:
            ids, texts, a, size = batch.column("id").to_pylist(), batch.column("text").to_pylist(), 0, 0
            for k, text in enumerate(texts):
                size += len(text)
                if size >= CHUNK or k + 1 == len(texts) or widths is None:
                    for row in found(ids[a : k + 1], texts[a : k + 1], wanted, quick):
                        out.append(row)
                        if len(out) >= 5000:
                            yield _batch(out)
                            out = []
                    a, size = k + 1, 0
        if out:
            yield _batch(out)

    return rows.mapInArrow(run, _SHAPE)


def _batch(rows: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string())]
    names = [part.split()[0] for part in _SHAPE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(column), kind) for column, kind in zip(zip(*rows), kinds)], names)


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """One row per document and item that it leaks.

    Columns ``doc_id, item_id, coverage, windows, reworded`` (some slot has another value)
    and ``digest`` (SHA-256 of the text), which tells rows with one doc_id apart. Null and empty texts, items
    without words and empty tables give no rows; rows repeated in full give one.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    held = checkpointed(_scan(items, None).withColumnRenamed("n", "windows"))
    n = held.count()
    widths = sorted(r["width"] for r in held.select("width").distinct().collect())  # at most WIDTH numbers
    rows = text_rows(docs).withColumnRenamed("doc_id", "id")
    known = None
    if n <= broadcast_windows:
        hashes = held.select("hash").distinct().toPandas()["hash"].to_numpy(dtype=np.int64).view(np.uint64)
        known = spark.sparkContext.broadcast(np.sort(hashes))
    hits = _scan(rows, widths or [WIDTH], known).drop("n")
    theirs = held.select("hash", "template", "width", F.col("id").alias("item_id"), F.col("digest").alias("item_digest"), F.col("pos").alias("item_pos"), "windows", F.col("slots").alias("item_slots"))
    if known is not None:
        theirs = F.broadcast(theirs)
    met = hits.join(theirs, ["hash", "template", "width"]).withColumn("way", F.col("pos") - F.col("item_pos"))
    # A name that may be an opening word (kind 4) is a name like any other, but tears no alignment.
    name = lambda x: F.concat(F.translate(F.substring(x, 1, 1), "4", "3"), F.substr(x, F.lit(3)))
    pair = lambda x, y: F.struct(name(y).alias("theirs"), name(x).alias("ours"), (x.startswith("4") | y.startswith("4")).alias("soft"), F.substring(y, 2, 1).cast("int").alias("place"))
    way = F.struct(F.col("id").alias("doc_id"), "digest", "item_id", "item_digest", "way")
    met = checkpointed(met.select(way.alias("way"), "windows", "item_pos", F.zip_with("slots", "item_slots", pair).alias("pairs")))

    pairs = met.select("way", "item_pos", F.explode("pairs").alias("p")).select("way", "item_pos", "p.*")
    words = pairs.groupBy("way", "theirs", "ours", (F.col("item_pos") + F.col("place")).alias("place")).agg(F.min("soft").alias("soft"))
    kinds = words.groupBy("way", "theirs", "ours").agg(F.min("soft").alias("soft"), F.count(F.lit(1)).alias("k"))
    other = kinds.filter("ours <> theirs").select("way").distinct().withColumn("other", F.lit(True))
    torn = _several(kinds.filter("not soft")).withColumn("torn", F.lit(True))
    # Where slots change their values, the commonest value is taken and windows with another one are not counted.
    mixed = checkpointed(kinds.join(_several(kinds), "way"))
    best = [mixed.groupBy("way", a).agg(F.max_by(b, F.struct("k", F.col("ours") == F.col("theirs"), b)).alias(f"best_{b}")) for a, b in (("theirs", "ours"), ("ours", "theirs"))]
    wrong = mixed.join(best[0], ["way", "theirs"]).join(best[1], ["way", "ours"]).filter("ours <> theirs and (ours <> best_ours or theirs <> best_theirs)").select("way", "theirs", "ours")
    wrong = pairs.join(wrong, ["way", "theirs", "ours"]).select("way", "item_pos", F.lit(True).alias("wrong")).distinct()
    # The same window may be met in several readings, of which one is enough.
    kept = met.groupBy("way", "item_pos").agg(F.first("windows").alias("windows")).join(wrong, ["way", "item_pos"], "left")
    alike = met.filter(~F.exists("pairs", lambda p: p["ours"] != p["theirs"])).select("way", "item_pos", F.lit(True).alias("alike")).distinct()
    kept = kept.join(alike, ["way", "item_pos"], "left").filter("wrong is null or alike").join(torn, "way", "left").join(other, "way", "left")
    runs = kept.withColumn("run", F.col("item_pos") - F.row_number().over(Window.partitionBy("way").orderBy("item_pos")))
    runs = runs.groupBy("way", "run").agg(F.count(F.lit(1)).alias("k")).groupBy("way").agg(F.max("k").alias("run"))
    kept = kept.join(runs, "way").withColumn("counts", F.coalesce(~F.col("torn"), F.lit(True)) | (F.col("run") >= RUN)).filter("counts")
    found = kept.groupBy("way.doc_id", "way.digest", "way.item_id", "way.item_digest").agg(F.countDistinct("item_pos").alias("hit"), F.max("run").alias("run"), F.first("windows").alias("windows"), F.coalesce(F.max("other"), F.lit(False)).alias("reworded"))
    found = found.withColumn("coverage", F.col("hit") / F.col("windows")).filter((F.col("coverage") >= coverage) | (F.col("run") >= RUN))
    return found.groupBy("doc_id", "digest", "item_id").agg(F.max("coverage").alias("coverage"), F.max("windows").alias("windows"), F.min("reworded").alias("reworded"))


def _several(kinds: DataFrame) -> DataFrame:
    """``way`` of the alignments where a slot value stands against several others."""
    both = [kinds.groupBy("way", c).agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("way") for c in ("theirs", "ours")]
    return both[0].unionByName(both[1]).distinct()


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that leak no item, with all their columns."""
    one, other = fresh_name(docs, "leak_id"), fresh_name(docs, "leak_digest")
    found = leaks(docs, benchmark).select(F.col("doc_id").alias(one), F.col("digest").alias(other)).distinct()
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(one)) & (F.unhex(F.sha2(text.cast("binary"), 256)) == F.col(other))
    return docs.join(found, same, "left_anti")


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("digest")
