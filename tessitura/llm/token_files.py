"""Token ids as ORC files: integer run-length encoding, row indexes, Bloom filters on doc_id.

Documents are dealt into ranges of doc_id first, so each file holds one ascending range and
the texts are shuffled once. Each task then encodes, and Spark's ORC writer stores
``doc_id, part, ids, n_tokens``. ORC keeps integer lists run-length encoded in stripes; each
stripe carries minima, maxima and a Bloom filter of doc_id, so a reader splits a file by
stripes and a lookup of some ids skips stripes and row groups by metadata alone.

Encoding: the normaliser and the split pattern of the vocabulary never join characters
across white space, so a text's ids are those of its blank-separated words, one after the
other. Each task keeps the ids of words it has met in a table of at most ``CACHE_WORDS``
entries, which is emptied when full; it changes speed only. Tests compare with the ids of
whole texts.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import parts, shared_folder, table, text_rows

END_ID = 2
CACHE_WORDS = 600_000
#: Texts' bytes that are encoded at once.
STEP_BYTES = 6_000_000
#: The split takes these for white space, the vocabulary's pattern does not.
ODD_SPACE = "[\x1c-\x1f]"
#: Marks that the vocabulary's pattern takes as one run behind letters (apostrophes it does not).
TAIL = ".,;:!?)\"]}&$%#*@~^+=|_/\\>-"
LETTERS = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+"
SIMPLE = f"{LETTERS}[{re.escape(TAIL)}]*$"
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def vocabulary_file(name: str = "word_bpe_49k.json") -> str:
    """Path of a public vocabulary; every worker has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds(dict):
    """Little-endian 32-bit ids of a word, by word.

    Unknown words are encoded together, joined by blanks. Only the last id of a split
    carries the end-of-word mark, so the ids are dealt out to words by counting marks.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        setup = json.loads(self.tokenizer.to_str())
        mark = setup["model"]["end_of_word_suffix"]
        vocabulary = setup["model"]["vocab"]
        self.specials = [t["content"] for t in setup["added_tokens"]]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=np.int64)
        self.ends[[k for word, k in vocabulary.items() if word.endswith(mark)]] = 1
        self.split = regex.compile(setup["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])

    def ids_of(self, words: list[str], single: bool = False) -> list[bytes]:
        """The ids of each word; ``single``: each is one split of the vocabulary's pattern."""
        out: list[bytes] = []
        for k in range(0, len(words), CACHE_WORDS // 4):
            part = words[k : k + CACHE_WORDS // 4]
            self._learn([w for w in part if w not in self], single)
            out += map(self.__getitem__, part)
            if len(self) > CACHE_WORDS:
                self.clear()
        return out

    def _learn(self, new: list[str], single: bool) -> None:
        counted, splits = [], []
        for word in [] if single else new:
            # The lower case of U+0130 is no single letter; beyond U+024F letters may compose.
            if max(word, default="") < "\u0250" and "\u0130" not in word and not any(x in word for x in self.specials):
                counted.append(word)
                splits.append(len(self.split.findall(word.lower())))
            else:
                self[word] = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if single:
            counted, splits = new, [1] * len(new)
        for k in range(0, len(counted), 4096):
            self._encode(counted[k : k + 4096], splits[k : k + 4096])

    def _encode(self, words: list[str], splits: list[int]) -> None:
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype="<u4")
        done = np.cumsum(self.ends[ids])
        cuts = np.searchsorted(done, np.cumsum(splits)) + 1 if len(ids) else np.zeros(len(words), dtype=np.int64)
        flat, a = ids.tobytes(), 0
        for word, n, b in zip(words, splits, cuts.tolist()):
            self[word] = flat[4 * a : 4 * b] if n else b""
            a = b if n else a


@lru_cache(maxsize=2)
def _words(path: str) -> WordIds:
    return WordIds(path)


def runs_of(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Consecutive texts of at most ``most`` bytes together; a longer text is alone."""
    out, a, held = [], 0, 0
    for k, n in enumerate(sizes.tolist()):
        if held and held + n > most:
            out.append((a, k))
            a, held = k, 0
        held += n
    return [*out, (a, len(sizes))] if len(sizes) else out


def laid(units: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The units that ``codes`` name, side by side, and the length of each; ``units`` are joined, ``lengths`` long."""
    starts = np.cumsum(lengths) - lengths
    per = lengths[codes]
    ends = np.cumsum(per)
    take = np.repeat(starts[codes] - ends + per, per)
    take += np.arange(len(take))
    return units[take], per


def _word_lists(known: WordIds, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct words, joined, and how many each has.

    Latin letters with or without a tail of marks are one or two splits; those halves,
    fewer than words, are looked up once each. All other words are looked up whole.
    """
    simple = pc.match_substring_regex(words, SIMPLE).to_numpy(zero_copy_only=False)
    at, rest = np.flatnonzero(simple), np.flatnonzero(~simple)
    easy = words.take(pa.array(at))
    heads = pc.utf8_rtrim(easy, TAIL)
    tailed = np.flatnonzero(pc.less(pc.binary_length(heads), pc.binary_length(easy)).to_numpy(zero_copy_only=False))
    tails = pc.replace_substring_regex(easy.take(pa.array(tailed)), LETTERS, "").dictionary_encode()
    heads = pc.utf8_lower(heads).dictionary_encode()
    n, m = len(heads.dictionary), len(tails.dictionary)
    units = known.ids_of(heads.dictionary.to_pylist(), True) + known.ids_of(tails.dictionary.to_pylist(), True) + known.ids_of(words.take(pa.array(rest)).to_pylist()) + [b""]
    pairs = np.full((len(words), 2), len(units) - 1)
    pairs[at, 0] = heads.indices.to_numpy()
    pairs[at[tailed], 1] = n + tails.indices.to_numpy()
    pairs[rest, 0] = n + m + np.arange(len(rest))
    lengths = np.fromiter(map(len, units), dtype=np.int64, count=len(units)) // 4
    flat, per = laid(np.frombuffer(b"".join(units), dtype="<u4"), lengths, pairs.ravel())
    return flat, per.reshape(-1, 2).sum(axis=1)


def token_lists(texts: pa.Array, path: str, step: int = STEP_BYTES):
    """Ids of the texts, without special tokens: pieces ``(first text, offsets, ids)`` that follow each other.

    Words are split and made distinct by Arrow, looked up once each, and their ids laid
    beside each other by position; a piece holds texts of ``step`` bytes or one longer text.
    """
    known = _words(path)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for a, b in runs_of(sizes, step):
        part = pc.fill_null(texts.slice(a, b - a), "")
        if pc.any(pc.match_substring_regex(part, ODD_SPACE)).as_py():
            whole = [array("I", known.tokenizer.encode(t, add_special_tokens=False).ids) for t in part.to_pylist()]
            yield a, np.concatenate([[0], np.cumsum([len(x) for x in whole])]).astype(np.int64), np.frombuffer(b"".join(x.tobytes() for x in whole), dtype="<u4")
            continue
        lists = pc.utf8_split_whitespace(part)
        coded = lists.flatten().dictionary_encode()
        flat, per = laid(*_word_lists(known, coded.dictionary), coded.indices.to_numpy())
        ends = np.concatenate([[0], np.cumsum(per)])
        yield a, ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()], flat


def encode_texts(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as little-endian 32-bit integers, without special tokens."""
    return [ids[x:y].tobytes() for _, at, ids in token_lists(pa.array(texts, pa.string()), path) for x, y in zip(at[:-1].tolist(), at[1:].tolist())]


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> None:
    """Encode ``docs`` and write them in ascending doc_id order, null ids first.

    A null text counts as empty and holds the end id alone. Repeated doc_ids keep one row
    each. An empty table writes a folder without rows.
    """
    path = path or vocabulary_file()
    kind = pa.list_(pa.int32())

    def run(batches):
        for batch in batches:
            for first, at, flat in token_lists(batch.column("text"), path):
                piece = batch.slice(first, len(at) - 1)
                offsets = at + np.arange(len(at))
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.insert(flat, at[1:], end_id).view("<i4")), type=kind)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("part"), ids, pa.array(np.diff(offsets), pa.int32())], ["doc_id", "part", "ids", "n_tokens"])

    rows = text_rows(docs).repartitionByRange(parts(docs.sparkSession), "doc_id", F.crc32(F.col("text").cast("binary")))
    rows = rows.sortWithinPartitions("doc_id").withColumn("part", F.spark_partition_id())
    rows.mapInArrow(run, "doc_id long, part int, ids array<int>, n_tokens int").write.options(**ORC_OPTIONS).orc(folder)


def read_tokens(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Rows of a token folder; with ``doc_ids`` only those, skipped to by stripe metadata."""
    rows = spark.read.schema("doc_id long, part int, ids array<int>, n_tokens int").orc(folder)
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(doc_ids))


def token_digests(rows: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of rows read from a token folder.

    ``start`` adds, inside each file, the rows before it and, over files, one number per
    file. A range of doc_id is in one file unless one doc_id fills more than a task.
    """

    def run(batches):
        for batch in batches:
            lists = batch.column("ids")
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            at = lists.offsets.to_numpy()
            crcs = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), batch.column("n_tokens").cast(pa.int64()), pa.array(crcs, pa.int64())], ["doc_id", "part", "n_tokens", "ids_crc32"])

    made = rows.mapInArrow(run, "doc_id long, part int, n_tokens long, ids_crc32 long")
    sums = rows.groupBy("part").agg(F.sum(F.col("n_tokens").cast("long")).alias("sum"))
    before = sums.select("part", (F.sum("sum").over(Window.orderBy("part")) - F.col("sum")).alias("before"))
    inside = Window.partitionBy("part").orderBy("doc_id", "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    own = made.withColumn("own", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return own.join(F.broadcast(before), "part").select("doc_id", (F.col("before") + F.col("own")).alias("start"), "n_tokens", "ids_crc32")


def op5_token_files(spark, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), folder)
    return token_digests(read_tokens(spark, folder))
