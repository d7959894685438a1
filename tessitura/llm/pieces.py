"""SentencePiece encoding and decoding through a relational lattice.

A text is a blank followed by itself, blanks written as the mark U+2581. Encoding picks the
segmentation into pieces whose scores add up highest; of equal ones the path with longer
last pieces. Scores are the model file's log-probabilities, or follow from its ranks by
Zipf's law where the file has merge ranks only. Characters that are no piece become byte pieces at
the unknown score. Decoding joins pieces and bytes again.

1. Texts are cut into *units*: a cut lies wherever no piece holds the two characters beside
   it, so every path passes there and units can be solved alone, exactly. (A unit of over
   ``UNIT_LENGTH`` characters is cut there as well, which may change the pieces at the cut.)
2. Distinct units are exploded into substrings of bounded length, joined by equality with
   the piece table (a vocabulary, so its size is fixed; it is broadcast), and the edges are
   grouped by unit without another shuffle.
3. A higher-order ``aggregate`` folds the edges of a unit, ordered by their ends, into the best
   score and edge of every position; a second one walks back.
4. Documents are dealt into blocks of about ``BLOCK_BYTES`` by doc_id; each block meets the
   solved units that it holds, and nothing else, and writes down its ids.

Sizes: shuffled are the texts once, compressed, and each block's distinct units twice (the second
time with their ids). No
task holds more than a block with its units. Literal U+2581 characters are written as
bytes, so every text comes back as it was.
"""

from __future__ import annotations

import math
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import schema, table, text_rows
from .token_files import laid, runs_of

MARK = "▁"
BLOCK_BYTES = 32_000_000
UNKNOWN_PENALTY = 10.0
#: Text bytes that a task turns into words at once.
STEP_BYTES = 4_000_000
#: Steps of a score; an edge is packed into one integer: end, length, cost in steps, id.
STEPS = 1 << 14
UNIT_LENGTH = 1 << 20
PACK_BYTES, PACK_ROWS = 400_000, 5000


def model_file(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """Piece table of a model file: texts, scores, ids, byte pieces and adjacent characters."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        self.bytes = {int(model.id_to_piece(k)[3:5], 16): k for k in every if model.is_byte(k)}
        normal = [k for k in every if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k) or model.is_unused(k))]
        # Runs of marks carry a forbidding score and never win; without them a unit starts at every mark.
        self.rows = [(model.id_to_piece(k), float(model.get_score(k)), k) for k in normal if MARK not in model.id_to_piece(k)[1:]]
        if all(s <= 0 and s == int(s) for _, s, _ in self.rows):
            # A merge-rank file has no probabilities; ranks give them by Zipf's law.
            total = math.log(sum(1 / (1 - s) for _, s, _ in self.rows))
            self.rows = [(p, -math.log1p(-s) - total, k) for p, s, k in self.rows]
        # Multiples of a power of two: sums are exact, so solving units alone changes no tie.
        self.rows = [(p, round(s * STEPS) / STEPS, k) for p, s, k in self.rows]
        self.longest = max(len(p) for p, _, _ in self.rows)
        self.unknown = min(s for _, s, _ in self.rows) - UNKNOWN_PENALTY
        self.adjacent = frozenset(p[k : k + 2] for p, _, _ in self.rows for k in range(len(p) - 1))
        self.texts = [b""] * len(every)
        for p, _, k in self.rows:
            self.texts[k] = p.replace(MARK, " ").encode()
        for b, k in self.bytes.items():
            self.texts[k] = bytes([b])


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def lattice(units: DataFrame, pieces: Pieces) -> DataFrame:
    """Edges ``unit, b, e, cost, id`` of distinct units; id 0 stands for a character that is no piece."""
    rows = units.sparkSession.createDataFrame([(p, round(-s * STEPS), k) for p, s, k in pieces.rows], "piece string, cost int, id int")
    starts = units.filter("unit <> ''").select("unit", F.explode(F.sequence(F.lit(0), F.length("unit") - 1)).alias("b"))
    ends = starts.select("unit", "b", F.explode(F.sequence(F.col("b") + 1, F.least(F.length("unit"), F.col("b") + pieces.longest))).alias("e"))
    edges = ends.withColumn("piece", F.col("unit").substr(F.col("b") + 1, F.col("e") - F.col("b")))
    edges = edges.join(F.broadcast(rows), "piece", "left").filter("id is not null or e = b + 1")
    return edges.select("unit", "b", "e", F.coalesce("cost", F.lit(round(-pieces.unknown * STEPS))).alias("cost"), F.coalesce("id", F.lit(0)).alias("id"))


def solved(units: DataFrame, pieces: Pieces) -> DataFrame:
    """Best segmentation of distinct units: ``unit, ids``; -1 minus the code point for unknown characters.

    Edges are packed into integers that sort by end, longer ones last. The first fold
    keeps the least cost of every position; edges that reach it are on best paths; the
    second fold walks them back, the longer first.
    """

    def reach(best: Column, x: Column) -> Column:
        cost = F.get(best, x["b"]) + x["c"]
        return F.when(F.size(best) == x["e"], F.concat(best, F.array(cost))).when(cost < F.element_at(best, -1), F.concat(F.slice(best, F.lit(1), x["e"]), F.array(cost))).otherwise(best)

    def back(state: Column, x: Column) -> Column:
        return F.when(x["e"] == state["p"], F.struct(x["b"].alias("p"), F.concat(state["ids"], F.array(x["id"])).alias("ids"))).otherwise(state)

    def opened(x: Column) -> Column:
        e, low = F.shiftright(x, 41).cast("int"), x.bitwiseAND(65535).cast("int")
        b = e - F.shiftright(x, 36).bitwiseAND(31).cast("int")
        other = -1 - F.ascii(F.col("unit").substr(e, F.lit(1)))
        return F.struct(e.alias("e"), b.alias("b"), F.shiftright(x, 16).bitwiseAND((1 << 20) - 1).alias("c"), F.when(low == 0, other).otherwise(low).alias("id"))

    packed = F.shiftleft(F.col("e").cast("long"), 41) + F.shiftleft((F.col("e") - F.col("b")).cast("long"), 36) + F.shiftleft(F.col("cost").cast("long"), 16) + F.col("id")
    edges = lattice(units, pieces).select("unit", packed.alias("x")).groupBy("unit").agg(F.sort_array(F.collect_list("x")).alias("x"))
    grouped = edges.select("unit", F.transform("x", opened).alias("edges"))
    folded = grouped.select("unit", "edges", F.aggregate("edges", F.array(F.lit(0).cast("long")), reach).alias("best"))
    on_path = F.filter("edges", lambda x: F.get(F.col("best"), x["b"]) + x["c"] == F.get(F.col("best"), x["e"]))
    kept = folded.select("unit", F.reverse(on_path).alias("edges"))
    end = F.struct(F.length("unit").alias("p"), F.array().cast("array<int>").alias("ids"))
    return kept.select("unit", F.reverse(F.aggregate("edges", end, back)["ids"]).alias("ids"))


class _Blocks:
    """Block numbers: ranges of doc_id; repeated borders and null ids are dealt out by text."""

    def __init__(self, docs: DataFrame):
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(F.col("text").cast("string")).alias("n"))
        size = rows.agg(F.sum("n")).first()[0] or 0
        self.n = max(1, -(-size // BLOCK_BYTES))
        shares = [k / self.n for k in range(1, self.n)]
        borders = rows.agg(F.percentile_approx("doc_id", shares, 100 * self.n)).first()[0] if shares else []
        self.borders = np.array(borders or [], dtype=np.int64)

    def all_of(self, doc_ids: pa.Array, texts: pa.Array) -> np.ndarray:
        """The block of every row."""
        null = doc_ids.is_null().to_numpy(zero_copy_only=False)
        ids = pc.fill_null(doc_ids, 0).to_numpy(zero_copy_only=False)
        low, high = (np.searchsorted(self.borders, ids, side) for side in ("left", "right"))
        room = np.where(null, self.n, high - low + 1)
        spread = np.flatnonzero(null | (high - low > 1))
        out = np.where(null, 0, low)
        if len(spread):
            crcs = np.array([zlib.crc32(t.as_py()) for t in texts.take(pa.array(spread)).cast(pa.binary())], dtype=np.int64)
            out[spread] += crcs % room[spread]
        return out


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, text_crc32`` of every row; null and empty texts have no ids.

    Null and repeated doc_ids are rows like any other; empty tables give no rows; columns
    besides doc_id and text are ignored.
    """

    def lists(doc_ids: list, ends: np.ndarray, ids: np.ndarray, crcs: list[int]) -> list[pa.Array]:
        return [pa.array(doc_ids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())), pa.array(crcs, pa.int64())]

    return _encoded(docs, path, lists, "doc_id long, ids array<int>, text_crc32 long")


def _encoded(docs: DataFrame, path: str | None, finish, kind: str) -> DataFrame:
    """What ``finish`` makes of documents' ids: columns from doc_ids, borders of their ids, ids and text digests."""
    path = path or model_file()
    pieces, blocks, rows = pieces_of(path), _Blocks(docs), text_rows(docs)
    adjacent, names = _Cutter(pieces.adjacent), schema(kind).names
    literal = np.array([pieces.bytes[b] for b in MARK.encode()], dtype="<i4")
    by_byte = np.array([pieces.bytes[b] for b in range(256)], dtype="<i4")

    def words_by_block(batches):
        for batch in batches:
            texts = batch.column("text")
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            where = blocks.all_of(batch.column("doc_id"), texts)
            for block in np.unique(where).tolist():
                mine = np.flatnonzero((where == block) & (sizes > 0))
                for x, y in runs_of(sizes[mine], STEP_BYTES):
                    words = pc.unique(pc.split_pattern(texts.take(pa.array(mine[x:y])), " ").flatten())
                    units = pc.unique(adjacent.units_of(words)[0])
                    units = units.filter(pc.not_equal(units, ""))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(units), block, dtype=np.int32)), units], ["block", "unit"])

    def packed(batches):
        packer = zstandard.ZstdCompressor(level=6)
        waiting: dict[int, list] = {}

        def rows_of(blocks_due):
            out = []
            for block in blocks_due:
                _, ids, texts = waiting.pop(block)
                out.append((block, ids, [len(t) for t in texts], packer.compress(b"".join(texts))))
            if out:
                kinds = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], ["block", "doc_ids", "sizes", "packed"])

        for batch in batches:
            where = blocks.all_of(batch.column("doc_id"), batch.column("text")).tolist()
            for block, doc_id, text in zip(where, batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                raw = text.as_py()
                held = waiting.setdefault(block, [0, [], []])
                held[0] += len(raw)
                held[1].append(doc_id)
                held[2].append(raw)
                if held[0] >= PACK_BYTES or len(held[1]) >= PACK_ROWS:
                    yield from rows_of([block])
            # Few blocks meet in a task where ids lie together; where they do not, none waits for long.
            while sum(w[0] for w in waiting.values()) > 20 * PACK_BYTES:
                yield from rows_of([max(waiting, key=lambda b: waiting[b][0])])
        yield from rows_of(list(waiting))

    def write(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:  # units without texts do not occur; a table needs its columns all the same
            return pa.Table.from_batches([pa.RecordBatch.from_arrays(finish([], np.zeros(1, dtype=np.int64), np.zeros(0, dtype="<i4"), []), names)])
        unit_names = pa.chunked_array([*right.column("unit").chunks, pa.array([""])])
        known, lengths = _with_bytes(right.column("ids"), by_byte)
        known, lengths = np.concatenate([known, literal]), np.append(lengths, len(literal))
        made = []
        # Some packed rows at a time: no more than their texts is held beside the block's units.
        columns = [left.column(c) for c in ("doc_ids", "sizes", "packed")]
        for x, y in runs_of(np.array([sum(r) for r in columns[1].to_pylist()], dtype=np.int64), STEP_BYTES):
            sizes = np.concatenate([np.array(r, dtype=np.int64) for r in columns[1].slice(x, y - x).to_pylist()])
            plain = b"".join(zstandard.decompress(r.as_py()) for r in columns[2].slice(x, y - x))
            doc_ids = [i for r in columns[0].slice(x, y - x).to_pylist() for i in r]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            crcs = [zlib.crc32(plain[p:q]) for p, q in zip(ends[:-1].tolist(), ends[1:].tolist())]
            some = np.flatnonzero(sizes)  # an empty text has no ids
            starts = np.append(ends[some], ends[-1]).astype(np.int32)
            lists = pc.split_pattern(pa.StringArray.from_buffers(len(some), pa.py_buffer(starts), pa.py_buffer(plain)), " ")
            coded = lists.flatten().dictionary_encode()
            units, first, many = adjacent.units_of(coded.dictionary)
            codes = pc.index_in(units, value_set=unit_names).to_numpy(zero_copy_only=False)
            # Ids of the distinct words, then those of all words in order.
            order, _ = laid(np.arange(len(codes)), np.ones(len(codes), dtype=np.int64), _ranges(first, many))
            word_ids, per_unit = laid(known, lengths, codes[order])
            upto = np.concatenate([[0], np.cumsum(per_unit)])
            edges = np.concatenate([[0], np.cumsum(many)])
            flat, per_word = laid(word_ids, np.diff(upto[edges]), coded.indices.to_numpy())
            upto = np.concatenate([[0], np.cumsum(per_word)])
            n = np.zeros(len(sizes), dtype=np.int64)
            n[some] = np.diff(upto[lists.offsets.to_numpy()])
            made.append(pa.RecordBatch.from_arrays(finish(doc_ids, np.concatenate([[0], np.cumsum(n)]), flat, crcs), names))
        return pa.Table.from_batches(made)

    pairs = rows.mapInArrow(words_by_block, "block int, unit string")
    # One shuffle of the pairs serves both uses: the filter keeps both plans alike below it.
    held = pairs.groupBy("unit").agg(F.collect_set("block").alias("blocks"))
    best = solved(held.filter("size(blocks) > 0").select("unit"), pieces)
    known = best.join(held.filter("size(blocks) > 0"), "unit").select("unit", "ids", F.explode("blocks").alias("block"))
    texts = rows.mapInArrow(packed, "block int, doc_ids array<long>, sizes array<long>, packed binary")
    return texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(write, kind)


class _Cutter:
    """Cuts words into units; small enough to travel with a task."""

    def __init__(self, adjacent: frozenset):
        self.adjacent = adjacent
        self.pairs = np.array(sorted(ord(p[0]) << 21 | ord(p[1]) for p in adjacent), dtype=np.int64)

    def units_of(self, words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Units of all words, and per word the place of its first unit and their number."""
        if isinstance(words, pa.ChunkedArray):
            words = words.combine_chunks()
        strange = np.flatnonzero(pc.match_substring(words, MARK).to_numpy(zero_copy_only=False))
        plain = np.setdiff1d(np.arange(len(words)), strange) if len(strange) else np.arange(len(words))
        marked = pc.binary_join_element_wise(MARK, words.take(pa.array(plain)), "")
        joined = "".join(marked.to_pylist())
        raw = joined.encode()
        chars = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(1 + (chars > 0x7F) + (chars > 0x7FF) + (chars > 0xFFFF))])
        begin = np.concatenate([[0], np.cumsum(pc.utf8_length(marked).to_numpy(zero_copy_only=False))]).astype(np.int64)
        cut = np.ones(len(chars), dtype=bool)
        keys = chars[:-1] << 21 | chars[1:]
        spot = np.minimum(np.searchsorted(self.pairs, keys), max(len(self.pairs) - 1, 0))
        cut[1:] = self.pairs[spot] != keys if len(self.pairs) else True
        cut[begin[:-1]] = True
        starts = np.flatnonzero(cut)
        starts = self._bounded(starts, len(chars))
        units = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(at[starts], at[-1]).astype(np.int32)), pa.py_buffer(raw))
        first, many = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        place = np.searchsorted(starts, begin)
        first[plain], many[plain] = place[:-1], np.diff(place)
        if len(strange):
            lists = [self.units(w) for w in words.take(pa.array(strange)).to_pylist()]
            many[strange] = [len(x) for x in lists]
            first[strange] = len(units) + np.cumsum(many[strange]) - many[strange]
            units = pa.concat_arrays([units, pa.array([u for x in lists for u in x], pa.string())])
        return units, first, many

    @staticmethod
    def _bounded(starts: np.ndarray, n: int) -> np.ndarray:
        """Starts with further ones where a unit is longer than ``UNIT_LENGTH``."""
        long = np.flatnonzero(np.diff(np.append(starts, n)) > UNIT_LENGTH)
        more = [np.arange(a + UNIT_LENGTH, b, UNIT_LENGTH) for a, b in zip(starts[long], np.append(starts, n)[long + 1])]
        return np.sort(np.concatenate([starts, *more])) if len(long) else starts

    def units(self, word: str) -> list[str]:
        """Units of a word behind its mark; the empty string stands for a literal mark in it."""
        text, out, a, adjacent = MARK + word, [], 0, self.adjacent
        for k in range(1, len(text)):
            if text[k - 1 : k + 1] not in adjacent or text[k] == MARK or k - a == UNIT_LENGTH:
                out.append(text[a:k])
                a = k
        out.append(text[a:])
        if MARK not in word:
            return out
        made = out[:1]
        for unit in out[1:]:
            if unit[0] == MARK:  # a literal mark, and what follows it up to the next cut
                made.append("")
                unit = unit[1:]
            if unit:
                made.append(unit)
        return made


def _ranges(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for ``many`` steps, one range after the other."""
    return np.repeat(first - np.cumsum(many) + many, many) + np.arange(int(many.sum()))


def _with_bytes(lists, by_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and list lengths of a list column in which unknown characters are written as their byte pieces."""
    lists = lists.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) and lists.num_chunks else lists
    ids = np.asarray(lists.flatten() if len(lists) else [], dtype=np.int64)
    per = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, dtype=np.int64)
    odd = np.flatnonzero(ids < 0)
    if not len(odd):
        return ids.astype("<i4"), per.astype(np.int64)
    names, codes = np.unique(ids[odd], return_inverse=True)
    raw = [by_byte[np.frombuffer(chr(-1 - x).encode(), dtype=np.uint8)] for x in names.tolist()]
    # Every known id is a unit of one, every unknown character a unit of its bytes.
    place = np.arange(len(ids))
    place[odd] = len(ids) + codes
    sizes = np.concatenate([np.ones(len(ids), dtype=np.int64), [len(r) for r in raw]])
    flat, wide = laid(np.concatenate([ids, *raw]), sizes, place)
    upto = np.concatenate([[0], np.cumsum(wide)])
    edges = np.concatenate([[0], np.cumsum(per)])
    return flat.astype("<i4"), np.diff(upto[edges])


def _text_of(ids: np.ndarray, texts: list[bytes]) -> bytes:
    return b"".join(map(texts.__getitem__, ids.tolist()))[1:]


def _lists(batch, name: str = "ids"):
    """The rows of a list column as arrays, one at a time."""
    lists = batch.column(name)
    flat, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_pylist()
    return (flat[a:b] for a, b in zip(at, at[1:]))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Texts of ``ids`` columns: all columns but ``ids``, and ``text``."""
    texts = pieces_of(path or model_file()).texts
    kept = [c for c in encoded.columns if c != "ids"]

    def run(batches):
        for batch in batches:
            made = [_text_of(ids, texts).decode("utf-8", "replace") for ids in _lists(batch)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(made, pa.string())], [*kept, "text"])

    types = ", ".join(f"{c} {t}" for c, t in encoded.select(*kept).dtypes)
    return encoded.mapInArrow(run, f"{types}, text string")


def piece_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, n_pieces, ids_crc32, decoded_crc32, round_trip`` of every row.

    ``ids_crc32`` is over the ids as little-endian unsigned 32-bit integers; ``round_trip``
    tells whether the decoded text has the bytes of the text.
    """
    texts = pieces_of(model_file()).texts

    def counts(doc_ids: list, ends: np.ndarray, ids: np.ndarray, crcs: list[int]) -> list[pa.Array]:
        ids = ids.astype("<u4", copy=False)
        each = [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        decoded = [zlib.crc32(_text_of(x, texts)) for x in each]
        columns = [doc_ids, np.diff(ends), [zlib.crc32(x.tobytes()) for x in each], decoded]
        return [*(pa.array(c, pa.int64()) for c in columns), pa.array([a == b for a, b in zip(decoded, crcs)], pa.bool_())]

    return _encoded(docs, None, counts, "doc_id long, n_pieces long, ids_crc32 long, decoded_crc32 long, round_trip boolean")


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_counts(table(spark, sf_dir, "documents"))
