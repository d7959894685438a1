"""Token files and pieces against whole-text encoding, brute force and round trips."""

import zlib

import numpy as np
import pytest
from helpers import SF, docs, odd_rows, plain, with_extra_columns
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessitura.llm import pieces, token_files
from tessitura.llm.common import shared_folder

ODD_TEXTS = ["", "  ", "áb  x y <|endoftext|>z it's 12  q İ STRASSE ﬁ 's　't", "a\x1cb\x1f c", "'Stupid don'T I'LL ¼½ x²y ªº ß ẞ Σας ΟΔΟΣ", "a\x85b\xa0c", "éa ́x", "\x00\x01a\x7f b\xadc"]


def test_word_ids_equal_whole_text_ids(spark, monkeypatch):
    path = token_files.vocabulary_file()
    whole = Tokenizer.from_file(path)
    texts = ODD_TEXTS + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(60).collect()]
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    for room in (50, 1_000_000):
        monkeypatch.setattr(token_files, "CACHE_WORDS", room)
        token_files._words.cache_clear()
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in token_files.encode_texts(texts, path)] == want
    token_files._words.cache_clear()


@pytest.mark.parametrize("clash", [False, True])
def test_token_files_hold_ids_in_order(spark, clash):
    table = docs(spark, odd_rows())
    folder = shared_folder(spark, "tokens")
    token_files.write_tokens(with_extra_columns(table) if clash else table, folder)
    rows = token_files.read_tokens(spark, folder)
    whole = Tokenizer.from_file(token_files.vocabulary_file())
    want = sorted((str(i), *whole.encode(t or "", add_special_tokens=False).ids, 2) for i, t in odd_rows())
    assert sorted((str(r["doc_id"]), *r["ids"]) for r in rows.collect()) == want
    found = sorted(token_files.token_digests(rows).collect(), key=lambda r: r["start"])
    at = 0
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in found]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
    crcs = {r["ids_crc32"] for r in found}
    assert zlib.crc32(np.array([2], dtype="<u4").tobytes()) in crcs
    assert [r["doc_id"] for r in token_files.read_tokens(spark, folder, [9]).collect()] == [9]


def test_orc_prunes_by_doc_id(spark):
    folder = shared_folder(spark, "tokens")
    token_files.write_tokens(spark.read.parquet(f"{SF}/documents.parquet"), folder)
    plan = token_files.read_tokens(spark, folder, [5])._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "doc_id" in plan.split("PushedFilters")[1]


def best_path(text, table):
    best = [(0.0, 0, 0)]
    for e in range(1, len(text) + 1):
        top = None
        for b in range(max(0, e - table.longest), e):
            got = known(table).get(text[b:e]) or ((table.unknown, -1) if b == e - 1 else None)
            if got and (top is None or best[b][0] + got[0] > top[0]):
                top = (best[b][0] + got[0], b, got[1])
        best.append(top)
    ids, at = [], len(text)
    while at:
        _, b, k = best[at]
        ids = ([k] if k >= 0 else [table.bytes[x] for x in text[b:at].encode()]) + ids
        at = b
    return ids


def known(table):
    if not hasattr(table, "known"):
        table.known = {p: (s, k) for p, s, k in table.rows}
    return table.known


@pytest.mark.parametrize("clash", [False, True])
def test_pieces_equal_brute_force_and_come_back(spark, clash, monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK_BYTES", 2000)
    rows = [(i, t) for i, t in odd_rows() if i not in (6, 7)] + [(50, "Hello  world\nfoo é€𝒳 \t x"), (51, "unbelievable antidisestablishmentarianism" * 3)]
    table = pieces.pieces_of(pieces.model_file())
    made = pieces.encode(with_extra_columns(docs(spark, rows)) if clash else docs(spark, rows))
    found = sorted(((r["doc_id"], list(r["ids"])) for r in made.collect()), key=str)
    # Literal marks are bytes and cut the text for the brute force, too.
    assert [x for x in found if x[0] != 8] == sorted(((i, best_path(pieces.MARK + t.replace(" ", pieces.MARK), table) if t else []) for i, t in rows if i != 8), key=str)
    back = pieces.decode(made)
    assert plain(back.select("doc_id", "text")) == sorted(((i, t or "") for i, t in rows), key=str)


def test_library_decodes_the_pieces_to_the_text(spark):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=pieces.model_file())
    few = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 12")
    texts = {r["doc_id"]: r["text"] for r in few.collect()}
    for r in pieces.encode(few).collect():
        assert model.decode(list(r["ids"])) == texts[r["doc_id"]]


def test_long_units_and_empty_tables(spark):
    long = docs(spark, [(1, "in" * 1500)])
    assert pieces.piece_counts(long).filter("round_trip").count() == 1
    none = long.filter("false")
    assert pieces.piece_counts(none).count() == 0
    folder = shared_folder(spark, "tokens")
    token_files.write_tokens(none, folder)
    assert token_files.token_digests(token_files.read_tokens(spark, folder)).count() == 0


def test_piece_query_round_trips(spark):
    assert pieces.op3_pieces(spark, SF).filter(~F.col("round_trip")).count() == 0
