"""Exact dedup, near-dedup and sharding against brute force, with awkward rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from helpers import SF, docs, odd_rows, plain, with_extra_columns
from pyspark.sql import functions as F

from tessitura.llm import exact, sharding, simhash
from tessitura.llm.common import components, numbered


def low(text):
    return (text or "").encode().lower()


def test_numbered_splits_ties_and_sums(spark):
    rows = spark.range(500).select((F.col("id") % 2).alias("k"), (F.col("id") % 7).alias("w"))
    found = numbered(rows, ["k"], total="w").orderBy("number", "k").collect()
    assert numbered(rows, ["k"]).agg(F.min("number"), F.max("number"), F.countDistinct("number")).first()[:] == (0, 499, 500)
    before = {0: 0, 1: sum(r["w"] for r in found if r["k"] == 0)}
    assert min(r["number"] for r in found if r["k"] == 1) == before[1]


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(500, k) for k in range(501, 700)]
    found = dict(plain(components(spark.createDataFrame([*chain, *star, (3, 3), (900, 901)], "a long, b long"))))
    assert {found[k] for k in range(100, 161)} == {100} and {found[k] for k in range(500, 700)} == {500} and found[901] == 900 and 3 not in found
    assert plain(components(spark.createDataFrame([], "a long, b long"))) == []


@pytest.mark.parametrize("clash", [False, True])
def test_exact_groups(spark, clash):
    rows = odd_rows()
    table = docs(spark, rows)
    found = plain(exact.exact_groups(*exact.split_by_age(with_extra_columns(table) if clash else table)).drop("slot"))
    groups = defaultdict(list)
    for i, t in rows:
        groups[low(t)].append(i)
    want, kept = [], Counter()
    for i, t in rows:
        ids = groups[low(t)]
        best = max((x for x in ids if x is not None), default=None)
        want.append((i, best, len(ids), hashlib.sha256(low(t)).hexdigest()))
    assert sorted((r[0], r[1], r[2], r[4]) for r in found if r[0] is not None) == sorted(w for w in want if w[0] is not None)
    for r in found:
        kept[r[4]] += r[3]
        assert not r[3] or r[0] == r[1]
    assert set(kept.values()) == {1}


def test_index_is_minimal_and_perfect(spark):
    rows = spark.range(5000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"), F.col("id").alias("winner"), F.lit(1).cast("long").alias("n"))
    index = exact.build_index(rows)
    slots = sorted(r["slot"] for r in index.slots.collect())
    assert slots == list(range(5000)) and index.n_parts == 5
    others = spark.range(4000, 6000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"), F.col("id"))
    met = index.lookup(others).collect()
    assert sorted(r["id"] for r in met) == list(range(4000, 5000)) and all(r["id"] == r["old_winner"] for r in met)


def test_without_copies_keeps_one_row_of_each(spark):
    kept = exact.without_copies(docs(spark, odd_rows())).collect()
    assert Counter(low(r["text"]) for r in kept) == Counter({low(t) for _, t in odd_rows()})
    assert kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}


def brute_fingerprint(text, width=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", low(text))
    shingles = [b" ".join(words[k : k + width]) for k in range(len(words) - width + 1)] if len(words) >= width else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(values, radius):
    root = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= radius:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


@pytest.mark.parametrize("clash", [False, True])
def test_near_groups(spark, clash):
    rows = odd_rows() + [(20, " ".join(f"w{k}" for k in range(200))), (21, " ".join(f"w{k}" for k in range(199)))]
    table = docs(spark, rows)
    found = plain(simhash.near_groups(with_extra_columns(table) if clash else table).select("doc_id", "fingerprint", "component_id"))
    prints = [brute_fingerprint(t) for _, t in rows]
    root = brute_roots(prints, 4)
    names = {r: min((rows[k][0] for k in range(len(rows)) if root[k] == r and rows[k][0] is not None), default=None) for r in set(root)}
    assert found == sorted(((i, f"{p:016x}", names[r]) for (i, _), p, r in zip(rows, prints, root)), key=str)
    kept = simhash.one_per_group(table)
    assert kept.count() == len(set(root)) and set(kept.columns) == set(table.columns)


@pytest.mark.parametrize("shard_rows", [64, 100_000])
def test_hamming_links_are_exact_for_any_tree(spark, monkeypatch, shard_rows):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = [np.uint64(x) ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False))) for x in base for _ in range(3)]
    # One dense group: every value within a few bits of one center.
    dense = [base[0] ^ np.uint64(1 << k | 1 << j) for k in range(30) for j in range(k)]
    values = np.unique(np.array([*base, *near, *dense], dtype=np.uint64))
    monkeypatch.setattr(simhash, "SHARD_ROWS", shard_rows)
    points = spark.createDataFrame([(int(v.view(np.int64)),) for v in values], "fp long")
    links = simhash.hamming_links(points).collect()
    assert len(links) <= 3 * 8 * len(values)
    forest = simhash._Forest(len(values))
    place = {int(v.view(np.int64)): k for k, v in enumerate(values)}
    for r in links:
        assert bin((r["a"] ^ r["b"]) & (1 << 64) - 1).count("1") >= 1
        forest.join(np.array([place[r["a"]], place[r["b"]]]))
    want = simhash._Forest(len(values))
    for k in range(len(values)):
        want.join(np.flatnonzero(np.bitwise_count(values ^ values[k]) <= 4))
    everyone = np.arange(len(values))
    assert (forest.roots(everyone) == want.roots(everyone)).all()


@pytest.mark.parametrize("clash", [False, True])
def test_shards_are_even_and_groups_stay_together(spark, clash):
    rows = odd_rows() + [(100 + k, f"text {k // 2}") for k in range(200)] + [(400 + k, "one hot text") for k in range(120)]
    table = docs(spark, rows)
    found = sharding.shard_rows(with_extra_columns(table) if clash else table).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in found) == sorted((i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(s) for s in slots.values()]
    assert set(slots) == set(range(16)) and max(sizes) - min(sizes) <= 1 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    where = defaultdict(set)
    for r in found:
        where[(r["size"], r["text_crc32"])].add(r["shard"])
    split = [len(s) for s in where.values() if len(s) > 1]
    assert len(split) <= 16 and max(split) <= 16


def test_hot_group_fills_few_shards_and_pairs_stay_whole(spark):
    rows = [(k, "one hot text") for k in range(4000)] + [(5000 + k, "another large text") for k in range(900)]
    rows += [(10_000 + k, f"pair {k // 2}") for k in range(4000)] + [(20_000 + k, f"single {k}") for k in range(3100)]
    found = sharding.shard_rows(docs(spark, rows)).collect()
    where, texts = defaultdict(set), dict(rows)
    for r in found:
        where[texts[r["doc_id"]]].add(r["shard"])
    assert len(found) == len(rows) and max(Counter(r["shard"] for r in found).values()) == len(rows) // 16
    assert len(where["one hot text"]) <= -(-4000 // (len(rows) // 16)) + 1 and len(where["another large text"]) <= 3
    assert sum(len(where[f"pair {k}"]) > 1 for k in range(2000)) <= 2 * 16


def test_empty_tables(spark):
    none = docs(spark, [(1, "x")]).filter("false")
    assert exact.exact_groups(*exact.split_by_age(none)).count() == 0 and exact.without_copies(none).count() == 0
    assert simhash.near_groups(none).count() == 0 and sharding.shard_rows(none).count() == 0
    assert simhash.one_per_group(none).count() == 0


def test_exact_query_columns(spark):
    assert exact.op8_exact_dedup(spark, SF).columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
