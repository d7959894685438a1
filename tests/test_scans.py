"""Ordered scans: the chunked route must equal a plain simulation, ties and nulls included."""

import random

from pyspark.sql import functions as F

from tessitura.operators import intervals as iv
from tessitura.operators import scans as sc


def brute(rows, key, order, value):
    out = {}
    for k in {r[key] for r in rows}:
        part = sorted((r for r in rows if r[key] == k), key=lambda r: tuple((r[o] is not None, r[o]) for o in order))
        vals = [r[value] for r in part]
        for i, r in enumerate(part):
            seen = [v for v in vals[:i] if v is not None]
            upto = [v for v in vals[: i + 1] if v is not None]
            later = [v for v in vals[i:] if v is not None]
            out[r["id"]] = (
                i + 1, sum(upto) if upto else None, sum(seen) if seen else None, max(seen) if seen else None, min(upto) if upto else None,
                vals[i - 1] if i else None, vals[i + 1] if i + 1 < len(vals) else None, upto[-1] if upto else None, later[0] if later else None,
            )
    return out


def data(seed, n=300):
    rng = random.Random(seed)
    # One key holds most rows and one instant holds a third of them.
    return [
        {"id": i, "k": "hot" if rng.random() < 0.7 else f"c{i % 9}", "t": 5 if rng.random() < 0.33 else rng.randrange(40), "v": None if rng.random() < 0.3 else rng.randrange(100)}
        for i in range(n)
    ]


def scanned(spark, rows):
    df = spark.createDataFrame(rows, "id long, k string, t long, v long")
    steps = [
        sc.row_number("n"), sc.running_sum("s", F.col("v")), sc.running_sum("e", F.col("v"), inclusive=False), sc.running_max("m", F.col("v")),
        sc.Scan("lo", "min", F.col("v"), inclusive=True), sc.previous("p", F.col("v")), sc.following("f", F.col("v")),
        sc.last_seen("l", F.col("v")), sc.next_seen("x", F.col("v")),
    ]
    out = sc.scan(df, ["k"], ["t", "id"], steps)
    return {r["id"]: tuple(r[c] for c in ("n", "s", "e", "m", "lo", "p", "f", "l", "x")) for r in out.collect()}


def test_plain_route(spark):
    rows = data(1)
    assert scanned(spark, rows) == brute(rows, "k", ["t", "id"], "v")


def test_chunked_route(spark, tiny_tasks):
    rows = data(2)
    assert scanned(spark, rows) == brute(rows, "k", ["t", "id"], "v")


def test_chunks_are_small(spark, tiny_tasks):
    rows = spark.createDataFrame(data(3), "id long, k string, t long, v long")
    hot = sc.find_hot_keys(rows, ["k"])
    sizes = sc.assign_chunks(rows, ["k"], ["t", "id"], hot).groupBy("k", sc.CHUNK).count()
    assert sizes.agg(F.max("count")).first()[0] <= 28  # a few times the limit of 7, never the whole key
    assert sizes.where("k = 'hot'").count() > 15


def test_global_scan(spark, tiny_tasks):
    df = spark.createDataFrame([(i, (i * 37) % 101) for i in range(90)], "id long, t long")
    got = {r["id"]: r["n"] for r in sc.scan(df, [], ["t", "id"], [sc.row_number("n")]).collect()}
    want = {r[0]: i + 1 for i, r in enumerate(sorted(((i, (i * 37) % 101) for i in range(90)), key=lambda r: (r[1], r[0])))}
    assert got == want


def test_stages_share_a_chunking(spark, tiny_tasks):
    df = spark.createDataFrame([("k", i, (i * 7) % 5) for i in range(60)], "k string, t long, v long")
    out = sc.scan(df, ["k"], ["t"], [sc.running_sum("a", F.col("v"))], None, [sc.running_sum("b", F.col("a"))])
    a, b, want = 0, 0, {}
    for i in range(60):
        a += (i * 7) % 5
        b += a
        want[i] = (a, b)
    assert {r["t"]: (r["a"], r["b"]) for r in out.collect()} == want


# -- interval properties ------------------------------------------------------------


def points(rows, keep):
    return {k: {x for a, b in [(r["start_us"], r["end_us"]) for r in rows if r["k"] == k] for x in range(a, b)} for k in keep}


def spans(rng, n, top=300, longest=25):
    out = []
    for _ in range(n):
        a = rng.randrange(top)
        out.append(("h" if rng.random() < 0.8 else "c", a, a + rng.randrange(longest)))
    return out


def check_algebra(spark, seed):
    rng = random.Random(seed)
    schema = "k string, start_us long, end_us long"
    base, cuts = spark.createDataFrame(spans(rng, 80), schema), spark.createDataFrame(spans(rng, 60), schema)
    b, c, keys = points(base.collect(), "hc"), points(cuts.collect(), "hc"), ["k"]
    whole = iv.union(base, keys).collect()
    assert points(whole, "hc") == b
    ordered = sorted((r["k"], r["start_us"], r["end_us"]) for r in whole)
    assert all(x[0] != y[0] or x[2] < y[1] for x, y in zip(ordered, ordered[1:]))
    rest = iv.subtract(base, cuts, keys)
    assert points(rest.collect(), "hc") == {k: b[k] - c[k] for k in "hc"}
    common = iv.subtract(base, rest, keys)
    assert points(common.collect(), "hc") == {k: b[k] & c[k] for k in "hc"}
    extents = spark.createDataFrame([("h", 400), ("c", 400)], "k string, extent long")
    free = iv.uncovered(base, extents, keys)
    assert points(free.collect(), "hc") == {k: set(range(400)) - b[k] for k in "hc"}
    probes = cuts.where("end_us > start_us")
    cover = iv.union(base, keys)
    for r in iv.overlapping_any(probes, cover, keys).collect():
        assert r["overlaps"] == bool(b[r["k"]] & set(range(r["start_us"], r["end_us"])))
    for r in iv.contained_any(probes, cover, keys).collect():
        assert r["contained"] == (set(range(r["start_us"], r["end_us"])) <= b[r["k"]])


def test_interval_algebra(spark):
    check_algebra(spark, 11)


def test_interval_algebra_hot(spark, tiny_tasks):
    check_algebra(spark, 12)


def test_subtract_tolerance(spark):
    """One-sample slivers at an edge of a cut do not move the edge."""
    schema = "k string, start_us long, end_us long"
    base = spark.createDataFrame([("a", 0, 100)], schema)
    got = lambda *cuts: sorted((r[1], r[2]) for r in iv.subtract(base, spark.createDataFrame([("a", *c) for c in cuts], schema), ["k"], eps=1).collect())
    assert got((-5, 1)) == [(0, 100)]
    assert got((99, 120)) == [(0, 100)]
    assert got((1, 50)) == [(50, 100)]
    assert got((40, 60)) == [(0, 40), (60, 100)]


def test_overlap_join_gives_each_pair_once(spark):
    rng = random.Random(5)
    a, b = spans(rng, 60), spans(rng, 60)
    left = spark.createDataFrame([(i, *x) for i, x in enumerate(a)], "i long, k string, ls long, le long")
    right = spark.createDataFrame([(j, *x) for j, x in enumerate(b)], "j long, k string, rs long, re long")
    on = (F.col("ls") < F.col("re")) & (F.col("le") > F.col("rs"))
    got = sorted((r["i"], r["j"]) for r in iv.overlap_join(left, right, ["k"], 10, on, ("ls", "le"), ("rs", "re")).collect())
    want = sorted((i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[0] == y[0] and x[1] < y[2] and x[2] > y[1])
    assert got == want
