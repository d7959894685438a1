import hashlib
import json
import random
import struct
import wave
import zipfile

import pytest
from pyspark.sql import functions as F

from tessitura.operators import consensus as cs
from tessitura.sources import readers as rd
from tessitura.sources import sinks as sk


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def put(tmp_path, name, text):
    p = tmp_path / name
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(text, encoding="utf-8")
    return str(p)


def test_csv_bom_missing_and_columns(spark, tmp_path):
    p = put(tmp_path, "a.csv", "﻿clip_id,status\nc1,accepted\nc2,\"x,y\"\n")
    assert rows(rd.read_csv(spark, p, ["clip_id", "status", "extra"]), "clip_id", "status", "extra") == [("c1", "accepted", None), ("c2", "x,y", None)]
    assert rd.read_csv(spark, str(tmp_path / "none.csv"), ["a", "b"]).count() == 0


def test_keyed_table_reports_duplicates(spark):
    df = spark.createDataFrame([("s1", "a"), ("s1", "b"), (" ", "s2"), ("", "")], "song_id string, id string")
    good, twice = rd.keyed_table(df, "song_id", "id")
    assert rows(good, "song_id") == [("s1",), ("s1",), ("s2",)]
    assert rows(twice, "song_id") == [("s1",)]


def test_lyrics_tsv_defaults(spark, tmp_path):
    p = put(tmp_path, "l.tsv", "phrase_id\tsurface\treading\tnote_count\n\tあ\ta\t3\nq9\tい\t\t\n")
    assert rows(rd.read_lyrics_tsv(spark, p), "line", "phrase_id", "surface", "reading", "note_count") == [(2, "p001", "あ", "a", 3), (3, "q9", "い", "", 0)]


def test_jsonl_reports_bad_lines(spark, tmp_path):
    p = put(tmp_path, "m.jsonl", '{"id":"a","n":1}\n\n[1]\n{bad\n{"id":"b"}\n')
    good, bad = rd.read_jsonl(spark, p, "id string, n int")
    assert rows(good, "line", "id", "n") == [(1, "a", 1), (5, "b", None)]
    assert rows(bad, "line", "reason") == [(3, "NOT_AN_OBJECT"), (4, "INVALID_JSON")]


def test_line_numbers_survive_splitting(spark, tmp_path, tiny_tasks):
    p = put(tmp_path, "big.txt", "\n".join(f"row {i}" for i in range(1, 401)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        got = rd.numbered_lines(spark, p)
        assert rows(got, "line", "value") == sorted((i, f"row {i}") for i in range(1, 401))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_json_items_and_song_maps(spark, tmp_path):
    a = put(tmp_path, "j/a.json", '[{"name":"x"},{"name":"y"}]')
    put(tmp_path, "j/b.json", '{"items":[{"name":"z"}]}')
    assert rows(rd.read_json_items(spark, str(tmp_path / "j"), "struct<name:string>"), "pos", "item.name") == [(0, "x"), (0, "z"), (1, "y")]
    assert a
    m = put(tmp_path, "m.json", json.dumps({"songs": {"s1": {"status": "READY"}, "s2": {"status": "BLOCKED"}}}))
    assert rows(rd.read_song_maps(spark, m, "struct<status:string>"), "song_id", "report.status") == [("s1", "READY"), ("s2", "BLOCKED")]


def test_list_and_name_text(spark, tmp_path):
    p = put(tmp_path, "t.list", "a.wav|s|JA|x|y\nb.wav|s|JA\nc.wav|s|EN|t\n")
    good, bad = rd.read_list(spark, p, "JA")
    assert rows(good, "audio_path", "text") == [("a.wav", "x|y")]
    assert rows(bad, "line", "reason") == [(2, "FIELD_COUNT"), (3, "LANGUAGE")]
    q = put(tmp_path, "n.txt", "a.wav\tp\tn\tはい\nb.wav\tp\n")
    good, bad = rd.read_name_text(spark, q)
    assert rows(good, "audio_name", "text") == [("a.wav", "はい")] and rows(bad, "line") == [(2,)]


def test_merge_parts_keeps_one_header(spark, tmp_path):
    put(tmp_path, "p/0.tsv", "h1\th2\na\t1\n\n")
    put(tmp_path, "p/1.tsv", "h1\th2\nb\t2\n")
    got = rd.merge_parts(spark, str(tmp_path / "p")).orderBy("part", "line")
    assert [r["value"] for r in got.collect()] == ["h1\th2", "a\t1", "b\t2"]


def test_dictionary_last_wins_and_layers(spark, tmp_path):
    one = put(tmp_path, "1.dict", "# c\nka\tk a\nka\tk aa\nna n a\nbad\n")
    two = put(tmp_path, "2.dict", "na\tm m\nmi m i\n")
    d = rd.read_dictionary(spark, one, 0).unionByName(rd.read_dictionary(spark, two, 1))
    assert rows(cs.layered(d), "key", "value", "layer") == [("ka", "k aa", 0), ("mi", "m i", 1), ("na", "n a", 0)]
    assert rows(rd.phone_inventory(d), "phone") == [("a",), ("aa",), ("i",), ("k",), ("m",), ("n",)]


SRT = "1\r\n00:00:01,000 --> 00:00:02,500\r\n<i>こんにちは</i>\r\nhello\r\n\r\n2\n00:00:03.000 --> 00:00:02.000\nだめ\n\n3\n00:00:04,000 --> 00:00:05,000\nonly latin\n\nx\n00:00:04,000 --> 00:00:05,000\nあ\n"


def test_srt(spark, tmp_path):
    good, bad = rd.read_srt(spark, put(tmp_path, "a.srt", SRT))
    assert rows(good, "id", "text", "translation", "start", "end", "duration") == [(1, "こんにちは", "hello", 1.0, 2.5, 1.5)]
    assert rows(bad, "id") == [(2,)]


GRID = """File type = "ooTextFile"
item []:
    item [1]:
        class = "IntervalTier"
        name = "words"
        intervals: size = 1
        intervals [1]:
            xmin = 0
            xmax = 1.5
            text = "uni"
    item [2]:
        class = "IntervalTier"
        name = "phones"
        intervals: size = 2
        intervals [1]:
            xmin = 0
            xmax = 0.5
            text = ""
        intervals [2]:
            xmin = 0.5
            xmax = 1.5
            text = "a"
"""


def test_textgrid(spark, tmp_path):
    p = put(tmp_path, "a.TextGrid", GRID)
    docs = spark.read.text(p, wholetext=True)
    assert rows(rd.parse_textgrid(docs, "phones"), "start", "end", "text") == [(0.5, 1.5, "a")]
    assert rows(rd.parse_textgrid(docs, "phones", True), "start", "end", "text") == [(0.0, 0.5, ""), (0.5, 1.5, "a")]
    assert rows(rd.parse_textgrid(docs, "words"), "text") == [("uni",)]
    assert rd.missing_tiers(docs, "tones").count() == 1 and rd.missing_tiers(docs, "words").count() == 0


def test_lab_breaks(spark, tmp_path):
    p = put(tmp_path, "a.lab", "0.0 0.5 k\n0.5 0.7 a\n0.9 1.0 SP\n")
    assert rows(rd.lab_breaks(rd.read_lab(spark, p)), "line") == [(3,)]


def wav(path, rate, values, channels=1):
    path.parent.mkdir(parents=True, exist_ok=True)
    with wave.open(str(path), "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(struct.pack(f"<{len(values)}h", *values))


def test_wav_headers_frames_inventory(spark, tmp_path):
    wav(tmp_path / "w/a.wav", 1000, [100, -200] * 15, channels=2)
    (tmp_path / "w/bad.wav").write_bytes(b"nope")
    heads = rd.wav_headers(spark, str(tmp_path / "w"))
    assert rows(heads, F.regexp_extract("path", "[^/]*$", 0), "sample_rate", "channels", "frames", "decodable") == [("a.wav", 1000, 2, 15, True), ("bad.wav", None, None, None, False)]
    (tmp_path / "w/bad.wav").unlink()
    frames = rd.wav_frames(spark, str(tmp_path / "w"))
    assert rows(frames, "channel", "frame", F.size("samples")) == [(0, 0, 10), (0, 1, 5), (1, 0, 10), (1, 1, 5)]
    inv = rd.inventory(spark, str(tmp_path / "w"), [".wav"])
    assert inv.count() == 1 and len(inv.first()["sha256"]) == 64 and not inv.first()["empty"]


def test_archive_and_folder_look_alike(spark, tmp_path):
    put(tmp_path, "d/x/a.txt", "A")
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("x/a.txt", "A")
        z.writestr("../evil.txt", "E")
    folder = rd.archive_members(spark, str(tmp_path / "d"))
    packed = rd.archive_members(spark, str(tmp_path / "z.zip"))
    assert rows(folder, "member", "safe") == [("x/a.txt", True)]
    assert rows(packed, "member", "safe") == [("../evil.txt", False), ("x/a.txt", True)]


def test_job_inputs_by_suffix_order(spark):
    files = spark.createDataFrame([("j1/v.flac",), ("j1/v.wav",), ("j1/l.txt",), ("j2/v.mp3",)], "path string")
    kinds = {"audio": [".wav", ".flac", ".mp3"], "lyrics": [".tsv", ".txt"]}
    got = rd.discover_inputs(files, kinds, F.split_part("path", F.lit("/"), F.lit(1)), F.col("path"))
    assert rows(got, "job", "kind", "path") == [("j1", "audio", "j1/v.wav"), ("j1", "lyrics", "j1/l.txt"), ("j2", "audio", "j2/v.mp3")]


def test_lists_and_checksums(spark, tmp_path):
    df = spark.createDataFrame(
        [("1", "a.wav", "JA", "x", "smoke_train"), ("2", "b.wav", "JA", "y|z", "train"), ("3", "c.wav", "EN", "t", "train"), ("4", "d.wav", "JA", "w", "benchmark")],
        "id string, audio_relpath string, language string, text string, split string",
    )
    good, bad = sk.list_lines(df, "/r", "spk")
    assert rows(good, "list", "line") == [("benchmark", "/r/d.wav|spk|JA|w"), ("smoke_train", "/r/a.wav|spk|JA|x"), ("train", "/r/a.wav|spk|JA|x")]
    assert rows(bad, "id", "reason") == [("2", "TEXT_CONTAINS_PIPE"), ("3", "TEXT_LANGUAGE")]
    sk.write_lists(good, str(tmp_path / "lists"))
    assert sorted(p.name for p in (tmp_path / "lists").glob("list=*")) == ["list=benchmark", "list=smoke_train", "list=train"]
    sums = sk.checksum_lines(spark.createDataFrame([("b", "2"), ("a", "1")], "path string, sha256 string"))
    sk.write_sorted(sums, str(tmp_path / "sums"), "path")
    text = "".join(p.read_text() for p in sorted((tmp_path / "sums").glob("part-*")))
    assert text.split("\n") == ["1  a", "2  b", ""]


def test_csv_and_jsonl_writers(spark, tmp_path):
    df = spark.createDataFrame([("x", 1, "drop")], "b string, a int, z string").coalesce(1)
    sk.write_csv(df, str(tmp_path / "c"), ["a", "b", "missing"])
    assert next((tmp_path / "c").glob("part-*.csv")).read_text() == 'a,b,missing\n1,x,""\n'
    sk.write_jsonl(df, str(tmp_path / "j"))
    assert next((tmp_path / "j").glob("part-*.json")).read_text() == '{"a":1,"b":"x","z":"drop"}\n'


def test_publish_is_write_once(spark, tmp_path):
    df = spark.range(3)
    checks = spark.createDataFrame([("A", 0, True)], "code string, failures long, passed boolean")
    target = str(tmp_path / "v1")
    assert sk.publish({"t": df}, target, checks, dry_run=True)["status"] == "DRY_RUN_PASS"
    assert sk.publish({"t": df}, target, checks)["status"] == "PUBLISHED"
    assert spark.read.parquet(target + "/t").count() == 3
    with pytest.raises(FileExistsError):
        sk.publish({"t": df}, target, checks)
    failed = spark.createDataFrame([("A", 2, False)], "code string, failures long, passed boolean")
    assert sk.publish({"t": df}, str(tmp_path / "v2"), failed) == {"status": "BLOCKED", "failed": ["A"], "target": str(tmp_path / "v2")}


def tree_digest(data, block):
    level = [hashlib.sha256(data[i : i + block]).hexdigest() for i in range(0, max(1, len(data)), block)]
    while len(level) > 1:
        level = [hashlib.sha256("".join(level[i : i + 1024]).encode()).hexdigest() for i in range(0, len(level), 1024)]
    return level[0]


def test_block_inventory_reads_files_of_any_size_by_ranges(spark, tmp_path):
    rng = random.Random(3)
    files = {"empty.bin": 0, "one.bin": 99, "even.bin": 200, "sub/odd.WAV": 4_321, "deep.bin": 150_050}
    (tmp_path / "sub").mkdir()
    for name, size in files.items():
        (tmp_path / name).write_bytes(rng.randbytes(size))
    got = {r["path"].split(f"{tmp_path}/")[1]: r for r in rd.block_inventory(spark, str(tmp_path), block_bytes=100).collect()}
    assert set(got) == set(files)
    for name, size in files.items():
        r = got[name]
        assert (r["bytes"], r["blocks"], r["readable"]) == (size, max(1, -(-size // 100)), True)
        assert r["digest"] == tree_digest((tmp_path / name).read_bytes(), 100), name
    plain = {r["path"].split(f"{tmp_path}/")[1]: r for r in rd.inventory(spark, str(tmp_path)).collect()}
    assert {n: (r["bytes"], r["empty"]) for n, r in plain.items()} == {n: (size, size == 0) for n, size in files.items()}
    assert plain["empty.bin"]["sha256"] == hashlib.sha256(b"").hexdigest()
    # One flipped byte in the middle of the largest file changes its digest alone.
    data = bytearray((tmp_path / "deep.bin").read_bytes())
    data[75_000] ^= 1
    (tmp_path / "deep.bin").write_bytes(data)
    again = {r["path"].split(f"{tmp_path}/")[1]: r["digest"] for r in rd.block_inventory(spark, str(tmp_path), block_bytes=100).collect()}
    assert [n for n in files if again[n] != got[n]["digest"]] == ["deep.bin"]
    assert [r["bytes"] for r in rd.block_inventory(spark, str(tmp_path), suffixes=[".wav"]).collect()] == [4_321]


def test_line_parsers_on_texts_in_columns(spark):
    docs = spark.createDataFrame([("a", "﻿0 1 k\r\n1 2 a\nx 3 b\n\n3 4"), ("b", None)], "id string, body string")
    good, bad = rd.parse_lab(rd.text_lines(docs, "id", "body"))
    assert [(r["file"], r["line"], r["start"], r["end"], r["phone"]) for r in good.orderBy("line").collect()] == [("a", 1, 0.0, 1.0, "k"), ("a", 2, 1.0, 2.0, "a")]
    assert [(r["line"], r["reason"]) for r in bad.orderBy("line").collect()] == [(3, "NOT_A_NUMBER"), (5, "FIELD_COUNT")]


def test_short_lists(spark):
    lines = spark.createDataFrame([("l", i, f"a{i}|s|JA|t") for i in range(3)] + [("m", 1, "a|s|JA|t"), ("n", 1, "bad")], "file string, line long, value string")
    good, _ = rd.parse_list(lines, "JA")
    assert sorted((r["file"], r["rows"]) for r in rd.short_lists(good, lines.select("file").distinct()).collect()) == [("m", 1), ("n", 0)]
