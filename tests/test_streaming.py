from tessitura.streaming.incremental import import_stream

SCHEMA = "path string, sha256 string"


def test_import_by_unseen_hash(spark, tmp_path):
    inbox, register, state = (str(tmp_path / n) for n in ("in", "reg", "chk"))
    put = lambda rows: spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
    spark.createDataFrame([("old", "h0")], SCHEMA).write.parquet(register)
    put([("a", "h1"), ("b", "h1"), ("c", "h0")])
    stream = spark.readStream.schema(SCHEMA).parquet(inbox)
    import_stream(stream, register, state).awaitTermination()
    put([("d", "h2"), ("e", "h1")])
    import_stream(stream, register, state).awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(register).collect()) == [("a", "h1"), ("d", "h2"), ("old", "h0")]
