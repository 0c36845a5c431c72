from locuspark.streaming.dictionary_stream import register_stream


def test_lines_added_to_a_dictionary_arrive_once(engine, spark, tmp_path):
    register_stream(spark)
    for i in (1, 2, 3):
        engine.write_gor(spark.createDataFrame([("chr1", i, f"v{i}")], "chrom string, pos int, val string"), f"{tmp_path}/f{i}.gorz")
    d = tmp_path / "d.gord"
    d.write_text("f1.gorz\ta\nf2.gorz\tb\n")
    stream = spark.readStream.format("gord_stream").load(str(d)).where("pos > 0")
    q = stream.writeStream.format("memory").queryName("added").option("checkpointLocation", f"{tmp_path}/cp").start()
    try:
        q.processAllAvailable()
        d.write_text(d.read_text() + "f3.gorz\tc\n")
        q.processAllAvailable()
        assert sorted((r.pos, r.val, r.Source) for r in spark.table("added").collect()) == [(1, "v1", "a"), (2, "v2", "b"), (3, "v3", "c")]
    finally:
        q.stop()
