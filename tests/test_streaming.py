from lodestack.streaming import log


def test_replayed_batches_change_nothing(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "log")
    rows = spark.createDataFrame([(1, "a", 10), (1, "b", 11)], "snapshot long, topic string, n long")
    rows.coalesce(1).write.parquet(source)

    def run(checkpoint):
        stream = log.read_captures(spark, source, rows.schema)
        log.append_log(stream, target, "snapshot", str(tmp_path / checkpoint)).awaitTermination()
        return sorted((r.snapshot, r.topic, r.n) for r in spark.read.parquet(target).collect())

    first = run("c1")
    assert first == [(1, "a", 10), (1, "b", 11)]
    assert run("c2") == first  # a new checkpoint replays everything
    spark.createDataFrame([(2, "a", 20)], rows.schema).coalesce(1).write.mode("append").parquet(source)
    assert run("c2") == [*first, (2, "a", 20)]
