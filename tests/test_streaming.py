"""Incremental ingestion and scoring."""

from shelfwise.operators import sentiment
from shelfwise.sources.tables import Tables
from shelfwise.streaming import ingest, scoring


def write(spark, folder, rows):
    spark.createDataFrame(rows, "url string, at timestamp, n long").coalesce(1).write.mode("append").parquet(folder)


def test_each_key_once_over_batches_and_restarts(spark, tmp_path):
    source, sink, log = (str(tmp_path / n) for n in ("source", "sink", "log"))
    import datetime as dt

    day = dt.datetime(2024, 1, 1)
    write(spark, source, [("a", day, 1), ("a", day, 0), ("b", day, 2)])

    def run():
        stream = spark.readStream.schema("url string, at timestamp, n long").option("maxFilesPerTrigger", 1).parquet(source)
        ingest.ingest_new(stream, sink, "url", "n", log).awaitTermination()
        return sorted((r.url, r.n) for r in ingest.stored_rows(spark, sink).collect())

    assert run() == [("a", 0), ("b", 2)]
    log = str(tmp_path / "other")
    assert run() == [("a", 0), ("b", 2)]  # a lost checkpoint repeats nothing
    write(spark, source, [("b", day, 3), ("c", day, 4)])
    write(spark, source, [("c", day, 5), ("a", day, 6)])
    assert run() == [("a", 0), ("b", 2), ("c", 4)] or run() == [("a", 0), ("b", 2), ("c", 5)]
    assert [u for u, _ in run()] == ["a", "b", "c"]

    bounded = spark.readStream.schema("url string, at timestamp, n long").parquet(source)
    out = str(tmp_path / "bounded")
    ingest.ingest_within(bounded, out, "url", "at", "1 day", str(tmp_path / "log2")).awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_a_batch_reads_nothing_of_the_sink(spark, tmp_path):
    source, sink, log = (str(tmp_path / n) for n in ("source", "sink", "log"))

    def run():
        stream = spark.readStream.schema("url string, at timestamp, n long").parquet(source)
        ingest.ingest_new(stream, sink, "url", "n", log, name="q").awaitTermination()

    write(spark, source, [("a", None, 2), (None, None, 3), (None, None, 1), ("b", None, None), ("b", None, 1)])
    run()
    first = tmp_path / "sink" / "query=q" / "batch=0"
    assert sorted((r.url or "", r.n) for r in spark.read.parquet(str(first)).collect()) == [("", 1), ("a", 2), ("b", None)]
    for file in first.glob("*.parquet"):
        file.write_bytes(b"no longer a table")  # whoever reads it fails
    write(spark, source, [("a", None, 0), (None, None, 0), ("c", None, 5), ("c", None, 4)])
    run()
    second = spark.read.parquet(str(tmp_path / "sink" / "query=q" / "batch=1")).collect()
    assert [(r.url, r.n) for r in second] == [("c", 4)]


def test_scores_a_stream(spark, tmp_path):
    rows = [(f"máy {w}", i) for i, w in enumerate(["tệ", "thường", "tốt"]) for _ in range(5)]
    model = sentiment.fit_sentiment(spark.createDataFrame(rows, "clean string, label int"), 10)
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, "Máy tốt"), (2, " ")], "id int, Review_Text string").write.parquet(source)
    stream = spark.readStream.schema("id int, Review_Text string").parquet(source)
    scoring.score_stream(stream, model, str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.id, r.label) for r in found] == [(1, 2)]


def test_a_table_streams_as_one_file_or_as_a_folder_of_files(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(6)], "conv_id long, text string")
    rows.repartition(3).write.parquet(str(tmp_path / "many" / "conversations.parquet"))
    (tmp_path / "one").mkdir()
    rows.toPandas().to_parquet(tmp_path / "one" / "conversations.parquet")
    for folder in ("many", "one"):
        stream = Tables(spark, str(tmp_path / folder)).stream("conversations")
        sink, log = (str(tmp_path / folder / n) for n in ("sink", "log"))
        stream.writeStream.format("parquet").option("checkpointLocation", log).trigger(availableNow=True).start(sink).awaitTermination()
        assert sorted(r.text for r in spark.read.parquet(sink).collect()) == [f"t{i}" for i in range(6)]
