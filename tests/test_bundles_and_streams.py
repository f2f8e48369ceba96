import gzip
import json

from pyspark.sql import functions as F

from folioforge.operators import enrich as E
from folioforge.sources import bundles as B
from folioforge.streaming import watch as W


def test_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a", json.dumps({"header": {"title": "é"}, "blocks": [{"text": "x", "summary": "s"}], "enrichment_meta": None}))], "name string, json string")
    B.write_bundles(rows, str(tmp_path))
    assert gzip.open(tmp_path / "a.bundle").read().startswith(b"{")
    (tmp_path / "bad.bundle").write_bytes(b"no gzip")
    with gzip.open(tmp_path / "worse.bundle", "wb") as f:
        f.write(b"no json")
    got = {r["path"].rsplit("/", 1)[1]: r for r in B.read_bundles(spark, str(tmp_path)).collect()}
    assert got["a.bundle"]["header"]["title"] == "é" and got["a.bundle"]["blocks"][0]["summary"] == "s" and got["a.bundle"]["error"] is None
    assert got["bad.bundle"]["error"] and got["worse.bundle"]["error"]


def test_pdf_scan(spark, tmp_path):
    for name in ("a.pdf", "b.PDF", "c.txt"):
        (tmp_path / name).write_bytes(b"x")
    assert B.scan_pdfs(spark, str(tmp_path)).count() == 1
    assert B.scan_pdfs(spark, str(tmp_path / "b.PDF")).count() == 1


def test_images(spark):
    df = spark.createDataFrame([(bytearray(b"x" * 100), "a/B.JPG", 1000, 501)], "c binary, p string, w int, h int")
    r = df.select(B.encode_image(F.col("c")).alias("e"), B.mime_of(F.col("p")).alias("m"), B.image_format(F.col("w"), F.col("h")).alias("f")).first()
    assert "\n" not in r["e"] and r["m"] == r["f"] == "image/jpeg"
    refs = spark.createDataFrame([("d", 0, "img/a.png"), ("d", 1, "zz"), ("e", 0, "x")], "doc_id string, pos int, ref string")
    images = spark.createDataFrame([("d", 0, "page_a.png"), ("d", 1, "b.png")], "doc_id string, image_pos int, name string")
    got = {(r["doc_id"], r["pos"]): r["image"] for r in B.join_images(refs, images).collect()}
    assert got == {("d", 0): "page_a.png", ("d", 1): None, ("e", 0): None}


def test_failover(spark):
    a = spark.createDataFrame([("x", "t", None), ("y", None, "broken")], "doc_id string, text string, error string")
    b = spark.createDataFrame([("x", "u", None), ("y", "v", None)], "doc_id string, text string, error string")
    assert sorted((r["doc_id"], r["text"]) for r in B.failover(a, b).collect()) == [("x", "t"), ("y", "v")]


def test_stream_keeps_first(spark, tmp_path):
    out = str(tmp_path / "out")

    def run():
        stream = spark.readStream.schema("id long, h string").parquet(str(tmp_path / "in"))
        W.ingest(stream, seen_path=f"{out}/s", new_path=f"{out}/n", duplicate_path=f"{out}/d", checkpoint=f"{out}/c", key="h", order=["id"]).awaitTermination()

    spark.createDataFrame([(2, "a"), (1, "a"), (3, "b")], "id long, h string").write.parquet(str(tmp_path / "in"))
    run()
    spark.createDataFrame([(4, "a"), (5, "c")], "id long, h string").write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert sorted(r["id"] for r in spark.read.parquet(f"{out}/n").collect()) == [1, 3, 5]
    assert sorted(r["id"] for r in spark.read.parquet(f"{out}/d").collect()) == [2, 4]


def test_watch_files(spark, tmp_path):
    (tmp_path / "in" / "errors").mkdir(parents=True)
    for name, data in (("a.pdf", b"1"), ("b.PDF", b"1"), ("empty.pdf", b""), ("errors/c.pdf", b"2"), ("n.txt", b"3")):
        (tmp_path / "in" / name).write_bytes(data)
    q = W.first_seen(W.watch_files(spark, str(tmp_path / "in")).select("path", "pdf_hash")).writeStream.format("memory").queryName("files").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("files").count() == 1


def test_keywords():
    assert E.keywords("Deep water waves and shallow water waves move. Waves!").split("; ")[0] in ("deep water waves", "shallow water waves move")
    assert E.keywords("") == E.keywords("the of and") == ""


def test_upserts(spark):
    b = spark.createDataFrame([(1, "text", "w " * 40, None), (2, "section_header", "w " * 40, {"rake": "old"}), (3, "text", None, {"rake": None}), (4, "text", "word " * 30, {"rake": "old", "llm:x": "y"})], "block_id long, type string, text string, summaries map<string,string>")
    got = {r["block_id"]: r["summaries"] for r in E.add_keywords(b).collect()}
    assert got[2] == {"rake": "old"} and got[3] == {"rake": None} and got[4]["llm:x"] == "y" and got[4]["rake"] != "old" and "rake" in got[1]


def test_rolling(spark):
    rows = [("p", i, i, "text", f"sentence number {i} is long enough to be summarised by the model here.", "T") for i in range(3)]
    b = spark.createDataFrame(rows, "paper_id string, pos int, block_id long, type string, text string, title string")
    prompts = E.rolling_summaries(b, model=lambda p: str(p.count("Previous:")))
    assert [r["summary"] for r in prompts.orderBy("block_id").collect()] == ["0", "1", "1"]


def test_deliver_and_settle(spark, tmp_path):
    from pyspark.sql import functions as F

    from folioforge.streaming import watch as W

    rows = [("in/a.pdf", "ok", None, False, None), ("in/b.pdf", "failed", "no metadata", False, "line 1"), ("in/c.pdf", "ok", None, True, None)]
    batch = spark.createDataFrame(rows, "path string, status string, reason string, seen boolean, trace string").withColumn("at", F.lit("2024-01-02 03:04:05").cast("timestamp"))
    for _ in range(2):  # a batch that is run again replaces itself
        W.deliver(batch, 0, str(tmp_path))
    paths = lambda name: [r["path"] for r in spark.read.parquet(f"{tmp_path}/{name}").collect()]
    assert (paths("completed"), paths("errors"), paths("errors-duplicates"), paths("error-records")) == (["in/a.pdf"], ["in/b.pdf"], ["in/c.pdf"], ["in/b.error.txt"])
    body = spark.read.parquet(f"{tmp_path}/error-records").first()["body"]
    assert body == "PDF: b.pdf\nTime: 2024-01-02T03:04:05\nError: no metadata\n\nTraceback:\nline 1"

    files = spark.sql("select * from values ('x', timestamp'2024-01-01 00:00:00', 5L), ('y', timestamp'2024-01-01 00:00:09', 5L), ('z', timestamp'2024-01-01 00:00:00', 0L) t(path, modificationTime, length)")
    waiting = spark.sql("select * from values ('y', timestamp'2024-01-01 00:00:01', 2L) t(path, modificationTime, length)")
    now = F.lit("2024-01-01 00:00:10").cast("timestamp")
    done, rest = W.settle(files, waiting, now)
    assert [r["path"] for r in done.collect()] == ["x"] and sorted(r["path"] for r in rest.collect()) == ["y", "z"]
    done, rest = W.settle(files.limit(0), rest, F.lit("2024-01-01 00:01:00").cast("timestamp"))
    assert [(r["path"], r["length"]) for r in done.collect()] == [("y", 5)] and [r["path"] for r in rest.collect()] == ["z"]


def test_migration_counts(spark):
    from folioforge.operators import enrich as E

    text = "The slow river carries sand and stones across the wide valley in spring."
    blocks = spark.createDataFrame([("p", 1, "text", text, None, "old"), ("p", 2, "text", "short", {"rake": "x"}, None), ("q", 3, "title", text, {}, None)], "paper_id string, block_id long, type string, text string, summaries map<string,string>, summary string")
    after = E.add_keywords(E.migrate_summaries(blocks).drop("migrated"))
    got = {r["paper_id"]: (r["raked_before"], r["raked_after"]) for r in E.migration_counts(blocks, after).collect()}
    assert got == {"p": (1, 2), "q": (0, 0)}
