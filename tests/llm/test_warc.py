import gzip
import hashlib

from clickloom.llm import warc

PAGES = [(1, "http://a/x", "<p>" + "same " * 40), (2, "http://a/y", "<p>" + "same " * 40), (3, None, "short"), (4, "u\r\nv", "short"),
         (5, "http://ü", None), (6, "http://a", "é" * 60), (7, "http://b", "x" * 300_000), (2, "http://a/y", "<p>" + "same " * 40),
         (None, "http://n", "<p>" + "same " * 40)]


def archive(spark, tmp_path, rows=PAGES, name="w"):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = str(tmp_path / name)
    warc.write_archive(df, path)
    return path


def test_round_trip_and_revisits(spark, tmp_path):
    rows = warc.read_archive(spark, archive(spark, tmp_path)).collect()
    assert len(rows) == len(PAGES)
    body = {i: (h or "").encode() for i, _, h in PAGES}
    for r in rows:
        want = body[r["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(want), hashlib.sha256(want).hexdigest())
        if r["page_id"] in (2, None):
            assert (r["record_type"], r["refers_to"], r["payload"]) == ("revisit", 1, None)
        else:
            assert (r["record_type"], r["refers_to"], bytes(r["payload"])) == ("response", None, want)


def test_predicates_are_taken_over(spark, tmp_path):
    path = archive(spark, tmp_path)
    read = warc.read_archive(spark, path, "record_type string, page_id long, target_uri string")
    found = read.where("record_type = 'revisit' and page_id in (2, 9)")
    assert [r["target_uri"] for r in found.collect()] == ["http://a/y"] * 2
    assert "Filter" not in found._jdf.queryExecution().executedPlan().toString().split("BatchScan")[0].replace("Filters", "")
    assert read.where("target_uri is null").count() == 1
    assert read.where("not (page_id = 1)").count() == len(PAGES) - 2  # a missing id is neither
    assert read.where("target_uri like 'http://a%'").count() == 4


def test_unwanted_payloads_are_not_inflated(spark, tmp_path, monkeypatch):
    path = archive(spark, tmp_path)
    reader = warc.WarcReader(warc.StructType.fromDDL("page_id long") if hasattr(warc.StructType, "fromDDL")
                             else spark.sql("select 1L as page_id").schema, {"path": path})
    seen = []
    real = warc._gzip_record

    def watched(*args):
        row, block, start = real(*args)
        seen.append(len(block or b""))
        return row, block, start

    monkeypatch.setattr(warc, "_gzip_record", watched)
    n = sum(b.num_rows for part in reader.partitions() for b in reader.read(part))
    assert n == len(PAGES) and max(seen) <= 512


def test_members_are_plain_gzip_and_other_archives_are_read(spark, tmp_path):
    path = archive(spark, tmp_path)
    (tmp_path / "other").mkdir()
    for i, f in enumerate(sorted(p for p in (tmp_path / "w").iterdir() if p.name.endswith(".warc.gz"))):
        data = gzip.decompress(f.read_bytes())
        assert data.startswith(b"WARC/1.1\r\nWARC-Type: ")
        if i % 2:
            (tmp_path / "other" / f"{i}.warc").write_bytes(data)  # without compression
        else:  # members without a stated length
            parts = [b"WARC/1.1" + p for p in data.split(b"WARC/1.1")[1:]]
            (tmp_path / "other" / f"{i}.warc.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    key = lambda r: (r["page_id"] or 0, r["payload_digest"], bytes(r["payload"] or b""))
    assert sorted(map(key, warc.read_archive(spark, str(tmp_path / "other")).collect())) == sorted(
        map(key, warc.read_archive(spark, path).collect()))


def test_files_of_lost_attempts_are_ignored_and_empty_table(spark, tmp_path):
    path = archive(spark, tmp_path)
    (tmp_path / "w" / "part-00099-lost.warc.gz").write_bytes(b"half a record")
    assert warc.read_archive(spark, path).count() == len(PAGES)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archive(empty, str(tmp_path / "none"))
    assert warc.read_archive(spark, str(tmp_path / "none")).count() == 0


def test_several_files_and_partitions(spark, tmp_path):
    df = spark.range(60).selectExpr("id as page_id", "cast(id as string) as url", "repeat(cast(id as string), 500) as html")
    path = str(tmp_path / "many")
    warc.register(spark)
    warc.records(df).write.format("warc").option("path", path).option("maxBytes", 300).mode("append").save()
    read = spark.read.format("warc").option("partitionBytes", 2000).load(path)
    assert read.rdd.getNumPartitions() > 3 and read.count() == 60


def test_a_second_write_keeps_the_records_of_the_first(tmp_path):
    (tmp_path / "lost.warc.gz").write_bytes(b"half a record")
    for i in range(2):
        writer = warc.WarcWriter({"path": str(tmp_path)})
        batch = warc.pa.RecordBatch.from_pylist([{"record_type": "response", "page_id": i, "payload": b"x"}])
        writer.commit([writer.write(iter([batch])), None])
    reader = warc.WarcReader(warc.StructType().add("page_id", "long"), {"path": str(tmp_path)})
    read = [b.to_pylist() for part in reader.partitions() for b in reader.read(part)]
    assert sorted(r["page_id"] for rows in read for r in rows) == [0, 1]
