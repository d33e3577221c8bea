"""Readers, writers, jobs and streaming on small files."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from lexmill.functions.decoding import declared_charset, decode_best_effort
from lexmill.operators.extraction import extraction_report, observe_extraction, pages_to_documents, with_extracted_text
from lexmill.plans import jobs
from lexmill.sources import crawl, sinks
from lexmill.sources import text as tx
from lexmill.sources.warc import read_warc, write_warc
from lexmill.streaming.incremental import keep_new_pages, newest_versions, process_new_archives, process_new_pages

BODY = (
    "<html><body><p>Walking along the river we saw many different birds and plants today. Nobody had brought "
    "any food, yet hunger hardly mattered while clouds moved slowly over distant hills. Later, rain fell.</p></body></html>"
)


def record(kind, url, block):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {url}\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def response(url, body, content_type="text/html; charset=UTF-8", extra=""):
    head = f"HTTP/1.1 200 OK\r\nContent-Type: {content_type}\r\n{extra}\r\n"
    return record("response", url, head.encode() + body)


@pytest.fixture()
def archives(tmp_path):
    body = BODY.encode()
    chunked = b"%x\r\n%s\r\n0\r\n\r\n" % (len(body), body)
    records = [
        record("warcinfo", "", b"software: x"),
        record("request", "http://a/1", b"GET / HTTP/1.1\r\n\r\n"),
        response("http://a/1", body, "Text/HTML; charset=UTF-8"),
        record("response", "dns:a", b"20200101 no http headers"),
        response("http://a/2", gzip.compress(body), extra="Content-Encoding: gzip\r\n"),
        response("http://a/3", chunked, extra="Transfer-Encoding: chunked\r\n"),
        response("http://a/4", b"", "image/png"),
        record("metadata", "http://a/1", b"x: y"),
    ]
    (tmp_path / "one.warc").write_bytes(b"".join(records))
    (tmp_path / "two.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "notes.txt").write_text("not an archive")
    return str(tmp_path)


def test_warc(spark, archives):
    rows = read_warc(spark, archives).orderBy("warc_file", "record_no").collect()
    for name in ("one.warc", "two.warc.gz"):
        mine = [r for r in rows if r["warc_file"].endswith(name)]
        assert [(r["record_no"], r["url"]) for r in mine] == [
            (3, "http://a/1"), (5, "http://a/2"), (6, "http://a/3"), (7, "http://a/4")]
        assert {bytes(r["content"]) for r in mine[:3]} == {BODY.encode()}
        assert mine[0]["content_type"] == "text/html; charset=utf-8"
    assert read_warc(spark, archives, pattern="two*", max_records=4).count() == 1
    with pytest.raises(Exception, match="not a .warc"):
        read_warc(spark, archives + "/notes.txt").count()


def _warc_rows(df):
    columns = ["warc_file", "record_no", "url", "content_type", "content", "error"]
    return sorted((tuple(bytes(r[c]) if c == "content" and r[c] is not None else r[c] for c in columns) for r in df.collect()), key=str)


def _many_records(n=60):
    import random

    r, out = random.Random(6), []
    for i in range(n):
        # Bytes that look like the start of a record or member inside of others.
        trap = b"\nWARC/1.0\r\nContent-Length: 5\r\n\r\nabcde" if i % 9 == 4 else gzip.compress(b"WARC/1.0\r\n\r\n") if i % 9 == 5 else b""
        body = trap + r.randbytes(r.randrange(0, 900))
        out.append(response(f"http://a/{i}", body) if i % 5 else record("request", f"http://a/{i}", body))
    return out


def test_large_archives_are_read_in_ranges(spark, tmp_path):
    records = _many_records()
    (tmp_path / "plain.warc").write_bytes(b"".join(records))
    (tmp_path / "members.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "pairs.warc.gz").write_bytes(b"".join(gzip.compress(a + b) + b"\0" * 3 for a, b in zip(records[::2], records[1::2])))
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(b"".join(records)))
    # A record that goes on in the next members.
    halves = [x for r in records for x in (r[:40], r[40:])]
    (tmp_path / "halves.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in halves))
    (tmp_path / "none.warc").write_bytes(b"")
    whole = _warc_rows(read_warc(spark, str(tmp_path), errors=True))
    assert len(whole) == 5 * 48
    for size in (500, 3000, 20_000):
        parts = read_warc(spark, str(tmp_path), errors=True, split_bytes=size)
        assert _warc_rows(parts) == whole
    used = parts.select("warc_file", F.spark_partition_id().alias("p")).distinct().groupBy("warc_file").count().collect()
    assert {os.path.basename(r["warc_file"]): r["count"] for r in used}["members.warc.gz"] > 1


def test_damaged_archives(spark, tmp_path):
    records = _many_records(20)
    zipped = [gzip.compress(r) for r in records]
    broken = bytearray(zipped[7])
    broken[len(broken) // 2:] = b"\xff" * (len(broken) - len(broken) // 2)
    (tmp_path / "a.warc.gz").write_bytes(b"".join(zipped[:7]) + bytes(broken) + b"".join(zipped[8:]))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(zipped)[:-20])
    (tmp_path / "c.warc").write_bytes(b"".join(records)[:-40])
    whole = _warc_rows(read_warc(spark, str(tmp_path), errors=True))
    wrong = {os.path.basename(r[0]): r[5] for r in whole if r[5] is not None}
    assert wrong == {"a.warc.gz": "archive is damaged: error", "b.warc.gz": "archive is damaged: EOFError", "c.warc": "record is cut off"}
    good = {os.path.basename(f): {r[2] for r in whole if r[0] == f and r[5] is None} for f in {r[0] for r in whole}}
    responses = {f"http://a/{i}" for i in range(20) if i % 5}
    assert good == {"a.warc.gz": responses - {"http://a/7"}, "b.warc.gz": responses - {"http://a/19"}, "c.warc": responses - {"http://a/19"}}
    assert _warc_rows(read_warc(spark, str(tmp_path), errors=True, split_bytes=700)) == whole
    large = spark.read.format("warc").option("maxRecordBytes", "300").load(str(tmp_path / "c.warc"))
    assert 0 < large.where("error like '%over the limit'").count() < 16


def test_outputs_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "out" / "rows")
    df = spark.range(20).selectExpr("id", "CAST(id AS string) AS name")
    for _ in range(2):
        sinks.replace_output(spark, path, df.write.parquet)
        assert sorted(os.listdir(tmp_path / "out")) == ["rows"] and spark.read.parquet(path).count() == 20
    broken = df.selectExpr("IF(id = 17, raise_error('no'), id) AS id")
    with pytest.raises(Exception, match="no"):
        sinks.replace_output(spark, path, broken.write.parquet)
    assert sorted(os.listdir(tmp_path / "out")) == ["rows"] and spark.read.parquet(path).count() == 20
    # An output may be read while it is replaced.
    again = spark.read.parquet(path)
    sinks.replace_output(spark, path, again.where("id < 5").write.parquet)
    assert spark.read.parquet(path).count() == 5


def test_archives_are_written_and_committed(spark, tmp_path):
    path = str(tmp_path / "made")
    rows = [("http://a/1", b"<p>one</p>"), ("http://a/2", b""), (None, b"x" * 2000), ("http://a/3", None)]
    df = spark.createDataFrame(rows, "url string, content binary")
    for n in (1, 2):
        write_warc(df.repartition(n), path)
        back = {r["url"]: bytes(r["content"]) for r in read_warc(spark, path).collect()}
        assert back == {"http://a/1": b"<p>one</p>", "http://a/2": b"", "": b"x" * 2000}
    write_warc(df.limit(1), path, mode="append")
    assert read_warc(spark, path).count() == 4
    # What a running job has not committed is not read.
    os.mkdir(f"{path}/_writing-x")
    with open(f"{path}/_writing-x/a.warc.gz", "wb") as f:
        f.write(gzip.compress(response("http://a/9", b"x")))
    assert read_warc(spark, path, recursive=True).count() == 4
    os.remove(f"{path}/_writing-x/a.warc.gz")
    os.rmdir(f"{path}/_writing-x")
    before = sorted(os.listdir(path))
    broken = df.withColumn("content", F.when(F.col("url") == "http://a/2", F.raise_error(F.lit("no"))).otherwise(F.col("content")))
    with pytest.raises(Exception):
        write_warc(broken, path)
    assert sorted(os.listdir(path)) == before
    write_warc(df.limit(0), path)
    assert os.listdir(path) == []


def test_pages_that_come_again(spark, tmp_path):
    src, out, cp = (str(tmp_path / d) for d in ("in", "out", "cp"))
    schema = "url string, content binary"
    runs = [
        [("a", b"1"), ("b", b"1"), (None, b"0"), (None, b"0"), *[("hot", b"1")] * 500],
        [("a", b"1"), ("b", b"2"), ("c", b"1"), ("hot", b"1")],
        [("a", b"2"), ("b", b"1"), ("b", b"1")],
    ]
    seen = {}
    for mode in ("skip", "replace"):
        for n, rows in enumerate(runs):
            write_warc(spark.createDataFrame(rows, schema).coalesce(1), f"{src}/{mode}/{n}")
            process_new_archives(spark, f"{src}/{mode}", f"{out}/{mode}", f"{cp}/{mode}", on_repeat=mode, recursive=True).awaitTermination()
        seen[mode] = sorted((r["url"], bytes(r["content"]), r["version"]) for r in spark.read.parquet(f"{out}/{mode}").collect())
    # Null addresses are written as empty ones, so they are a key.
    first = [("", b"0", 1), ("a", b"1", 1), ("b", b"1", 1), ("c", b"1", 1), ("hot", b"1", 1)]
    assert seen["skip"] == first
    assert seen["replace"] == sorted([*first, ("a", b"2", 2), ("b", b"2", 2), ("b", b"1", 3)])
    newest = newest_versions(spark.read.parquet(f"{out}/replace"))
    assert {r["url"]: bytes(r["content"]) for r in newest.collect()} == {"": b"0", "a": b"2", "b": b"1", "c": b"1", "hot": b"1"}
    nulls = spark.createDataFrame([(None, 1), (None, 2), ("x", 3), ("x", 4)], "url string, version long")
    assert newest_versions(nulls).count() == 3
    with pytest.raises(ValueError):
        keep_new_pages(nulls, on_repeat="other")


def test_stream_keeps_to_its_file_limit(spark, tmp_path):
    from lexmill.sources.warc import WarcStreamReader

    df = spark.createDataFrame([("a", b"1")], "url string, content binary")
    for n in range(5):
        write_warc(df, str(tmp_path / "in"), mode="append")
    options = {"path": str(tmp_path / "in"), "maxfilespertrigger": "2", "positionpath": str(tmp_path / "position.json")}
    reader, at, sizes = WarcStreamReader(options), None, []
    at = reader.initialOffset()
    for _ in range(2):
        end = reader.latestOffset()
        sizes.append(len(reader.partitions(at, end)))
        reader.commit(end)
        at = end
    again = WarcStreamReader(options)
    for _ in range(2):
        end = again.latestOffset()
        sizes.append(len(again.partitions(at, end)))
        at = end
    assert sizes == [2, 2, 1, 0]


def test_texts_and_labels_of_several_files(spark, tmp_path):
    for name, parts in (("t", ["a\nb\n\n", "c\n", "d\ne\n"]), ("l", ["0\n1\n2\n3\n", "", "4\n5\n6\n"])):
        (tmp_path / name).mkdir()
        for i, part in enumerate(parts):
            (tmp_path / name / f"{i}.txt").write_text(part)
    rows = tx.read_texts_with_label_file(spark, str(tmp_path / "t"), str(tmp_path / "l")).orderBy("line_no").collect()
    assert [(r["text"], r["label"]) for r in rows] == [*[(t, str(i)) for i, t in enumerate("abcde")], (None, "5"), (None, "6")]


def test_archive_job(spark, archives, tmp_path):
    out = str(tmp_path / "out")
    written = jobs.build_dataset_from_archives(spark, archives, out, deep=False)
    assert {r["split"]: r["n"] for r in written.groupBy("split").agg(F.count("*").alias("n")).collect()} == {"train": 4, "test": 2}
    meta = [json.loads(line) for f in os.listdir(out + "/metadata") if f.endswith(".json") for line in open(f"{out}/metadata/{f}")]
    assert (meta[0]["total"], meta[0]["train"], meta[0]["test"], meta[0]["seed"]) == (6, 4, 2, 42)


def test_document_text_round_trip(spark, tmp_path):
    docs = spark.createDataFrame(
        [("/x/b.warc.gz", 9, "second " * 30), ("/x/b.warc.gz", 4, "first " * 30), ("/x/a.warc", 1, "only " * 30)],
        "warc_file string, record_no long, text string")
    path = str(tmp_path / "docs")
    sinks.write_document_text(docs, path, max_records=7)
    assert sorted(d for d in os.listdir(path) if "=" in d) == ["output=a_sample7", "output=b_sample7"]
    files = [f for f in os.listdir(path + "/output=b_sample7") if f.startswith("part")]
    text = "".join(open(f"{path}/output=b_sample7/{f}").read() for f in sorted(files))
    assert text == "".join(f"# Document {i}\n\n{t}\n\n{'-' * 80}\n\n" for i, t in ((1, "first " * 30), (2, "second " * 30)))
    back = tx.read_delimited_documents(spark, path + "/output=b_sample7")
    assert back.count() == 2


def test_extraction_reasons(spark):
    pad = b" " * 60
    rows = [
        ("u", "text/html", BODY.encode()), ("u", "image/png", BODY.encode()), ("u", "text/html", b"<p>" + b"x" * 46),
        ("u", "text/html", b"<p>" + b"x" * 47), ("u", "text/plain", b"plain text without any tags" + pad),
        ("u", "text/html", b"<p>tiny</p>" + pad), ("u", None, BODY.encode()), ("u", "text/html", None),
    ]
    df = with_extracted_text(spark.createDataFrame(rows, "url string, content_type string, content binary"))
    assert [r["reject_reason"] for r in df.collect()] == [
        None, "media_type", "too_small", None, "not_html", "length", "media_type", "too_small"]
    assert {r["outcome"]: r["n"] for r in extraction_report(df).collect()}["extracted"] == 2
    observed = observe_extraction(df)
    assert observed.count() == 8


def test_decoding(spark):
    russian, chinese, french = "Привет, мир! " * 8, "中文网页内容测试" * 8, "déjà vu à l'été " * 8
    page = "<html><meta charset={cs}><body>{text}</body></html>"
    cases = [
        ("text/html", page.format(cs="utf-8", text=russian).encode(), russian),
        ("text/html; charset=windows-1251", page.format(cs="", text=russian).encode("cp1251"), russian),
        ("text/html", page.format(cs="'gbk'", text=chinese).encode("gbk"), chinese),
        ("text/html; charset=nonsense", page.format(cs="", text=french).encode(), french),
        ("text/html", ("<html>" + "a" * 200).encode() + b"\xff", "a" * 200 + "�"),
    ]
    df = spark.createDataFrame([(i, ct, bytearray(raw)) for i, (ct, raw, _) in enumerate(cases)], "id int, ct string, raw binary")
    got = df.select("id", decode_best_effort("raw", declared_charset("ct", "raw")).alias("t")).orderBy("id").collect()
    for (_, _, expect), row in zip(cases, got):
        assert expect in row["t"]
    # Over 5 % broken bytes: another encoding is taken.
    broken = spark.createDataFrame([(bytearray(b"<html>" + b"\xe9" * 31),)], "raw binary")
    text = broken.select(decode_best_effort("raw", F.lit(None).cast("string")).alias("t")).first()["t"]
    assert "�" not in text


def test_line_readers(spark, tmp_path):
    (tmp_path / "a.txt").write_text("  one \n\n two\nthree\n")
    (tmp_path / "labels.txt").write_text("x\ny\n\nz\n")
    got = tx.read_texts_with_label_file(spark, str(tmp_path / "a.txt"), str(tmp_path / "labels.txt"))
    assert [tuple(r) for r in got.orderBy("line_no").collect()] == [(0, "one", "x"), (1, "two", "y"), (2, "three", "z")]
    (tmp_path / "big.txt").write_text("\n".join(f"line {i}" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        rows = tx.read_lines(spark, str(tmp_path / "big.txt")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r["line_no"], r["text"]) for r in rows) == [(i, f"line {i}") for i in range(20_000)]
    (tmp_path / "tsv.txt").write_text("1\ttext a\nno tab\nspam\ta\tb\n")
    rows = tx.read_labelled_lines(spark, str(tmp_path / "tsv.txt")).orderBy("line_no").collect()
    assert [tuple(r)[1:] for r in rows] == [("1", "text a", False), (None, None, True), ("spam", "a\tb", False)]


def test_delimited_documents(spark, tmp_path):
    ruler = "-" * 80
    (tmp_path / "d.txt").write_text(f"# Document 1\n\n{'a' * 87}\n{ruler}\n{'b' * 100}\n{ruler}\n {'c' * 101} \n")
    docs = {r["text"] for r in tx.read_delimited_documents(spark, str(tmp_path)).collect()}
    assert docs == {"# Document 1\n\n" + "a" * 87, "c" * 101}


def test_labelled_directory(spark, tmp_path):
    (tmp_path / "x_class_3_a.txt").write_text("three")
    (tmp_path / "plain.txt").write_text("plain")
    (tmp_path / "blank.txt").write_text("  \n")
    rows = {r["filename"]: r["label"] for r in tx.read_labelled_directory(spark, str(tmp_path)).collect()}
    assert rows == {"x_class_3_a.txt": 3, "plain.txt": 0}
    nested = tmp_path / "nested"
    for d in ("pos", "neg"):
        (nested / d).mkdir(parents=True)
        (nested / d / "t.txt").write_text(d)
    rows = tx.read_labelled_directory(spark, str(nested)).collect()
    assert len(rows) == 2 and all(r["label"] in (0, 1) for r in rows)
    other = tmp_path / "other"
    (other / "sub").mkdir(parents=True)
    (other / "sub" / "a_class_7_.md").write_text("below")
    (other / "b.json").write_text("{}")
    assert [tuple(r) for r in tx.read_labelled_directory(spark, str(other) + "/").collect()] == [("a_class_7_.md", "below", 7)]
    (other / "c.md").write_text("beside")
    assert [r["filename"] for r in tx.read_labelled_directory(spark, str(other)).collect()] == ["c.md"]
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError):
        tx.read_labelled_directory(spark, str(tmp_path / "empty"))


def test_crawl_snapshots(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps([{"id": "CC-NEW", "name": "n"}, {"id": "CC-OLD", "name": "o"}]))
    (tmp_path / "empty.json").write_text("[]")
    crawls = crawl.read_crawls(spark, str(tmp_path / "c.json"))
    assert crawl.latest_crawl(crawls).first()["id"] == "CC-NEW"
    assert crawl.choose_crawl(crawls, "CC-OLD").first()["id"] == "CC-OLD"
    assert crawl.choose_crawl(crawls, "CC-OLD", force_latest=True).first()["id"] == "CC-NEW"
    assert crawl.latest_crawl(crawl.read_crawls(spark, str(tmp_path / "empty.json"))).first()["id"] == crawl.FALLBACK_CRAWL
    with gzip.open(tmp_path / "warc.paths.gz", "wt") as f:
        f.write("".join(f"seg/{i}.warc.gz\n" for i in range(9)) + "seg/readme\n")
    manifest = crawl.read_manifest(spark, str(tmp_path / "warc.paths.gz"))
    assert manifest.count() == 9
    first = [r["archive"] for r in crawl.sample_archives(manifest, 3).collect()]
    assert len(first) == 3 and first == [r["archive"] for r in crawl.sample_archives(manifest, 3).collect()]


def test_text_folder_job(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    for i in range(10):
        (src / f"{i}.txt").write_text(f"Document number {i} says that the weather is fine. " * (1 if i == 0 else 5))
    (src / "skip.md").write_text("other")
    written = jobs.text_folder_dataset(spark, str(src), out)
    assert written.groupBy("split").count().orderBy("split").collect() == [("test", 2), ("train", 7)]
    assert spark.read.csv(out + "/text_quality_metrics", header=True).count() == 10
    summary = spark.read.json(out + "/summary").first()
    assert summary["total_texts"] == 10


def test_text_folder_job_looks_below_and_opens_files_once(spark, tmp_path, monkeypatch):
    for i in range(10):
        (tmp_path / f"in/doc={i}").mkdir(parents=True)
        (tmp_path / f"in/doc={i}/part.txt").write_text(f"Document number {i} says that the weather is fine. " * (1 if i == 0 else 5))
    whole = jobs.read_text_files

    def emptied(*args, **options):
        """Files that are gone once they have been read."""
        files = whole(*args, **options)
        kept = files.localCheckpoint()
        for i in range(10):
            (tmp_path / f"in/doc={i}/part.txt").unlink()
        return kept

    monkeypatch.setattr(jobs, "read_text_files", emptied)
    written = jobs.text_folder_dataset(spark, str(tmp_path / "in"), str(tmp_path / "out"), recursive=True)
    assert written.groupBy("split").count().orderBy("split").collect() == [("test", 2), ("train", 7)]
    assert written.select("path").distinct().count() == 9


def test_small_files_are_read_many_by_a_task(spark, tmp_path, monkeypatch):
    rows = [(f"doc_id={i}", f"Document number {i} says that the weather is fine. " * 5) for i in range(40)]
    docs = spark.createDataFrame([*rows, ("doc_id=7", None), ("a/b c", "line")], "name string, text string")
    sinks.write_text_files(docs, str(tmp_path / "in"), "name", "text")
    found = {f.name: f.read_text() for f in (tmp_path / "in").rglob("*.txt")}
    assert len(found) == 41 and found["doc_id=3.txt"] == rows[3][1] + "\n" and found["a%2Fb%20c.txt"] == "line\n"
    assert sorted(found["doc_id=7.txt"].split("\n")) == ["", "", rows[7][1]]
    tasks, whole = [], jobs.read_text_files

    def counted(*args, **options):
        files = whole(*args, **options)
        tasks.append(files.rdd.getNumPartitions())
        return files

    monkeypatch.setattr(jobs, "read_text_files", counted)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    try:
        written = jobs.text_folder_dataset(spark, str(tmp_path / "in"), str(tmp_path / "out"), recursive=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tasks[0] <= 6 and written.count() == 40
    sinks.write_text_files(docs.where("name = 'a/b c'"), str(tmp_path / "in"), "name", "text")
    assert len([*(tmp_path / "in").rglob("*.txt")]) == 1


def test_catalogue_and_incremental(spark, tmp_path):
    path = str(tmp_path / "cat")
    names = spark.createDataFrame([("a",), ("b",)], "name string")
    sinks.write_catalogue(names, path)
    sinks.write_catalogue(names.limit(1), path)
    from lexmill.sources.sinks import not_yet_processed

    inputs = spark.createDataFrame([("b",), ("c",)], "name string")
    done = sinks.read_catalogue(spark, path)
    assert [r["name"] for r in not_yet_processed(inputs, done, "name").collect()] == ["c"]
    assert not_yet_processed(inputs, done, "name", force=True).count() == 2


def test_stream_equals_batch(spark, sf, tmp_path):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    src, out, cp = (str(tmp_path / d) for d in ("in", "out", "cp"))
    options = {"content": "html", "content_type": None, "deep": False}

    def run():
        process_new_pages(spark, src, out, cp, pages.schema, **options).awaitTermination()
        return spark.read.parquet(out)

    pages.where("page_id % 2 = 0").write.parquet(src)
    first = run().count()
    assert run().count() == first  # Nothing new, nothing added.
    pages.where("page_id % 2 = 1").write.mode("append").parquet(src)
    batch = jobs.documents_of_pages(pages, **options).select("page_id", "text")
    streamed = run().select("page_id", "text")
    assert sorted(streamed.collect()) == sorted(batch.collect()) and streamed.count() > first


def test_pages_to_documents_topics(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    every = pages_to_documents(pages, content="html", content_type=None).count()
    some = pages_to_documents(pages, content="html", content_type=None, domains=["example.org"]).count()
    assert 0 < some < every
