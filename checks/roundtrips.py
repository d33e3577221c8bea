"""Documents through the real writers and readers and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sqltext as s
from checks.jobs import _PAGES as PAGES
from checks.registry import query, table, texts
from lexmill.operators.sampling import ratio_split
from lexmill.operators.scratch import new_folder
from lexmill.operators.vocabulary import build_vocabulary, read_vocabulary, write_vocabulary
from lexmill.plans import jobs
from lexmill.sources import sinks
from lexmill.sources import text as tx
from lexmill.sources.crawl import latest_crawl, read_crawls, read_manifest
from lexmill.sources.warc import read_warc, write_warc


# Cleaned corpus by source, read as whole files: every line of every document comes back.
@query(f"""SELECT source, count(*) AS lines, sum(length(l))::BIGINT AS chars FROM (
 SELECT source, {s.strip('x')} AS l FROM (SELECT source, unnest(string_split(text, chr(10))) AS x FROM documents)) WHERE l <> '' GROUP BY source""")
def clean_corpus_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark)
    docs = table(spark, sf, "documents").select("source", F.col("text").alias("clean_text"))
    sinks.write_clean_corpus(docs, folder, "source")
    files = tx.read_text_files(spark, folder, recursive=True).withColumn("source", F.regexp_extract("path", "source=([^/]+)", 1))
    lines = files.select("source", F.explode(F.split("text", "\n")).alias("x")).select("source", tx.rx.strip("x").alias("l"))
    return lines.where("l <> ''").groupBy("source").agg(F.count("*").alias("lines"), F.sum(F.length("l")).alias("chars"))


# The same files line by line.
@query(f"""SELECT count(*) AS lines, sum(length(l))::BIGINT AS chars FROM (
 SELECT {s.strip('x')} AS l FROM (SELECT unnest(string_split(text, chr(10))) AS x FROM documents)) WHERE l <> ''""")
def line_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark)
    texts(spark, sf).select("text").write.text(folder)
    return tx.read_lines(spark, folder).agg(F.count("*").alias("lines"), F.sum(F.length("text")).alias("chars"))


# Numbered documents with rulers, read back by the rulers.
@query(f"""SELECT source, text FROM (SELECT source, '# Document ' || row_number() OVER (PARTITION BY source ORDER BY doc_id) || chr(10) || chr(10)
 || {s.sub('text', chr(92) + 's+$', '')} AS text FROM documents) WHERE length(text) > 100""")
def document_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark)
    docs = table(spark, sf, "documents").select("source", "doc_id", "text")
    sinks.write_document_text(docs, folder, source="source", order="doc_id")
    back = tx.read_delimited_documents(spark, f"{folder}/output=*")
    return back.select(F.regexp_extract("path", "output=([^/]+)", 1).alias("source"), "text")


# A split dataset on disk: its Parquet part and its readable part.
@query("""WITH sp AS (SELECT text, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) <= floor(count(*) OVER () * 0.8)
  THEN 'train' ELSE 'test' END AS split FROM documents)
SELECT split, count(*) AS n, sum(length(text))::BIGINT AS chars, count(*) AS samples FROM sp GROUP BY split""")
def dataset_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark)
    sinks.write_dataset(ratio_split(texts(spark, sf), "doc_id"), folder, text="text")
    rows = tx.read_dataset(spark, f"{folder}/data").groupBy("split").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
    marks = spark.read.text(f"{folder}/text").where("value = '--- Sample ---'").groupBy("split").agg(F.count("*").alias("samples"))
    return rows.join(marks, "split")


# Lines of label and text; every tenth lacks the tab.
@query(f"""SELECT CASE WHEN doc_id % 10 <> 0 THEN (doc_id % 3)::VARCHAR END AS label,
 CASE WHEN doc_id % 10 <> 0 THEN {s.sub("replace(text, chr(10), ' ')", chr(92) + 's+$', '')} END AS text, doc_id % 10 = 0 AS malformed FROM documents""")
def label_line_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark)
    flat = F.replace("text", F.lit("\n"), F.lit(" "))
    line = F.when(F.col("doc_id") % 10 == 0, flat).otherwise(F.concat((F.col("doc_id") % 3).cast("string"), F.lit("\t"), flat))
    texts(spark, sf).select(line).write.text(folder)
    return tx.read_labelled_lines(spark, folder).select("label", "text", "malformed")


# Texts and labels in two files, matched by line number.
@query("SELECT doc_id % 7 AS label, count(*) AS n, sum(doc_id)::BIGINT AS ids FROM documents GROUP BY ALL")
def side_label_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark)
    ordered = table(spark, sf, "documents").select("doc_id").coalesce(1)
    ordered.select(F.concat(F.lit("text of "), F.col("doc_id").cast("string"))).write.text(f"{folder}/texts")
    ordered.select((F.col("doc_id") % 7).cast("string")).write.text(f"{folder}/labels")
    zipped = tx.read_texts_with_label_file(spark, f"{folder}/texts", f"{folder}/labels")
    return zipped.groupBy(tx.integer_label("label").alias("label")).agg(
        F.count("*").alias("n"), F.sum(F.regexp_extract("text", "[0-9]+", 0).cast("long")).alias("ids"))


# The same with three files of texts and two of labels, cut at different places, the last 20 labels missing.
@query("""SELECT doc_id, CASE WHEN doc_id < (SELECT max(doc_id) - 19 FROM documents) THEN doc_id % 7 END AS label,
 doc_id < (SELECT max(doc_id) - 19 FROM documents) AS matched FROM documents""")
def side_label_many(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark)
    ids = table(spark, sf, "documents").select("doc_id")
    kept = F.col("doc_id") < ids.agg(F.max("doc_id") - 19).scalar()
    ids.repartitionByRange(3, "doc_id").sortWithinPartitions("doc_id").select(
        F.concat(F.lit("text of "), F.col("doc_id").cast("string"))).write.text(f"{folder}/texts")
    ids.where(kept).repartitionByRange(2, "doc_id").sortWithinPartitions("doc_id").select(
        (F.col("doc_id") % 7).cast("string")).write.text(f"{folder}/labels")
    zipped = tx.read_texts_with_label_file(spark, f"{folder}/texts", f"{folder}/labels")
    return zipped.select(F.regexp_extract("text", "[0-9]+", 0).cast("long").alias("doc_id"), tx.integer_label("label").alias("label"),
        F.col("label").isNotNull().alias("matched"))


# A catalogue of processed names on disk decides what is left to do.
@query("SELECT doc_id FROM documents WHERE doc_id % 5 >= 2")
def catalogue_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark)
    names = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("name"))
    for part in (0, 1):
        sinks.write_catalogue(names.where(F.col("doc_id") % 5 == part), folder)
    return sinks.not_yet_processed(names, sinks.read_catalogue(spark, folder), "name").select("doc_id")


@query("""SELECT count(*) AS n, sum(idx)::BIGINT AS indices, sum(n)::BIGINT AS words FROM (
 SELECT row_number() OVER (ORDER BY n DESC, w) + 1 AS idx, n FROM (SELECT w, count(*) AS n FROM (
  SELECT unnest(regexp_extract_all(lower(text), '[^\\s\\x0B\\x1C-\\x1F\\x{85}\\p{Z}]+')) AS w FROM documents) GROUP BY w ORDER BY n DESC, w LIMIT 1998)
 UNION ALL SELECT 0, NULL UNION ALL SELECT 1, NULL)""")
def vocabulary_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark)
    write_vocabulary(build_vocabulary(texts(spark, sf), max_size=2000), folder)
    return read_vocabulary(spark, folder).agg(F.count("*").alias("n"), F.sum("idx").alias("indices"), F.sum("n").alias("words"))


# Metrics as CSV and their summary as JSON.
@query("SELECT lang AS language, count(*) AS n, (SELECT count(*) FROM documents) AS total_texts, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY lang")
def metrics_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark)
    metrics = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("language"), F.length("text").alias("length"))
    sinks.write_metrics_csv(metrics, f"{folder}/metrics")
    sinks.write_summary(metrics, f"{folder}/summary")
    rows = spark.read.csv(f"{folder}/metrics", header=True, schema="doc_id long, language string, length long")
    summary = spark.read.schema("total_texts long, languages map<string,long>").json(f"{folder}/summary")
    counted = summary.select("total_texts", F.explode("languages").alias("language", "n"))
    return rows.groupBy("language").agg(F.sum("length").alias("chars")).join(counted, "language").select("language", "n", "total_texts", "chars")


# Every output is written twice and a third time by a job that fails: it stays as it was.
@query("""SELECT 'documents' AS output, count(*) AS n FROM documents UNION ALL SELECT 'dataset', count(*) FROM documents
UNION ALL SELECT 'samples', count(*) FROM documents UNION ALL SELECT 'metrics', count(*) FROM documents
UNION ALL SELECT 'archive', count(*) FROM documents UNION ALL SELECT 'names', count(*) FROM documents UNION ALL SELECT 'name lines', count(*) FROM documents""")
def repeated_outputs(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark)
    docs = table(spark, sf, "documents").select("source", "doc_id", "text", F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("name"))

    def write(rows: DataFrame) -> None:
        sinks.write_document_text(rows, f"{folder}/documents", source="source", order="doc_id")
        sinks.write_dataset(ratio_split(rows, "doc_id"), f"{folder}/dataset", text="name")
        sinks.write_metrics_csv(rows.select("doc_id", F.length("text").alias("length")), f"{folder}/metrics")
        sinks.write_catalogue(rows, f"{folder}/names", run="first")
        write_warc(rows, f"{folder}/archive", url="name", content="text")

    write(docs)
    write(docs)
    broken = docs.withColumn("text", F.when(F.col("doc_id") % 97 == 5, F.raise_error(F.lit("broken row"))).otherwise(F.col("text")))
    for sink in (
        lambda: sinks.write_document_text(broken, f"{folder}/documents", source="source", order="doc_id"),
        lambda: sinks.write_dataset(ratio_split(broken, "doc_id"), f"{folder}/dataset", text="name"),
        lambda: sinks.write_metrics_csv(broken.select("doc_id", F.length("text").alias("length")), f"{folder}/metrics"),
        lambda: write_warc(broken, f"{folder}/archive", url="name", content="text"),
    ):
        try:
            sink()
        except Exception:  # noqa: BLE001
            continue
        raise AssertionError("a job that had to fail did not")
    count = lambda name, df: df.agg(F.lit(name).alias("output"), F.count("*").alias("n"))
    numbered = spark.read.text(f"{folder}/documents").where(F.col("value").rlike("^# Document [0-9]+$"))
    parts = [
        count("documents", numbered), count("dataset", tx.read_dataset(spark, f"{folder}/dataset/data")),
        count("samples", spark.read.text(f"{folder}/dataset/text").where("value = '--- Sample ---'")),
        count("metrics", spark.read.csv(f"{folder}/metrics", header=True)), count("archive", read_warc(spark, f"{folder}/archive")),
        count("names", sinks.read_catalogue(spark, f"{folder}/names")),
        count("name lines", spark.read.text(f"{folder}/names", recursiveFileLookup=True))]
    out = parts[0]
    for more in parts[1:]:
        out = out.union(more)
    return out


# The first records of each archive, responses or not.
@query("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents) WHERE n <= 7")
def warc_first_records(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark)
    docs = table(spark, sf, "documents").select("source", "doc_id", "text")
    dealt = docs.repartition("source").sortWithinPartitions("source", "doc_id")
    numbered = dealt.withColumn("url", F.concat_ws("/", "source", F.col("doc_id").cast("string")))
    # One archive for each source: a task writes those it holds one after the other.
    for (source,) in sorted(docs.select("source").distinct().collect()):
        write_warc(numbered.where(F.col("source") == source).coalesce(1).sortWithinPartitions("doc_id"), folder, content="text", mode="append")
    first = read_warc(spark, folder, max_records=7)
    return first.select(F.split("url", "/")[0].alias("source"), F.split("url", "/")[1].cast("long").alias("doc_id"))


# A manifest of archives, compressed, and a catalogue of crawls.
@query("SELECT 'seg/' || doc_id || '.warc.gz' AS archive, 'crawl-' || (SELECT max(doc_id) FROM documents) AS crawl FROM documents WHERE doc_id % 3 <> 0")
def manifest_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark)
    ids = table(spark, sf, "documents").select("doc_id")
    ending = F.when(F.col("doc_id") % 3 == 0, F.lit(".warc")).otherwise(F.lit(".warc.gz"))
    ids.select(F.concat(F.lit("seg/"), F.col("doc_id").cast("string"), ending)).write.option("compression", "gzip").text(f"{folder}/manifest")
    # Newest first, as one JSON list.
    entries = F.sort_array(F.collect_list(F.struct("doc_id", F.concat(F.lit("crawl-"), F.col("doc_id").cast("string")).alias("id"))), asc=False)
    listed = F.transform(entries, lambda e: F.struct(e["id"].alias("id"), e["id"].alias("name")))
    ids.agg(F.to_json(listed).alias("value")).coalesce(1).write.text(f"{folder}/crawls")
    newest = latest_crawl(read_crawls(spark, f"{folder}/crawls")).select("id").scalar()
    return read_manifest(spark, f"{folder}/manifest").withColumn("crawl", newest)


# A folder of text files below it, with their labels in the files' names.
@query("SELECT doc_id, doc_id % 4 AS label FROM documents")
def labelled_folder(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark)
    docs = table(spark, sf, "documents").select((F.col("doc_id") % 4).alias("label"), F.col("doc_id").cast("string").alias("value"))
    docs.repartition("label").write.partitionBy("label").text(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for label in range(4):
        for i, status in enumerate(fs.listStatus(path(f"{folder}/label={label}"))):
            fs.rename(status.getPath(), path(f"{folder}/label={label}/part{i}_class_{label}_.txt"))
    files = tx.read_labelled_directory(spark, folder)
    return files.select(F.explode(F.split("text", "\n")).alias("line"), "label").where("line <> ''").select(F.col("line").cast("long").alias("doc_id"), "label")


# The archive job from archives to a dataset on disk: every document once, four fifths in the train part, counts in the metadata.
@query(f"""WITH {PAGES}, {s.quality_cte('pd', 'page_id', 'x')},
k AS (SELECT key AS page_id, text AS t FROM (SELECT *, {s.FILTER_REASON} AS r FROM quality) WHERE r IS NULL),
c AS (SELECT * FROM (SELECT page_id, {s.clean_deep('t')} AS text FROM k) WHERE length(text) > 100)
SELECT url, text, floor((SELECT count(*) FROM c) * 0.8)::BIGINT AS train, (SELECT count(*) FROM c) AS total, true AS exact FROM c JOIN pages USING (page_id)""")
def archive_job(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark)
    write_warc(table(spark, sf, "pages"), f"{folder}/in", content="html")
    written = jobs.build_dataset_from_archives(spark, f"{folder}/in", f"{folder}/out")
    meta = spark.read.json(f"{folder}/out/metadata").select(F.struct("train", "total").alias("m")).scalar()
    exact = written.agg((F.count_if(F.col("split") == "train") == F.floor(F.count("*") * 0.8)).alias("e")).scalar()
    return written.withColumn("m", meta).select("url", "text", "m.train", "m.total", exact.alias("exact"))


# The folder job from text files, one for each document, to metrics, summary and dataset on disk.
@query("""SELECT doc_id, length(text) + 1 AS length, length(text) + 1 >= 100 AS kept,
 (SELECT count(*) FROM documents) AS texts, (SELECT count(*) - ceil(count(*) * 0.2) FROM documents WHERE length(text) + 1 >= 100)::BIGINT AS train FROM documents""")
def folder_job(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark)
    docs = table(spark, sf, "documents").select(F.concat(F.lit("doc_id="), "doc_id").alias("name"), "text")
    sinks.write_text_files(docs, f"{folder}/in", "name", "text")
    written = jobs.text_folder_dataset(spark, f"{folder}/in", f"{folder}/out", recursive=True)
    doc = lambda c: F.regexp_extract(c, r"doc_id=([0-9]+)\.txt", 1).cast("long").alias("doc_id")
    metrics = spark.read.csv(f"{folder}/out/text_quality_metrics", header=True).select(doc("path"), F.col("length").cast("long").alias("length"))
    texts_ = spark.read.json(f"{folder}/out/summary").select("total_texts").scalar()
    train = written.agg(F.count_if(F.col("split") == "train").alias("t")).scalar()
    kept = written.select(doc("path"), F.lit(True).alias("kept"))
    return metrics.join(kept, "doc_id", "left").select(
        "doc_id", "length", F.coalesce("kept", F.lit(False)).alias("kept"), texts_.alias("texts"), train.alias("train"))
