"""Transcripts from text, JSON and JSONL files and folders, as document and segment tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.text import normalized
from ..operators.segment import to_ms

_NUMBERS = ("start_ms", "end_ms", "start_seconds", "end_seconds", "start", "end")
SEGMENT = T.StructType([T.StructField("text", T.StringType()), *[T.StructField(n, T.DoubleType()) for n in _NUMBERS]])
#: Fields of a transcript record that are read; others are ignored.
RECORD = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("document_id", "video_id", "id", "transcript", "text", "language")]
    + [T.StructField("segments", T.ArrayType(SEGMENT)), T.StructField("segment_index", T.LongType()), *[T.StructField(n, T.DoubleType()) for n in _NUMBERS]]
)
#: In one folder the first that exists is read, and folders below it are not.
PREFERENCE = ("transcript_segments.jsonl", "transcript.json", "transcript.txt")
SIDECARS = {"transcript_metadata.json": "source_metadata", "transcript_insights.json": "source_insights"}
SUFFIXES = ("txt", "json", "jsonl")


def _present(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def stable_document_id(path: Column, text: Column) -> Column:
    """doc_ and 16 hex digits of the SHA-256 of path (with forward slashes) and content."""
    return F.concat(F.lit("doc_"), F.substring(F.sha2(F.concat(F.replace(path, F.lit("\\"), F.lit("/")), text), 256), 1, 16))


def list_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """path, parent, name and suffix of the transcript files that a folder walk takes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("_metadata.file_path").alias("path"))
    files = files.withColumns({"name": F.element_at(F.split("path", "/"), -1), "parent": F.regexp_replace("path", "/[^/]*$", "")})
    files = files.withColumn("suffix", F.lower(F.regexp_extract("name", r"\.([^.]+)$", 1))).where(F.col("suffix").isin(*SUFFIXES) & ~F.col("name").isin(*SIDECARS))
    rank = F.when(F.col("name").isin(*PREFERENCE), F.array_position(F.array(*[F.lit(p) for p in PREFERENCE]), F.col("name")))
    files = files.withColumn("rank", rank)
    best = files.withColumn("best", F.min("rank").over(Window.partitionBy("parent")))
    chosen = best.where(F.col("best").isNull() | (F.col("rank") == F.col("best"))).drop("rank", "best")
    # A folder with a preferred file ends the walk there.
    stops = files.where("rank IS NOT NULL").select(F.concat("parent", F.lit("/")).alias("stop")).distinct()
    parents = chosen.select("parent").distinct()
    above = parents.select("parent", F.explode(F.transform(F.sequence(F.lit(1), F.size(F.split("parent", "/")) - 1), lambda i: F.concat(F.array_join(F.slice(F.split("parent", "/"), 1, i), "/"), F.lit("/")))).alias("stop"))
    below = above.join(stops, "stop", "left_semi").select("parent").distinct()
    return chosen.join(below, "parent", "left_anti")


def read_text_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """source_path and text, one row a file."""
    return spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("text"))


def read_json_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """One object a file."""
    return spark.read.schema(RECORD).option("multiLine", True).json(paths).select("*", F.col("_metadata.file_path").alias("source_path"))


def numbered_lines(lines: DataFrame) -> DataFrame:
    """source_path, line (from 1) and value of lines: rows of the text source with their ``_metadata``.

    A file is read in blocks by many tasks, in whatever order these are packed.
    Lines are numbered within their block, blocks are counted and their counts
    summed along the file, so the number is the true one and no task sorts a file.
    """
    own = lines.select(F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    sums = own.groupBy("source_path", "block").agg(F.count(F.lit(1)).alias("n"))
    before = sums.select("source_path", "block", (F.sum("n").over(Window.partitionBy("source_path").orderBy("block")) - F.col("n")).alias("before"))
    placed = own.withColumn("place", F.row_number().over(Window.partitionBy("source_path", "block").orderBy("at")))
    return placed.join(before, ["source_path", "block"]).select("source_path", (F.col("before") + F.col("place")).alias("line"), "value")


def json_records(lines: DataFrame) -> DataFrame:
    """One object a line with source_path and line, of numbered_lines; empty lines are none, and a line that is no object fails with its file and number."""
    kind = T.StructType([*RECORD.fields, T.StructField("_bad", T.StringType())])
    parsed = lines.where(F.trim("value") != "").withColumn("r", F.from_json("value", kind, {"columnNameOfCorruptRecord": "_bad"}))
    place = F.concat(F.lit("no JSON object at "), "source_path", F.lit(":"), F.col("line").cast("string"))
    whole = F.col("r").isNotNull() & F.col("r._bad").isNull() & F.json_object_keys("value").isNotNull()
    return parsed.where(F.when(whole, F.lit(True)).otherwise(F.raise_error(place).cast("boolean"))).select(*[F.col(f"r.{n}").alias(n) for n in RECORD.names], "source_path", "line")


def read_jsonl_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """One object a line, with ``line``, its number in the file."""
    return json_records(numbered_lines(spark.read.text(paths)))


def is_segment_file(rows: DataFrame) -> DataFrame:
    """source_path of files whose rows all have text and of which one has a time."""
    timed = F.greatest(*[F.col(n).isNotNull().cast("int") for n in _NUMBERS])
    return rows.groupBy("source_path").agg(F.bool_and(F.col("text").isNotNull()).alias("texts"), F.max(timed).alias("timed")).where("texts AND timed = 1").select("source_path")


def _times(c) -> dict[str, Column]:
    return {"start_ms": to_ms(c("start_ms"), c("start_seconds"), c("start")), "end_ms": to_ms(c("end_ms"), c("end_seconds"), c("end"))}


def load_transcripts(spark: SparkSession, path: str, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents (document_id, source_path, source_type, language, text, source_metadata, source_insights) and timed segments of a file or folder.

    Text, JSON and JSONL files are read as list_transcripts picks them; a JSONL
    file whose rows are segments is one document. Ids and languages come from the
    record, else the metadata file beside it, else path and content. A JSON record
    without text and segments and a JSONL file without records fail when they are
    read, as does a path of another kind at once. limit: the first documents by path and id.
    """
    suffix = path.rstrip("/").rpartition("/")[2].rpartition(".")
    if suffix[1] and suffix[2].isalnum() and suffix[2].lower() not in SUFFIXES:
        raise ValueError(f"unsupported transcript format: {path}")
    files = list_transcripts(spark, path).select(F.col("path").alias("source_path"))
    reader = lambda kind: spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*.[{kind[0]}{kind[0].upper()}]{kind[1:]}")
    at = F.col("_metadata.file_path").alias("source_path")
    texts = reader("txt").text(path, wholetext=True).select(at, F.col("value").alias("text")).join(files, "source_path", "left_semi")
    objects = reader("json").schema(RECORD).option("multiLine", True).option("mode", "FAILFAST").json(path).select("*", at).join(files, "source_path", "left_semi")
    lines = json_records(numbered_lines(reader("jsonl").text(path)).join(files, "source_path", "left_semi"))
    of_lines = files.where(F.lower("source_path").endswith(".jsonl"))
    empty = of_lines.join(lines.select("source_path").distinct(), "source_path", "left_anti").select(F.raise_error(F.concat(F.lit("a JSONL transcript holds no record: "), "source_path")).cast("string").alias("text"))
    timed = is_segment_file(lines)
    rows = lines.join(timed, "source_path", "left_semi")
    plain = lines.join(timed, "source_path", "left_anti").drop("line")
    beside = lambda d: with_sidecars(d, spark, path)
    records = beside(objects.withColumn("source_type", F.lit("json")).unionByName(plain.withColumn("source_type", F.lit("jsonl"))))
    missing = F.coalesce(_present(F.col("transcript"), F.col("text")), F.lit("")).eqNullSafe("") & (F.coalesce(F.size("segments"), F.lit(0)) <= 0) & (F.col("source_type") == "json")
    records = records.withColumn("text", F.when(missing, F.raise_error(F.concat(F.lit("a JSON transcript needs text or segments: "), "source_path")).cast("string")).otherwise(F.col("text")))
    records = records.withColumn("document_id", _present(F.col("document_id"), F.col("video_id"), F.col("id"), _metadata_id())).withColumn("language", _present(F.col("language"), _metadata("language")))
    docs, segments = documents_and_segments(records)
    extra = ("source_type", "source_metadata", "source_insights")
    whole = texts.withColumns({"source_type": F.lit("txt"), "document_id": F.lit(None).cast("string"), "language": F.lit(None).cast("string")})
    whole = beside(whole).withColumn("document_id", _present(_metadata_id(), stable_document_id(F.col("source_path"), normalized(F.col("text"))))).withColumn("language", F.coalesce(_metadata("language"), F.lit("und")))
    parts = beside(rows.groupBy("source_path").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("segment_index", "line").alias("at"), "text"))).alias("parts"), F.first(F.coalesce("document_id", "video_id"), True).alias("document_id"), F.first("language", True).alias("language")))
    name = _present(F.col("document_id"), _metadata_id(), stable_document_id(F.col("source_path"), F.lit("")))
    parts = parts.select(name.alias("document_id"), "source_path", F.coalesce("language", _metadata("language"), F.lit("und")).alias("language"), F.array_join(F.transform("parts", lambda p: p["text"]), " ").alias("text"), F.lit("jsonl").alias("source_type"), *extra[1:])
    docs = docs.unionByName(whole.select(*docs.columns)).unionByName(parts.select(*docs.columns))
    docs = docs.unionByName(empty, allowMissingColumns=True)
    cut = segment_rows(rows).drop("document_id").join(parts.select("source_path", "document_id"), "source_path")
    segments = segments.unionByName(cut.select(*segments.columns))
    if limit is not None:
        docs = docs.orderBy("source_path", "document_id").limit(limit)
        segments = segments.join(docs.select("document_id"), "document_id", "left_semi")
    return docs, segments


def load_transcript(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """As load_transcripts for exactly one document; fails for none or several."""
    docs, segments = load_transcripts(spark, path)
    if (n := docs.limit(2).count()) != 1:
        raise ValueError(f"{path} holds {'no document' if n == 0 else 'more than one document'}")
    return docs, segments


def _metadata(field: str) -> Column:
    return F.get_json_object("source_metadata", f"$.{field}")


def _metadata_id() -> Column:
    return _present(*[_metadata(n) for n in ("document_id", "video_id", "id")])


def documents_and_segments(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (document_id, source_path, language, text) and timed segments of JSON objects (one document a row).

    A record without text or segments makes a document without units.
    """
    own = records.withColumn("_text", _present(F.col("transcript"), F.col("text")))
    joined = F.array_join(F.transform(F.coalesce("segments", F.array().cast(T.ArrayType(SEGMENT))), lambda s: s["text"]), " ")
    own = own.withColumn("_text", F.coalesce("_text", joined, F.lit("")))
    own = own.withColumn("document_id", _present(F.col("document_id"), F.col("video_id"), F.col("id"), stable_document_id(F.col("source_path"), F.col("_text"))))
    more = [c for c in ("source_type", *SIDECARS.values()) if c in own.columns]
    docs = own.select("document_id", "source_path", F.coalesce("language", F.lit("und")).alias("language"), F.col("_text").alias("text"), *more)
    cut = own.select("document_id", F.posexplode("segments").alias("segment_index", "s")).where("trim(coalesce(s.text, '')) <> ''")
    return docs, cut.select("document_id", "segment_index", F.col("s.text").alias("text"), *[v.alias(k) for k, v in _times(lambda n: F.col(f"s.{n}")).items()])


def segment_rows(rows: DataFrame) -> DataFrame:
    """Timed segments of JSONL segment files, one document a file, by segment_index or else line order."""
    name = _present(F.first("document_id", True).over(Window.partitionBy("source_path")), F.first("video_id", True).over(Window.partitionBy("source_path")), stable_document_id(F.col("source_path"), F.lit("")))
    return rows.where("trim(coalesce(text, '')) <> ''").select("source_path", name.alias("document_id"), F.coalesce("segment_index", "line").alias("segment_index"), "text", *[v.alias(k) for k, v in _times(F.col).items()])


def text_document(spark: SparkSession, text: str, document_id: str = "document", language: str | None = None) -> DataFrame:
    """One document from a string; fails if nothing is left after normalising."""
    own = spark.createDataFrame([(document_id, text, language or "und")], "document_id string, text string, language string")
    clean = normalized(F.col("text"))
    return own.withColumn("text", F.when(F.length(clean) > 0, F.col("text")).otherwise(F.raise_error(F.lit("the text is empty"))))


def with_sidecars(docs: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Documents with source_metadata and source_insights, the JSON beside their file, null where there is none."""
    out = docs.withColumn("_parent", F.regexp_replace("source_path", "/[^/]*$", ""))
    for name, column in SIDECARS.items():
        found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name).text(path, wholetext=True)
        out = out.join(found.select(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("_parent"), F.col("value").alias(column)), "_parent", "left")
    return out.drop("_parent")
