"""Token counts of documents in flat token files by scanning for separators.

A flat file is nothing but token ids, one after the other, each document ended
by the same separator id; there is no index. Tasks read blocks of such files by
byte range and find the separators of a block at once. What a block cannot know
(how many documents began before it, and where the open one began) comes from a
prefix scan over the blocks' summaries, in two levels so that a file of any size
is no single group.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fresh_path, materialise, schema_of
from .packing import default_tokenizer
from .tokens import word_tokenizer

#: Bytes of a token id, of a block, and blocks summed at a time in the scan.
WIDTH, BLOCK_BYTES, GROUP_BLOCKS = 2, 1 << 22, 1024
#: <|endoftext|> of the tokenizer; its text in a document is written as ordinary ids.
SEPARATOR = 49407


def _filesystem(path: str):
    """The pyarrow filesystem of a path or URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, separator: int = SEPARATOR) -> DataFrame:
    """Write docs(doc_id, text) as flat token files in a folder that all executors share.

    Returns file and doc_ids in their order there, as a materialised table of one
    row per batch: batch, file, first (ordinal of its first document) and doc_ids.
    A null text counts as empty. A file is written under a name of its own and
    renamed when whole, so a task that runs twice leaves one file with its name.
    """
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        store, base = _filesystem(folder)
        store.create_dir(base)
        name = f"{TaskContext.get().partitionId():06d}.tok"
        draft = f"{base}/_{name}.{uuid.uuid4().hex}"
        encoder, count, rows = word_tokenizer(path, special_as_text=True), 0, []
        with store.open_output_stream(draft) as out:
            for b in batches:
                for start in range(0, len(b), 1000):
                    part = b.iloc[start : start + 1000]
                    for ids in encoder.encode(list(part["text"])):
                        out.write(np.append(ids, np.uint16(separator)).astype("<u2").tobytes())
                    rows.append((name, count, [None if pd.isna(i) else int(i) for i in part["id"]]))
                    count += len(part)
                    yield pd.DataFrame([rows.pop()], columns=["file", "first", "doc_ids"])
        if store.get_file_info(f"{base}/{name}").is_file:  # an earlier attempt got as far as here, with the same bytes
            store.delete_file(draft)
        else:
            store.move(draft, f"{base}/{name}")

    own = docs.select(F.col("doc_id").cast("string").alias("id"), "text")
    return materialise(own.mapInPandas(run, schema_of(file="string", first="long", doc_ids="longs")), "token-files")


def list_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """file and bytes of the token files in a folder."""
    from pyarrow import fs

    store, base = _filesystem(folder)
    found = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
    return spark.createDataFrame([(f.base_name, f.size) for f in found if f.is_file and f.base_name.endswith(".tok")], "file string, bytes long")


def scan_token_files(files: DataFrame, folder: str, separator: int = SEPARATOR, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """file, document (ordinal in its file), start and n_tokens (separator not counted) of all documents of flat token files.

    files(file, bytes). Tokens after a file's last separator are a document too;
    an empty file has none. Bytes beyond the last whole id are not read.
    """
    spark = files.sparkSession
    kind, step = np.dtype(f"<u{width}"), block_bytes // width * width
    blocks = files.select("file", F.col("bytes"), F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), ((F.col("bytes") - 1) / step).cast("long"))).cast("array<bigint>")).alias("block"))
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = blocks.where("bytes > 0").repartition(n, "file", "block")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _filesystem(folder)
        for b in batches:
            for file, size, block in zip(b["file"], b["bytes"], b["block"], strict=True):
                with store.open_input_file(f"{base}/{file}") as f:
                    raw = f.read_at(min(step, size // width * width - block * step), block * step)
                ends = np.flatnonzero(np.frombuffer(raw, kind) == separator) + block * step // width
                last = (size - 1) // step == block
                yield pd.DataFrame({"file": [file], "block": [block], "tokens": [len(raw) // width], "final": [last], "ends": [ends.tolist()]})

    found = materialise(blocks.mapInPandas(search, schema_of(file="string", block="long", tokens="long", final="boolean", ends="longs")), "token-ends")
    # Summaries: how many documents end in a block, and where the last of them ends. -1: none.
    own = found.select("file", "block", (F.col("block") / GROUP_BLOCKS).cast("long").alias("grp"), F.size("ends").cast("long").alias("n"), F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(-1)).alias("last"))
    groups = own.groupBy("file", "grp").agg(F.sum("n").alias("gn"), F.max("last").alias("glast"))
    earlier = Window.partitionBy("file").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("file", "grp", F.coalesce(F.sum("gn").over(earlier), F.lit(0)).alias("gn"), F.coalesce(F.max("glast").over(earlier), F.lit(-1)).alias("glast"))
    inside = Window.partitionBy("file", "grp").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumns({"before": F.coalesce(F.sum("n").over(inside), F.lit(0)), "opened": F.coalesce(F.max("last").over(inside), F.lit(-1))})
    scanned = own.join(groups, ["file", "grp"]).select("file", "block", (F.col("before") + F.col("gn")).alias("before"), (F.greatest("opened", "glast") + 1).alias("opened"))
    stitched = found.join(scanned, ["file", "block"])
    # A file's last block also closes what its last separator left open.
    end = (F.col("block") * (step // width) + F.col("tokens")).cast("long")
    tail = F.when(F.col("final") & (F.coalesce(F.try_element_at("ends", F.lit(-1)), F.col("opened") - 1) + 1 < end), F.array(end)).otherwise(F.array().cast("array<bigint>"))
    stitched = stitched.withColumn("ends", F.concat("ends", tail))
    starts = F.concat(F.array("opened"), F.transform("ends", lambda e: e + 1))
    return stitched.select("file", "before", F.posexplode(F.arrays_zip(F.col("ends").alias("end"), F.slice(starts, F.lit(1), F.size("ends")).alias("start")))).select(
        "file", (F.col("before") + F.col("pos")).alias("document"), F.col("col.start").alias("start"), (F.col("col.end") - F.col("col.start")).alias("n_tokens")
    )


def count_document_tokens(docs: DataFrame, tokenizer: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, file, document, start and n_tokens for every row of docs(doc_id, text).

    The documents are written as flat token files and those are scanned; the ids
    come back by place in the file. Repeated rows and null ids stay.
    """
    spark = docs.sparkSession
    folder = fresh_path(spark, "flat-tokens")
    order = write_token_files(docs, folder, tokenizer)
    counts = scan_token_files(list_token_files(spark, folder), folder, block_bytes=block_bytes)
    ids = order.select("file", "first", F.posexplode("doc_ids").alias("pos", "doc_id")).select("file", (F.col("first") + F.col("pos")).alias("document"), "doc_id")
    return ids.join(counts, ["file", "document"]).select("doc_id", "file", "document", "start", "n_tokens")
