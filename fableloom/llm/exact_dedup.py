"""Exact duplicates by an extendible-hash index on shared files.

Texts are hashed to 64 bits. A directory over the first bits of the hash names
each text's bucket; while a bucket holds more bytes than fit, it is split by its
next bit, and the directory doubles where it has no further bit. Each bucket is
a range of keys with one owner task, which sorts it by hash, chains texts of
equal hash, tells them apart by their bytes and writes the bucket's file. A
bucket that no bit can split, as its texts are all equal or nearly so, overflows
into pages, each with an owner of its own; their classes are put together
afterwards. Only built-in functions touch rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch

#: Bytes of text in a bucket, and what a row takes besides its text.
CAPACITY, ROW_BYTES = 16 << 20, 64
#: The directory has at most 2 ** MAX_DEPTH entries; buckets grow where the corpus would need more.
MAX_DEPTH = 20
#: Counters that come to the driver at a time, as a power of two.
MAX_COUNTERS = 20
HASH_BITS = 64


@dataclass
class Bucket:
    """Rows whose hash begins with the ``depth`` bits of ``prefix``; least and most are its smallest and largest hash."""

    depth: int
    prefix: int
    size: int
    least: int
    most: int

    def splits(self, capacity: int) -> bool:
        return self.size > capacity and self.least != self.most and self.depth < MAX_DEPTH

    def pages(self, capacity: int) -> int:
        return max(1, -(-self.size // capacity))


def halves(bucket: Bucket, counted: list[Bucket], capacity: int) -> list[Bucket]:
    """The bucket split bit by bit while its halves are too large, by the counts of deeper prefixes within it.

    counted: non-empty buckets of one depth, below the bucket's. Empty halves are
    kept, so that every hash has a bucket.
    """
    if not counted:
        return [bucket]
    if not bucket.splits(capacity) or bucket.depth == counted[0].depth:
        return [bucket]
    out = []
    for bit in (0, 1):
        prefix = 2 * bucket.prefix + bit
        inside = [c for c in counted if c.prefix >> (c.depth - bucket.depth - 1) == prefix]
        sums = (sum(c.size for c in inside), min((c.least for c in inside), default=0), max((c.most for c in inside), default=0))
        out += halves(Bucket(bucket.depth + 1, prefix, *sums), inside, capacity)
    return out


@dataclass
class Directory:
    """Where each prefix of ``depth`` bits has its bucket, and each bucket its pages."""

    buckets: list[Bucket]
    capacity: int
    depth: int = field(init=False)

    def __post_init__(self):
        self.buckets = sorted(self.buckets, key=lambda b: b.prefix << (MAX_DEPTH - b.depth))
        self.depth = max(1, *(b.depth for b in self.buckets))

    def entries(self) -> list[int]:
        return [i for i, b in enumerate(self.buckets) for _ in range(1 << (self.depth - b.depth))]

    def pages(self) -> list[int]:
        return [b.pages(self.capacity) for b in self.buckets]

    def owners(self) -> list[int]:
        """The number of each bucket's first page."""
        out = [0]
        for n in self.pages():
            out.append(out[-1] + n)
        return out[:-1]

    @staticmethod
    def _at(values: list[int], i: Column) -> Column:
        return F.get(F.from_json(F.lit(json.dumps(values)), "array<int>"), i)

    def bucket_of(self, h: Column) -> Column:
        return self._at(self.entries(), F.shiftrightunsigned(h, HASH_BITS - self.depth).cast("int"))

    def pages_of(self, bucket: Column) -> Column:
        return self._at(self.pages(), bucket)

    def owner_of(self, bucket: Column) -> Column:
        return self._at(self.owners(), bucket)


def grow_directory(sizes: DataFrame, capacity: int = CAPACITY) -> Directory:
    """The directory for sizes(h, size), grown by splits until each bucket fits, is of one hash or has MAX_DEPTH bits.

    Counts of prefixes alone come to the driver, 2 ** MAX_COUNTERS at most at a
    time: a job counts several doublings for all buckets that are too large.
    """

    def counted(depth: int, within: DataFrame) -> list[Bucket]:
        prefix = F.shiftrightunsigned("h", HASH_BITS - depth) if depth else F.lit(0).cast("long")
        found = within.groupBy(prefix.alias("prefix")).agg(F.sum("size").alias("size"), F.min("h").alias("least"), F.max("h").alias("most")).collect()
        return [Bucket(depth, r["prefix"], r["size"], r["least"], r["most"]) for r in found]

    buckets = counted(0, sizes) or [Bucket(0, 0, 0, 0, 0)]
    capacity = max(capacity, -(-buckets[0].size // (1 << (MAX_DEPTH - 2))))
    while large := [b for b in buckets if b.splits(capacity)]:
        # Buckets that are too large are split breadth first, so all of them have one depth.
        depth = large[0].depth
        step = max(1, min(12, MAX_COUNTERS - len(large).bit_length(), MAX_DEPTH - depth))
        within = sizes
        if depth:
            own = F.from_json(F.lit(json.dumps([b.prefix for b in large])), "array<bigint>")
            within = sizes.where(F.array_contains(own, F.shiftrightunsigned("h", HASH_BITS - depth)))
        inside: dict[int, list[Bucket]] = {}
        for c in counted(depth + step, within):
            inside.setdefault(c.prefix >> step, []).append(c)
        split = {b.prefix: halves(b, inside.get(b.prefix, []), capacity) for b in large}
        buckets = [b for b in buckets if not b.splits(capacity)] + [x for parts in split.values() for x in parts]
    return Directory(buckets, capacity)


@dataclass
class CopyIndex:
    """The index: its directory, and its files with a row for each document.

    bucket, owner (the page), h, chain (which of the texts of this hash), place
    (1 for the row of a page's class that stays), n and top (rows and largest id
    of the page's class), doc_id, text_sha256, row (what is carried of a class's
    row that stays) and, for a class in a page of several, its text.
    """

    directory: Directory
    files: DataFrame
    scratch: Scratch

    def delete(self) -> None:
        """Delete the files; nothing that reads them may be used any more."""
        self.scratch.clear()

    def classes(self) -> DataFrame:
        """doc_id, keep_id, group_size, kept, text_sha256 and row for every document."""
        paged = [i for i, n in enumerate(self.directory.pages()) if n > 1]
        whole = self.files.select("doc_id", F.col("top").alias("keep_id"), F.col("n").alias("group_size"), (F.col("place") == 1).alias("kept"), "text_sha256", "row", "bucket")
        if not paged:
            return whole.drop("bucket")
        several = F.array_contains(F.from_json(F.lit(json.dumps(paged)), "array<int>"), F.col("bucket"))
        rows = self.files.where(several)
        # One row a class and page; their texts are compared once more, between the pages.
        heads = rows.where("text IS NOT NULL").select("owner", "h", "chain", "n", "top", "text")
        classes = heads.groupBy("h", "text").agg(F.sum("n").alias("group_size"), F.max(F.struct("top", "owner")).alias("best"), F.collect_list(F.struct("owner", "chain")).alias("pages"))
        known = classes.select("h", "group_size", "best", F.inline("pages"))
        met = rows.select("owner", "h", "chain", "doc_id", "place", "text_sha256", "row").join(known, ["owner", "h", "chain"])
        kept = (F.col("place") == 1) & (F.col("owner") == F.col("best.owner"))
        out = met.select("doc_id", F.col("best.top").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256", "row")
        return whole.where(~several).drop("bucket").unionByName(out)


def build_index(docs: DataFrame, carry: bool = False, capacity: int = CAPACITY, hashed: Callable[[Column], Column] = F.xxhash64) -> CopyIndex:
    """Index docs(doc_id, text); with carry, rows that may stay are kept in it with all their columns.

    Two passes over the texts: the first hashes and measures them, the second
    sends each to the owner of its bucket. Within a bucket of several pages rows
    are dealt by their id, so rows of one id and text meet on one page, and rows
    without an id by their number.
    """
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "copy_index")
    try:
        row = F.struct(*[docs[c] for c in docs.columns]) if carry else F.lit(None).cast("string")
        texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), row.alias("row"))
        keyed = texts.withColumn("h", hashed(F.col("text")))
        sizes = scratch.write(keyed.select("h", (F.octet_length("text") + ROW_BYTES).cast("long").alias("size")), "sizes")
        directory = grow_directory(sizes, capacity)
        scratch.drop(sizes)
        placed = keyed.withColumn("bucket", directory.bucket_of(F.col("h")))
        pages = directory.pages_of(F.col("bucket"))
        dealt = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.monotonically_increasing_id().cast("string"))), pages).cast("int")
        owned = placed.withColumn("several", pages > 1).withColumn("owner", directory.owner_of(F.col("bucket")) + F.when(F.col("several"), dealt).otherwise(0))
        owners = directory.owners()[-1] + directory.pages()[-1]
        same = Window.partitionBy("owner", "h", "text").orderBy(F.col("doc_id").desc_nulls_last())
        every = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        chained = owned.repartitionById(owners, F.col("owner")).select(
            "*", F.count(F.lit(1)).over(every).alias("n"), F.max("doc_id").over(every).alias("top"), F.row_number().over(same).alias("place"), F.dense_rank().over(Window.partitionBy("owner", "h").orderBy("text")).alias("chain")
        )
        stays = F.col("place") == 1
        filed = chained.select(
            "bucket", "owner", "h", "chain", "place", "n", "top", "doc_id", F.sha2("text", 256).alias("text_sha256"), F.when(stays, F.col("row")).alias("row"), F.when(stays & F.col("several"), F.col("text")).alias("text")
        )
        return CopyIndex(directory, scratch.write(filed, "buckets"), scratch)
    except BaseException:
        scratch.clear()
        raise


def find_copies(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row of docs(doc_id, text).

    Texts are equal when their bytes are; a null text is an empty one. Of equal
    texts the row with the largest id stays, a row without an id only where none
    has one, and of rows that repeat an id with its text one. Long texts are
    compared whole. Other columns are ignored, and an empty table gives an empty
    one. The result reads the index's files in the shared folder, which stay.
    """
    return build_index(docs).classes().drop("row")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns, whatever these are called; for cases see find_copies."""
    return build_index(docs, carry=True).classes().where("kept").select("row.*")
