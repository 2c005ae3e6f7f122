"""Helpers shared by the training-corpus operators."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


_TYPES = {"long": T.LongType, "int": T.IntegerType, "double": T.DoubleType, "float": T.FloatType, "string": T.StringType, "boolean": T.BooleanType, "binary": T.BinaryType}


def schema_of(**columns: str) -> T.StructType:
    """A struct type from names and simple types, ``longs`` for an array of longs and so on; unlike DDL it needs no session."""
    made = {k: _TYPES[v]() if v in _TYPES else T.ArrayType(_TYPES[v[:-1]]()) for k, v in columns.items()}
    return T.StructType([T.StructField(k, v) for k, v in made.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; where none is named, one in the session's warehouse, if all executors share that."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named
    folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not re.match("local($|\\[)", spark.sparkContext.master) and re.match("file:|/", folder):
        raise ValueError(f"executors may not share {folder}: name a shared folder in spark.checkpoint.dir")
    return folder + "/_intermediate"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends here, and row numbers given before stay as they are."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one job, in a folder of their own below the shared one, deleted when they are no longer needed."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, f"{name}_{uuid.uuid4().hex}"
        self.root = f"{shared_dir(spark).rstrip('/')}/{self.name}"
        self.made: list[tuple[DataFrame, str, str | None]] = []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """As materialise."""
        path = f"{self.root}/{name}_{len(self.made)}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.made.append((out, path, None))
        return out

    def bucket(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """As write, but dealt and sorted by ``key``, so that joins and sums by it move nothing. It is a table of the catalogue until dropped."""
        n, table = int(self.spark.conf.get("spark.sql.shuffle.partitions")), f"{self.name}_{name}_{len(self.made)}"
        df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", f"{self.root}/{name}_{len(self.made)}").saveAsTable(table, format="parquet")
        out = self.spark.table(table)
        self.made.append((out, f"{self.root}/{name}_{len(self.made)}", table))
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Delete what write or bucket gave; nothing that reads it may be used any more."""
        for out, path, table in [m for m in self.made if any(m[0] is f for f in frames)]:
            if table:
                self.spark.sql(f"DROP TABLE `{table}`")
            self._delete(path)
        self.made = [m if all(m[0] is not f for f in frames) else (None, *m[1:]) for m in self.made]

    def clear(self) -> None:
        """Delete all that is left."""
        self.drop(*[m[0] for m in self.made if m[0] is not None])
        self._delete(self.root)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column of df is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def held_out(doc_id: Column) -> Column:
    """Whether a document's labels are kept for measuring: crc32 of its id as text divides by 5. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(labels: DataFrame, column: str, per_class: int) -> DataFrame:
    """At most ``per_class`` training ids of each class of ``labels[column]``, in the order of a hash of the id.

    Rows with a null id or label are left out, repeated ids take their largest
    label, and held-out ids are never taken. Two rows at most per id and class
    bound leave this function, so its result may be broadcast.
    """
    own = (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(column).cast("int").alias("y"))
    )
    parts = [own.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """text and y of the ids of a labelled_sample: of repeated ids the text with the smallest hash, so there is one row an id at most."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    one = rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "y")).alias("s"))
    return one.select("s.text", "s.y")


def class_counts(labels: DataFrame, column: str) -> tuple[int, int]:
    """Training rows labelled 0 and 1."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~held_out(F.col("doc_id")))
    row = own.agg(F.count_if(F.col(column) == 0).alias("n"), F.count_if(F.col(column) == 1).alias("p")).first()
    return row["n"], row["p"]
