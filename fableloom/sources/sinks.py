"""Tables of a run as Parquet, JSONL, CSV and notation text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of the CSV projections and what joins their arrays.
CSV_JOINTS = {"functions": "+", "secondary_functions": "+", "emotions_mentioned": "+", "unit_ids": "|", "relation_ids": "|", "rejected_relation_types": "|", "review_reasons": "|", "notation_sequence": " "}


def write_table(df: DataFrame, run_dir: str, name: str) -> None:
    df.write.mode("overwrite").parquet(f"{run_dir}/{name}")


def read_table(spark: SparkSession, run_dir: str, name: str, schema: str | None = None) -> DataFrame:
    """A table of a run; where it is missing and a schema is given, an empty one."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(f"{run_dir}/{name}")
    except AnalysisException:
        if schema is None:
            raise
        return spark.createDataFrame([], schema)


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines that keep nulls."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def csv_columns(df: DataFrame) -> DataFrame:
    """Arrays of strings joined, other nested columns as JSON."""

    def flat(name: str, kind: str) -> Column:
        if kind == "array<string>":
            return F.array_join(name, CSV_JOINTS.get(name, "|")).alias(name)
        return F.to_json(name).alias(name) if kind.startswith(("array", "struct", "map")) else F.col(name)

    return df.select(*[flat(n, k) for n, k in df.dtypes])


def write_csv(df: DataFrame, path: str) -> None:
    csv_columns(df).write.mode("overwrite").option("header", True).csv(path)


def notation_sequences(units: DataFrame) -> DataFrame:
    """document_id and its units' notations in order, one space apart."""
    ordered = F.array_sort(F.collect_list(F.struct("sequence_index", "final_notation")))
    return units.groupBy("document_id").agg(F.array_join(F.transform(ordered, lambda x: x["final_notation"]), " ").alias("sequence"))


def write_notation(units: DataFrame, path: str) -> None:
    own = notation_sequences(units)
    own.select(F.concat_ws("\t", F.col("document_id").cast("string"), "sequence").alias("value")).write.mode("overwrite").text(path)


def nested_documents(docs: DataFrame, units: DataFrame) -> DataFrame:
    """Documents with their units in one array, for the JSONL contract only."""
    own = units.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("sequence_index", *[c for c in units.columns if c not in ("document_id", "sequence_index")]))).alias("units"))
    return docs.join(own, "document_id", "left")


def markdown_report(row: DataFrame, title: str) -> str:
    """Bullets of a one-row table; floats with four decimals."""
    found = row.first().asDict()
    lines = [f"- {k}: {v:.4f}" if isinstance(v, float) else f"- {k}: {v}" for k, v in found.items()]
    return "\n".join([f"# {title}", "", *lines, ""])
