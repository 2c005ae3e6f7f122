"""Contracts of the tables: what a row must hold, as a column of violations, and as JSON Schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lexicon import CERTAINTY_SYMBOLS, EMOTIONS, FUNCTIONS, STANCE_SYMBOLS
from .notation import strings

RELATION_TYPES = "ANS SUP EXPL ELAB EXMP ANLG CONTR REFUT RISK SOLV SEQ SUM CALL CAUSE COND".split()
METHODS = "none heuristic llm adjudicated synthetic derived manual".split()


def _violations(**rules: Column) -> Column:
    """Names of the rules that hold; a rule that cannot be told does not."""
    return F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules.items()]), lambda x: x.isNotNull())


def _empty(name: str) -> Column:
    return F.coalesce(F.length(name), F.lit(0)) == 0


def unit_violations() -> Column:
    """Of a labelled unit."""
    f, p = F.col("functions"), F.col("primary_function")
    return _violations(
        empty_id=_empty("unit_id"),
        empty_text=_empty("text"),
        negative_index=F.col("sequence_index") < 0,
        no_functions=F.coalesce(F.size(f), F.lit(0)) <= 0,
        repeated_functions=F.size(F.array_distinct(f)) < F.size(f),
        unknown_function=F.size(F.array_except(f, strings(*FUNCTIONS))) > 0,
        n_not_alone=F.array_contains(f, "N") & (F.size(f) > 1),
        primary_not_in_functions=~F.array_contains(f, p),
        primary_in_secondary=F.array_contains("secondary_functions", p),
        unknown_certainty=~F.col("certainty").isin(*CERTAINTY_SYMBOLS),
        unknown_stance=~F.col("stance").isin(*STANCE_SYMBOLS),
        unknown_emotion=~F.col("emotion_expressed").isin(*EMOTIONS),
        intensity_out_of_range=~F.col("emotion_intensity").between(0, 3),
        confidence_out_of_range=~F.col("confidence").between(0, 1),
    )


def relation_violations() -> Column:
    return _violations(
        empty_id=_empty("relation_id"),
        same_ends=F.col("source_unit_id") == F.col("target_unit_id"),
        unknown_type=~F.col("relation_type").isin(*RELATION_TYPES),
        confidence_out_of_range=~F.col("confidence").between(0, 1),
    )


def chain_violations() -> Column:
    return _violations(
        empty_id=_empty("chain_id"),
        start_not_in_units=~F.array_contains("unit_ids", F.col("start_unit_id")),
        end_not_in_units=~F.array_contains("unit_ids", F.col("end_unit_id")),
        score_out_of_range=~F.col("score").between(0, 1),
    )


def metric_violations(df: DataFrame) -> Column:
    """Rates of a one-row table that leave [0, 1]; they are reported and not clipped."""
    return _violations(**{f"{n}_out_of_range": ~F.col(n).between(0, 1) for n, k in df.dtypes if k == "double" and n != "emotion_intensity_mae"})


def split_by_contract(df: DataFrame, violations: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the contract, and the others with their ``violations``."""
    marked = df.withColumn("violations", violations)
    return marked.where(F.size("violations") == 0).drop("violations"), marked.where(F.size("violations") > 0)


def unknown_fields(record: Column, allowed: list[str]) -> Column:
    """Fields of a JSON object outside an allowed list, which a schema would drop unseen."""
    return F.array_except(F.coalesce(F.json_object_keys(record), strings()), strings(*allowed))


def json_schema(kind: T.DataType) -> dict:
    """JSON Schema of a Spark type; objects allow no other fields."""
    if isinstance(kind, T.StructType):
        return {"type": "object", "additionalProperties": False, "properties": {f.name: json_schema(f.dataType) for f in kind.fields}, "required": [f.name for f in kind.fields if not f.nullable]}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": json_schema(kind.elementType)}
    if isinstance(kind, T.MapType):
        return {"type": "object", "additionalProperties": json_schema(kind.valueType)}
    names = {T.BooleanType: "boolean", T.IntegerType: "integer", T.LongType: "integer", T.ShortType: "integer", T.DoubleType: "number", T.FloatType: "number"}
    return {"type": names.get(type(kind), "string")}


def mismatch(kind: T.DataType, value: object, at: str = "$") -> str | None:
    """What is wrong with a parsed JSON value by the JSON Schema of a type, with its place, or None.

    Objects may leave out nullable fields and hold no others; a whole number is a
    number, a truth value is none.
    """
    if isinstance(kind, T.StructType):
        if not isinstance(value, dict):
            return f"{at}: not an object"
        if more := sorted(set(value) - set(kind.names)):
            return f"{at}: unknown field {more[0]}"
        for f in kind.fields:
            if value.get(f.name) is None:
                if not f.nullable:
                    return f"{at}.{f.name}: missing"
            elif wrong := mismatch(f.dataType, value[f.name], f"{at}.{f.name}"):
                return wrong
        return None
    if isinstance(kind, T.ArrayType):
        if not isinstance(value, list):
            return f"{at}: not an array"
        return next((w for i, x in enumerate(value) if (w := mismatch(kind.elementType, x, f"{at}[{i}]"))), None)
    if isinstance(kind, T.MapType):
        if not isinstance(value, dict):
            return f"{at}: not an object"
        return next((w for k, x in value.items() if (w := mismatch(kind.valueType, x, f"{at}.{k}"))), None)
    name = json_schema(kind)["type"]
    fits = {"boolean": bool, "integer": int, "number": (int, float), "string": str}[name]
    return None if isinstance(value, fits) and (name == "boolean" or not isinstance(value, bool)) else f"{at}: not a {name}"
