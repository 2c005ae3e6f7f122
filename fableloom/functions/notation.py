"""Function codes and the compact notation, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import CERTAINTY_SYMBOLS, FUNCTIONS, STANCE_SYMBOLS


def strings(*values: str) -> Column:
    """An array of constants; an empty one is an array of strings too."""
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def normalize_codes(codes: Column) -> Column:
    """Each code once, in taxonomy order, unknown codes after them as they came; null is empty."""
    own = F.coalesce(F.array_distinct(codes), strings())
    return F.concat(F.filter(strings(*FUNCTIONS), lambda c: F.array_contains(own, c)), F.array_except(own, strings(*FUNCTIONS)))


def _symbol(value: Column, symbols: dict[str, str], what: str) -> Column:
    out = F.raise_error(F.concat(F.lit(f"{what}: "), F.coalesce(value, F.lit("null")))).cast("string")
    for k, v in symbols.items():
        out = F.when(value == k, F.lit(v)).otherwise(out)
    return out


def compile_notation(functions: Column, certainty: Column, emotion: Column, intensity: Column, stance: Column, always_parentheses: bool = False) -> Column:
    """``(F+F)!_E2{+}``: codes in order, certainty, emotion with intensity, stance; fails on values that have no symbol."""
    codes = normalize_codes(functions)
    joined = F.array_join(codes, "+")
    bracketed = F.concat(F.lit("("), joined, F.lit(")"))
    level = F.when(intensity.between(0, 3), intensity.cast("string")).otherwise(F.raise_error(F.lit("intensity outside 0 to 3")).cast("string"))
    head = bracketed if always_parentheses else F.when(F.size(codes) > 1, bracketed).otherwise(joined)
    return F.concat(head, _symbol(certainty, CERTAINTY_SYMBOLS, "certainty"), F.lit("_"), emotion, level, F.lit("{"), _symbol(stance, STANCE_SYMBOLS, "stance"), F.lit("}"))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 1 for two empty ones."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def same_set(a: Column, b: Column) -> Column:
    return (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)


def group_labels(functions: Column, groups: tuple[tuple[str, ...], ...]) -> Column:
    """All codes of the groups that the functions touch, sorted."""
    every = F.array(*[strings(*g) for g in groups])
    return F.array_sort(F.array_distinct(F.flatten(F.filter(every, lambda g: F.arrays_overlap(g, functions)))))
