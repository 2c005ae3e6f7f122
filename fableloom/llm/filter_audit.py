"""How quality filters overlap: what each removes in every order of application.

Built-in expressions give each document a mask of the five filters that it
fails. Which texts repeat is known from the smallest doc_id of each text, a sum
by the text's digest. Masks are counted into 32 cells a part, and all orders are
read off those cells: no document is looked at again for any of the 120.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: The filter that looks at other documents; the others look at one text.
COPY = 1 << FILTERS.index("E")
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 200, 50, 2
WORD, MARK = r"[^\x20\x09-\x0D]+", r"[#$%&*|]"


def _text_mask(text: Column, words: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    n, capitals = F.size(words), F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = (
        n < MIN_WORDS,
        100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * n,
        100 * capitals.cast("long") > MAX_CAPITAL_PERCENT * F.length(text).cast("long"),
        F.regexp_like(text, F.lit(MARK)),
    )
    mask = F.lit(0)
    for i, f in enumerate(fails):
        mask = mask + F.when(f, 1 << i).otherwise(0)
    return mask


def failure_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good and toxic: documents of each part that fail exactly the filters of the mask, and those of them so labelled.

    Texts enter the shuffles as digests only. Copies are first counted in the
    tasks that read them, so a text of a third of all rows is a few rows when
    its smallest id is looked for.
    """
    texts = docs.select("doc_id", F.coalesce("source", F.lit("")).cast("string").alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    split = texts.select("*", F.regexp_extract_all("text", F.lit(WORD), 0).alias("words"))
    slim = split.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), _text_mask(F.col("text"), F.col("words")).alias("mask"))
    marks = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("key"))
        .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"))
    )
    # Rows without an id are dealt by their digest, as they find no label anyway.
    keyed = slim.withColumn("key", F.coalesce("doc_id", F.xxhash64("digest").cast(docs.schema["doc_id"].dataType)))
    found = keyed.join(marks, (keyed["key"] == marks["key"]) & keyed["doc_id"].isNotNull(), "left").drop(marks["key"])
    whole = found.select("key", "doc_id", "part", "digest", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    rows = whole.groupBy(*whole.columns).agg(F.count(F.lit(1)).alias("n"))
    kinds = rows.groupBy("digest", "part", "mask", "good", "toxic", F.col("doc_id").isNull().alias("loose")).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("n_least")
    )
    first = F.min("least").over(Window.partitionBy("digest"))
    n_first = F.when(F.col("loose"), F.col("n")).when(F.col("least") == first, F.col("n_least")).otherwise(F.lit(0))
    parts = kinds.select("part", "mask", "good", "toxic", "n", n_first.alias("n_first"))
    pair = F.array(F.struct("mask", F.col("n_first").alias("n")), F.struct((F.col("mask") + COPY).alias("mask"), (F.col("n") - F.col("n_first")).alias("n")))
    cells = parts.select("part", "good", "toxic", F.inline(pair)).where("n > 0")
    return cells.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def _steps() -> str:
    """Each order and step as JSON: the step's filter and the filters applied before it, as bits."""
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}
    return json.dumps([{"filter_order": o, "step": k + 1, "place": FILTERS.index(f), "bit": bit[f], "before": sum(bit[x] for x in o[:k])} for o in ORDERS for k, f in enumerate(o)])


def orders_of(cells: DataFrame) -> DataFrame:
    """The rows of audit_filters from failure_cells, 600 a part.

    A part's 32 cells are one row. What is left after a set of filters depends on
    the set alone, so 32 sums give every step of every order.
    """
    one = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))

    def left(what: str) -> Column:
        none = lambda s: F.filter("cells", lambda c: c["mask"].bitwiseAND(s) == 0)
        return F.transform(F.sequence(F.lit(0), F.lit(2 ** len(FILTERS) - 1)), lambda s: F.aggregate(none(s), F.lit(0).cast("long"), lambda a, c: a + c[what]))

    def share(bit: int) -> Column:
        """How often the filter removes a document, summed over the orders: it is first among those that the document fails in an equal share of them."""
        return F.aggregate(F.filter("cells", lambda c: c["mask"].bitwiseAND(F.lit(bit)) > 0), F.lit(0).cast("long"), lambda a, c: a + c["n"] * (len(ORDERS) / F.bit_count(c["mask"])).cast("long"))

    shares = F.array(*[share(1 << i) for i in range(len(FILTERS))])
    summed = one.select("part", left("n").alias("left"), left("good").alias("left_good"), left("toxic").alias("left_toxic"), shares.alias("shares"))
    steps = F.from_json(F.lit(_steps()), "array<struct<filter_order: string, step: int, place: int, bit: int, before: int>>")
    every = summed.select("*", F.inline(steps))
    before, bit = F.col("before"), F.col("bit")
    after = before + bit
    lost = lambda c: F.get(c, before) - F.get(c, after)
    everything = 2 ** len(FILTERS) - 1
    failing = F.get("left", F.lit(0)) - F.get("left", bit)
    return every.select(
        "part",
        "filter_order",
        "step",
        F.get("left", after).alias("kept"),
        lost("left").alias("removed"),
        (failing - lost("left")).alias("redundant"),
        (F.get("left", everything - bit) - F.get("left", F.lit(everything))).alias("unique_fails"),
        lost("left_good").alias("good_lost"),
        lost("left_toxic").alias("toxic_lost"),
        F.get("shares", F.col("place")).alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and what that step keeps, removes and loses, for each part of docs(doc_id, text, source) and all 120 orders of five filters.

    A null text is empty and a null source the empty part. A row without an id
    is no copy of another and makes none; rows that repeat an id with its text
    are copies of a smaller id only. Of repeated labels of an id one that says 1
    is enough; other columns and labels of unknown ids are ignored. Long texts
    are looked at whole. An empty table has no parts and so no rows.
    """
    return orders_of(failure_cells(docs, labels))
