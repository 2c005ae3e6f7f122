"""Documents rewritten for filling in the middle: prefix, suffix and middle, cut at whole units.

A unit is a word with the white space before it, or what white space is left.
Units are rows: each document's matches are exploded with their ordinals, their
lengths summed along the document, and the two cuts look up the sum at their
ordinal. What comes back to the document is two offsets, so texts are cut by
position alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, REWRITTEN_PERCENT, SUFFIX_FIRST_PERCENT = 42, 50, 80
#: Copies of one row that are written from one row at a time.
RUN = 10_000


def _draw(doc_id: Column, k: int, seed: int) -> Column:
    """The k-th group of eight hexadecimal digits of the digest of seed and id, as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def _form(doc_id: Column, text: Column, seed: int) -> Column:
    marked = F.lit(False)
    for m in (PREFIX, SUFFIX, MIDDLE):
        marked |= F.contains(text, F.lit(m))
    plain = (text == "") | marked | (_draw(doc_id, 3, seed) % 100 >= REWRITTEN_PERCENT)
    return F.when(plain, "plain").when(_draw(doc_id, 4, seed) % 100 < SUFFIX_FIRST_PERCENT, "spm").otherwise("psm")


def unit_ends(rows: DataFrame) -> DataFrame:
    """key, key2, ordinal and the offset behind each unit of rows(key, key2, text, last), up to the unit ``last``."""
    units = rows.select("key", "key2", F.posexplode(F.slice(F.regexp_extract_all("text", F.lit(UNIT), 0), F.lit(1), F.col("last"))).alias("pos", "unit"))
    along = Window.partitionBy("key", "key2").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return units.select("key", "key2", (F.col("pos") + 1).alias("ordinal"), F.length("unit").cast("long").alias("size")).select("key", "key2", "ordinal", F.sum("size").over(along).alias("end"))


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made of."""
    psm = F.regexp_replace(output, f"(?s)^{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*)$", "$1$3$2")
    spm = F.regexp_replace(output, f"(?s)^{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*)$", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_middle(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output for every row of docs(doc_id, text).

    Documents that stay plain move nowhere. Texts of the others are dealt once by
    two hashes of id and text; their units are exploded, summed and looked up in
    the partitions where the texts lie, and never shuffled. Rows that repeat both
    id and text are counted before and written out again at the end.

    A null text is empty, and a null id is drawn for as an empty one; texts that
    hold a marker stay plain. Long texts are cut whole: one task holds a text
    and sorts its units, which spill. Other columns are ignored, and an empty
    table gives an empty one.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    formed = texts.select("doc_id", "text", _form(F.col("doc_id"), F.col("text"), seed).alias("form"), F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"))
    none = F.lit(None).cast("long")
    plain = formed.where("form = 'plain'").select("doc_id", "n", "form", none.alias("prefix_chars"), none.alias("middle_chars"), F.col("text").alias("output"))

    keyed = formed.where("form <> 'plain'").select(F.xxhash64("doc_id", "text").alias("key"), F.xxhash64(F.lit("other"), "text", "doc_id").alias("key2"), "*")
    # Both uses below read all of these columns, so that they share one exchange.
    rows = keyed.groupBy("key", "key2").agg(*[F.first(c).alias(c) for c in ("doc_id", "text", "form", "n")], F.count(F.lit(1)).alias("copies")).where("copies > 0 AND form <> 'plain'")
    a, b = (_draw(F.col("doc_id"), k, seed) % (F.col("n") + 1) for k in (1, 2))
    cuts = rows.select("*", F.least(a, b).alias("first"), F.greatest(a, b).alias("last"))
    ends = unit_ends(cuts.select("key", "key2", "text", F.col("last").cast("int").alias("last")))
    # The ordinal is no key of the join: it would deal all units anew. Units have no bound, so they are never broadcast.
    at = F.expr("c.key = e.key AND c.key2 = e.key2 AND (e.ordinal = c.first OR e.ordinal = c.last)")
    met = cuts.alias("c").join(ends.alias("e").hint("merge"), at, "left").select("c.*", "e.ordinal", "e.end")
    offset = lambda cut: F.coalesce(F.max(F.when(F.col("ordinal") == F.col(cut), F.col("end"))), F.lit(0)).alias(f"{cut}_end")
    whole = met.groupBy("key", "key2").agg(*[F.first(c).alias(c) for c in ("doc_id", "text", "form", "n", "copies")], offset("first"), offset("last"))
    text, p, m = F.col("text"), F.col("first_end").cast("int"), F.col("last_end").cast("int")
    prefix, middle, suffix = F.substr(text, F.lit(1), p), F.substr(text, p + 1, m - p), F.substr(text, m + 1)
    output = F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)).otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    made = whole.select("copies", "doc_id", "n", "form", p.cast("long").alias("prefix_chars"), (m - p).cast("long").alias("middle_chars"), output.alias("output"))
    runs = made.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(RUN).cast("long"))).alias("begin"))
    again = runs.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(RUN).cast("long"), F.col("copies") - F.col("begin"))))).select(*plain.columns)
    return plain.unionByName(again)
