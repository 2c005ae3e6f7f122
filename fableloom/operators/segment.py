"""From texts and timed segments to ordered units."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from ..functions.lexicon import COMMA_BOUNDARY, MAX_UNIT_CHARS, SENTENCE_BOUNDARY, SOFT_BOUNDARY
from ..functions.notation import strings
from ..functions.text import normalized

FLAGS = "array<struct<rule_id:string,severity:string,message:string,field:string>>"


def in_order() -> WindowSpec:
    """The order of units in their document."""
    return Window.partitionBy("document_id").orderBy("sequence_index")


#: Units of a document that one task sorts at most, and the columns that with_halo adds.
CUT_UNITS, CUT, OWN = 100_000, "_cut", "_own"


def in_cut() -> WindowSpec:
    """The order of units in their cut of a document."""
    return Window.partitionBy("document_id", CUT).orderBy("sequence_index")


def with_halo(units: DataFrame, before: int = 0, after: int = 0, size: int = CUT_UNITS) -> DataFrame:
    """units in cuts of ``size`` sequence numbers, each cut with the ``before`` and ``after`` units around it.

    A window over in_cut() then sees what one over the whole document would see
    within that reach, while a document of any length is spread over many tasks.
    Units at a border come twice; OWN is true for the one that its cut owns, and
    rows made from others must be left out. Sequence numbers of a document run
    without gaps, as segmentation gives them; documents shorter than a cut are one.
    """
    if max(before, after) > size:
        raise ValueError("a cut must be as long as what is seen around it")
    at, own = F.col("sequence_index"), F.floor(F.col("sequence_index") / size)
    into = F.when(at % size >= size - before, F.when((own > 0) & (at % size < after), F.array(own - 1, own, own + 1)).otherwise(F.array(own, own + 1)))
    into = into.when((own > 0) & (at % size < after), F.array(own - 1, own)).otherwise(F.array(own))
    return units.withColumn(CUT, F.explode(into)).withColumn(OWN, F.col(CUT) == own)


def with_neighbours(units: DataFrame, before: int, after: int, columns: Callable[[WindowSpec], dict[str, Column]], size: int = CUT_UNITS) -> DataFrame:
    """units with the columns that are made over the order of units, seeing ``before`` and ``after`` units around each; see with_halo."""
    return with_halo(units, before, after, size).withColumns(columns(in_cut())).where(OWN).drop(CUT, OWN)


def around(order: WindowSpec, *steps: int) -> Column:
    """The texts so many units before (or, below 0, after) a unit, as far as there are any."""
    return F.array_compact(F.array(*[(F.lag if n > 0 else F.lead)("text", abs(n)).over(order) for n in steps]))


def split_clean(text: Column, pattern: str) -> Column:
    """Parts between matches, trimmed, without empty ones."""
    # F.trim itself would be given the part's number too, and strip its digits.
    return F.filter(F.transform(F.split(text, pattern), lambda p: F.trim(p)), lambda p: p != "")


def pack_words(piece: Column, limit: int) -> Column:
    """Words gathered greedily into pieces of at most ``limit`` characters; a longer word stands alone."""
    start = F.struct(strings().alias("done"), F.lit("").alias("now"))

    def add(state: Column, word: Column) -> Column:
        done, now = state["done"], state["now"]
        fits = F.length(now) + 1 + F.length(word) <= limit
        grown = F.when(now == "", word).when(fits, F.concat_ws(" ", now, word)).otherwise(word)
        return F.struct(F.when((now == "") | fits, done).otherwise(F.concat(done, F.array(now))).alias("done"), grown.alias("now"))

    return F.aggregate(F.split(piece, " "), start, add, lambda s: F.when(s["now"] == "", s["done"]).otherwise(F.concat(s["done"], F.array(s["now"]))))


def pieces_of(text: Column, limit: int = MAX_UNIT_CHARS) -> Column:
    """Sentences of a normalised text; long ones at connectives, else at commas, else word by word."""

    def refine(p: Column) -> Column:
        def usable(parts: Column) -> Column:
            return (F.size(parts) > 1) & (F.array_max(F.transform(parts, F.length)) <= limit)

        soft, comma = split_clean(p, SOFT_BOUNDARY), split_clean(p, COMMA_BOUNDARY)
        return F.when(F.length(p) <= limit, F.array(p)).when(usable(soft), soft).when(usable(comma), comma).otherwise(pack_words(p, limit))

    return F.flatten(F.transform(split_clean(text, SENTENCE_BOUNDARY), refine))


def running_sums(values: Column, block: int = 256) -> tuple[Column, Callable[[Column], Column]]:
    """Blocks of an array of numbers, and a function from them to the sum of all values before each, which costs no square of a long array's length."""
    n = F.greatest(F.lit(0), ((F.size(values) - 1) / block).cast("int"))
    blocks = F.transform(F.sequence(F.lit(0), n), lambda i: F.slice(values, i * block + 1, block))

    def sums(numbers: Column, first: Column) -> Column:
        return F.aggregate(numbers, F.array(first), lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + x)))

    def finish(cut: Column) -> Column:
        totals = F.transform(cut, lambda b: F.aggregate(b, F.lit(0), lambda s, x: s + x))
        return F.flatten(F.zip_with(cut, F.slice(sums(totals, F.lit(0)), 1, F.size(cut)), lambda b, s: F.slice(sums(b, s), 1, F.size(b))))

    return blocks, finish


def segment_texts(docs: DataFrame, limit: int = MAX_UNIT_CHARS, keep: tuple[str, ...] = (), context: int = 0, offsets: bool = True) -> DataFrame:
    """document_id, sequence_index, text, char_start, char_end, unit_id, neighbours and unit_count of the units of docs(document_id, text).

    Offsets index the normalised text, in which units are one space apart. Null
    and empty texts give no units. keep: columns of docs to carry along. All of a
    document's units stand in one array before they are rows, so nothing is shuffled.
    context: how many texts on either side to give as context_before and context_after.
    Without offsets there are no char_start and char_end.
    """
    cut = docs.select("document_id", *keep, pieces_of(normalized(F.col("text")), limit).alias("_pieces"))
    if offsets:
        blocks, finish = running_sums(F.transform("_pieces", lambda p: F.length(p) + 1))
        cut = cut.withColumn("_blocks", blocks).withColumn("_starts", finish(F.col("_blocks")))
    # The count goes with each piece: a column beside them would be worked out after the rows are made, each of which would carry the whole array until then.
    total = F.array_repeat(F.size("_pieces"), F.size("_pieces"))
    beside = {}
    if context:
        reach, own = F.lit(context), F.col("_pieces")
        beside["context_before"] = F.transform(own, lambda _, i: F.slice(own, F.greatest(F.lit(1), i + 1 - reach), F.least(i, reach)))
        beside["context_after"] = F.transform(own, lambda _, i: F.slice(own, i + 2, reach))
    units = cut.select("document_id", *keep, F.posexplode(F.arrays_zip("_pieces", *(["_starts"] if offsets else []), total.alias("_total"), *[c.alias(n) for n, c in beside.items()])).alias("sequence_index", "u"))
    units = units.withColumn("unit_count", F.col("u._total"))
    name = lambda i: unit_name(F.col("document_id"), i)
    at = F.col("sequence_index")
    places = [F.col("u._starts").alias("char_start"), (F.col("u._starts") + F.length("u._pieces")).alias("char_end")] if offsets else []
    return units.select(
        "document_id", *keep, "sequence_index", F.col("u._pieces").alias("text"), *places,
        name(at).alias("unit_id"), F.when(at > 0, name(at - 1)).alias("previous_unit_id"), F.when(at + 1 < F.col("unit_count"), name(at + 1)).alias("next_unit_id"), "unit_count",
        *[F.col(f"u.{n}").alias(n) for n in beside],
    )


def unit_name(document_id: Column, index: Column) -> Column:
    """Document and index, the latter of five digits at least."""
    digits = index.cast("string")
    return F.concat(document_id.cast("string"), F.lit("_u"), F.when(F.length(digits) > 5, digits).otherwise(F.lpad(digits, 5, "0")))


def to_ms(ms: Column, seconds: Column, bare: Column) -> Column:
    """Milliseconds from whichever is given; a bare number below 10000 counts as seconds."""
    return F.coalesce(F.bround(ms), F.bround(seconds * 1000), F.when(bare < 10000, F.bround(bare * 1000)).otherwise(F.bround(bare))).cast("long")


def segment_timed(segments: DataFrame, limit: int = MAX_UNIT_CHARS, size: int = CUT_UNITS) -> DataFrame:
    """Units of segments(document_id, segment_index, text, start_ms, end_ms), with times shared out evenly in a split segment."""
    cut = segments.select("document_id", "segment_index", "start_ms", "end_ms", pieces_of(normalized(F.col("text")), limit).alias("pieces"))
    own = cut.select("document_id", "segment_index", "start_ms", "end_ms", F.size("pieces").alias("total"), F.posexplode("pieces").alias("piece", "text"))
    split = (F.col("total") > 1) & F.col("start_ms").isNotNull() & F.col("end_ms").isNotNull()
    at = lambda i: F.when(split, F.col("start_ms") + F.bround((F.col("end_ms") - F.col("start_ms")) * i / F.col("total")).cast("long"))
    units = numbered(own, size).select(
        "document_id",
        "sequence_index",
        "text",
        F.coalesce(at(F.col("piece")), "start_ms").alias("start_ms"),
        F.coalesce(at(F.col("piece") + 1), "end_ms").alias("end_ms"),
        (F.col("total") > 1).alias("approximate_timing"),
        "unit_count",
    )
    return link_units(units)


def numbered(pieces: DataFrame, size: int = CUT_UNITS) -> DataFrame:
    """pieces(document_id, segment_index, piece, ...) with sequence_index, their number in the document, and unit_count.

    In two steps: pieces are counted in cuts of ``size`` segment numbers, the
    counts of a document's cuts are summed along it, and within a cut pieces are
    numbered from there. So no task sorts a long document whole.
    """
    cut = pieces.withColumn(CUT, F.floor(F.col("segment_index") / size))
    along = Window.partitionBy("document_id").orderBy(CUT)
    sums = cut.groupBy("document_id", CUT).agg(F.count(F.lit(1)).alias("_n"))
    sums = sums.select("document_id", CUT, (F.sum("_n").over(along) - F.col("_n")).alias("_first"), F.sum("_n").over(Window.partitionBy("document_id")).cast("int").alias("unit_count"))
    place = F.row_number().over(Window.partitionBy("document_id", CUT).orderBy("segment_index", "piece")) - 1
    return cut.withColumn("_place", place).join(sums, ["document_id", CUT]).withColumn("sequence_index", (F.col("_first") + F.col("_place")).cast("int")).drop(CUT, "_first", "_place")


def link_units(units: DataFrame) -> DataFrame:
    """Adds unit_id, previous_unit_id and next_unit_id to units(document_id, sequence_index, unit_count); as names follow from numbers, nothing is moved."""
    name, at = (lambda i: unit_name(F.col("document_id"), i)), F.col("sequence_index")
    return units.withColumns({"unit_id": name(at), "previous_unit_id": F.when(at > 0, name(at - 1)), "next_unit_id": F.when(at + 1 < F.col("unit_count"), name(at + 1))})


def with_defaults(units: DataFrame) -> DataFrame:
    """Adds the fields of a unit that nothing has classified yet."""
    constants = {
        "functions": strings("N"), "primary_function": F.lit("N"), "secondary_functions": strings(), "certainty": F.lit("none"), "emotion_expressed": F.lit("N"),
        "emotion_intensity": F.lit(0), "emotions_mentioned": strings(), "stance": F.lit("neutral"), "confidence": F.lit(0.0), "method": F.lit("none"),
        "needs_review": F.lit(False), "review_reasons": strings(), "review_status": F.lit("pending"), "final_notation": F.lit("N_N0{0}"),
    }
    out = units.withColumns({"normalized_text": F.col("text")} | constants)
    if "approximate_timing" in units.columns:
        flag = F.struct(F.lit("approximate_timing").alias("rule_id"), F.lit("info").alias("severity"), F.lit("Times are shared out evenly within a longer segment.").alias("message"), F.lit("start_ms").alias("field"))
        out = out.withColumn("validator_flags", F.when(F.col("approximate_timing"), F.array(flag)).otherwise(F.array().cast(FLAGS)))
    return out
