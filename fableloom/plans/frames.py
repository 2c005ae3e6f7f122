"""Units, votes and gold derived from the driver tables, each with the same thing in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.lexicon import FUNCTIONS, MAX_UNIT_CHARS
from ..functions.notation import strings
from ..operators.segment import segment_texts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df over all cores: a table that is read in fewer pieces than there are cores is dealt out first, a larger one is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents")).select(F.col("doc_id").alias("document_id"), "text", "lang")


def units(spark: SparkSession, sf_dir: str, **how: int | bool) -> DataFrame:
    return segment_texts(documents(spark, sf_dir), keep=("lang",), **how)


def chosen(**tests: Column) -> Column:
    """The names whose test holds, in the order given."""
    return F.filter(F.array(*[F.when(t, F.lit(n)) for n, t in tests.items()]), lambda x: x.isNotNull())


def labelled_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One unit for each labelled document, its fields made from labels and id: wide coverage of codes, conflicts and repairs.

    The whole text is the unit's; eight ids in a row are one document, so units have neighbours.
    """
    d, k = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id"), F.col("doc_id")
    functions = chosen(
        K=F.col("quality") == 1, A=k % 3 == 0, X=F.col("toxic") == 1, D=k % 5 == 0, R=k % 7 == 0, N=k % 2 == 0, V=F.col("lang") == "es", M=k % 4 == 1, Z=(k % 6 == 0) & (F.col("lang") != "en")
    )
    pick = lambda m, *v: F.get(strings(*v), (k % m).cast("int"))
    return d.select(
        k.alias("k"), F.floor(k / 8).alias("document_id"), (k % 8).cast("int").alias("sequence_index"), F.concat(F.lit("unit"), k.cast("string")).alias("unit_id"), "text", F.col("text").alias("normalized_text"),
        F.when(F.size(functions) > 0, functions).otherwise(strings("N")).alias("functions"),
        pick(3, "A", "X", "N").alias("primary_function"), strings("D", "A").alias("secondary_functions"), pick(4, "none", "strong", "tentative", "uncertain").alias("certainty"),
        pick(3, "N", "A", "M").alias("emotion_expressed"), (k % 4).cast("int").alias("emotion_intensity"), F.when(k % 3 == 1, strings("A")).otherwise(strings()).alias("emotions_mentioned"),
        pick(4, "positive", "negative", "mixed", "neutral").alias("stance"), (F.lit(0.5) + (k % 50) / 100).alias("confidence"), F.lit(False).alias("needs_review"), strings().alias("review_reasons"), F.lit("").alias("final_notation"),
    )


LABELLED_SQL = """
lu0 AS (
  SELECT doc_id AS k, text, list_filter([
    CASE WHEN quality = 1 THEN 'K' END, CASE WHEN doc_id % 3 = 0 THEN 'A' END, CASE WHEN toxic = 1 THEN 'X' END, CASE WHEN doc_id % 5 = 0 THEN 'D' END,
    CASE WHEN doc_id % 7 = 0 THEN 'R' END, CASE WHEN doc_id % 2 = 0 THEN 'N' END, CASE WHEN lang = 'es' THEN 'V' END, CASE WHEN doc_id % 4 = 1 THEN 'M' END,
    CASE WHEN doc_id % 6 = 0 AND lang <> 'en' THEN 'Z' END], lambda x: x IS NOT NULL) AS f
  FROM labels JOIN documents USING (doc_id)),
lu AS (
  SELECT k, k // 8 AS document_id, 'unit' || k AS unit_id, text, CASE WHEN len(f) = 0 THEN ['N'] ELSE f END AS functions, ['A', 'X', 'N'][k % 3 + 1] AS primary_function,
    ['none', 'strong', 'tentative', 'uncertain'][k % 4 + 1] AS certainty, ['N', 'A', 'M'][k % 3 + 1] AS emotion_expressed, k % 4 AS emotion_intensity,
    CASE WHEN k % 3 = 1 THEN ['A'] ELSE CAST([] AS VARCHAR[]) END AS emotions_mentioned, ['positive', 'negative', 'mixed', 'neutral'][k % 4 + 1] AS stance, 0.5 + (k % 50) / 100 AS confidence
  FROM lu0)"""

#: The order of function codes, to sort by.
TAXONOMY_SQL = "['A','K','O','F','Y','D','Q','P','R','E','H','G','C','B','X','T','M','L','Z','S','I','U','V','N']"
ORDERED = f"list_filter({TAXONOMY_SQL}, lambda c: list_contains(%s, c))"
SYMBOLS_SQL = "CASE certainty WHEN 'strong' THEN '!' WHEN 'tentative' THEN '~' WHEN 'uncertain' THEN '?' ELSE '' END || '_' || emotion_expressed || emotion_intensity || '{' || CASE stance WHEN 'positive' THEN '+' WHEN 'negative' THEN '-' WHEN 'mixed' THEN '±' ELSE '0' END || '}'"


def notation_sql(codes: str) -> str:
    return f"(CASE WHEN len({codes}) > 1 THEN '(' || array_to_string({codes}, '+') || ')' ELSE array_to_string({codes}, '+') END || {SYMBOLS_SQL})"


def event_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user as units in order of time; the event type makes the function."""
    e = table(spark, sf_dir, "events")
    kinds = F.create_map(*[F.lit(x) for kv in EVENT_FUNCTIONS.items() for x in kv])
    own = e.withColumn("sequence_index", (F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1).cast("int"))
    code = kinds[F.col("event_type")]
    return own.select(
        F.col("user_id").alias("document_id"), "sequence_index", F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("unit_id"), F.col("event_type").alias("text"), F.col("event_type").alias("normalized_text"),
        F.array(code).alias("functions"), F.concat(code, F.lit("_N0{0}")).alias("final_notation"),
    )


#: Codes that turn up along a document by its id and the unit's number; every third unit has a second one.
CODES = [c for c in FUNCTIONS if c != "N"]


def coded_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of all documents with functions by place and now and then a marker at the end of a text, so that every rule and pattern finds what it looks for."""
    own = units(spark, sf_dir)
    n = F.col("sequence_index").cast("long")
    at = F.col("document_id") * 7 + n * n * 5 + F.floor(n / 3) * 11
    code = lambda k: F.get(strings(*CODES), F.pmod(at + k, F.lit(len(CODES))).cast("int"))
    functions = F.when(F.col("sequence_index") % 3 == 0, F.array(code(0), code(8))).otherwise(F.array(code(0)))
    said = F.when((F.col("document_id") + n) % 11 == 0, " porque sí").when((F.col("document_id") + n) % 13 == 0, " si llueve").otherwise("")
    own = own.withColumn("text", F.concat("text", said))
    return own.select("document_id", "sequence_index", "unit_id", "text", F.col("text").alias("normalized_text"), functions.alias("functions"), F.concat(F.array_join(functions, "+"), F.lit("_N0{0}")).alias("final_notation"))


EVENT_FUNCTIONS = {"view": "A", "click": "D", "signup": "Y", "purchase": "Z", "error": "X"}
EVENTS_SQL = """
eu AS (
  SELECT user_id AS document_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS sequence_index, 'e' || event_id AS unit_id, event_type AS text,
    CASE event_type WHEN 'view' THEN 'A' WHEN 'click' THEN 'D' WHEN 'signup' THEN 'Y' WHEN 'purchase' THEN 'Z' ELSE 'X' END AS f
  FROM events)"""

_CLEAN = "list_filter(list_transform(string_split(regexp_replace({t}, {p}, {r}, 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '')"
_SENTENCE = _CLEAN.format(t="text", p=r"'([.!?;:])\s+([A-ZÁÉÍÓÚÜÑ¿¡0-9])'", r=r"'\1' || chr(1) || '\2'")
_SOFT = _CLEAN.format(t="p", p=r"'(?i)\s+((?:pero|aunque|porque|entonces|sin embargo|por eso|además|luego|después)\b)'", r=r"chr(1) || '\1'")
_COMMA = _CLEAN.format(t="p", p=r"',\s+'", r="',' || chr(1)")
_PACK = f"string_split(list_reduce(string_split(p, ' '), lambda a, w: CASE WHEN length(string_split(a, chr(1))[-1]) + 1 + length(w) <= {MAX_UNIT_CHARS} THEN a || ' ' || w ELSE a || chr(1) || w END), chr(1))"
_FITS = f"len({{s}}) > 1 AND list_max(list_transform({{s}}, lambda x: length(x))) <= {MAX_UNIT_CHARS}"


def pieces_sql(source: str, keys: str) -> str:
    """CTEs that cut ``text`` of a source into pieces: keys, seq (0-based) and text, as table pieces."""
    refined = f"CASE WHEN length(p) <= {MAX_UNIT_CHARS} THEN [p] WHEN {_FITS.format(s='soft')} THEN soft WHEN {_FITS.format(s='comma')} THEN comma ELSE {_PACK} END"
    return f"""
sentences AS (SELECT {keys}, unnest(s) AS p, generate_subscripts(s, 1) AS i FROM (SELECT {keys}, {_SENTENCE} AS s FROM (SELECT {keys}, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM {source}))),
refined AS (SELECT {keys}, i, {refined} AS r FROM (SELECT *, {_SOFT} AS soft, {_COMMA} AS comma FROM sentences)),
pieces AS (SELECT {keys}, row_number() OVER (PARTITION BY {keys} ORDER BY i, j) - 1 AS seq, text FROM (SELECT {keys}, i, unnest(r) AS text, generate_subscripts(r, 1) AS j FROM refined))"""


UNITS_SQL = pieces_sql("(SELECT doc_id AS document_id, lang, text FROM documents)", "document_id, lang")
_CODES_SQL = "[" + ", ".join(f"'{c}'" for c in CODES) + "]"
_PLACE = "document_id * 7 + seq * seq * 5 + (seq // 3) * 11"
CODED_SQL = UNITS_SQL + f""",
cu AS (
  SELECT document_id, seq AS sequence_index, document_id || '_u' || CASE WHEN seq > 99999 THEN CAST(seq AS VARCHAR) ELSE lpad(CAST(seq AS VARCHAR), 5, '0') END AS unit_id, text, lower(text || ' ' || text) AS low,
    CASE WHEN seq % 3 = 0 THEN [{_CODES_SQL}[({_PLACE}) % {len(CODES)} + 1], {_CODES_SQL}[({_PLACE} + 8) % {len(CODES)} + 1]] ELSE [{_CODES_SQL}[({_PLACE}) % {len(CODES)} + 1]] END AS f
  FROM (SELECT document_id, seq, text || CASE WHEN (document_id + seq) % 11 = 0 THEN ' porque sí' WHEN (document_id + seq) % 13 = 0 THEN ' si llueve' ELSE '' END AS text FROM pieces))"""
#: Folded text for RE2, whose word boundaries know ASCII only; the one other letter of the corpus becomes a letter of the same length.
FOLD_SQL = "replace(strip_accents(lower(text)), 'ß', 'q')"
