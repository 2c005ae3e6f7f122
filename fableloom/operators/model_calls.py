"""Structured calls of an outside model over rows, with a table as cache.

The model is any function from a request to a JSON text; hits of the cache never
reach it, and the number of partitions bounds how many calls run at a time.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import lexicon as L
from ..functions.contracts import json_schema, mismatch
from ..functions.notation import normalize_codes, strings
from ..sources.sinks import read_table
from .segment import around, with_neighbours
from .validate import flag, still_relevant

BACKOFF = (2.0, 8.0, 20.0)
#: A committee is a short list.
MAX_REVIEWERS = 100
_RESULT = {"cache_key": T.StringType(), "ok": T.BooleanType(), "attempts": T.IntegerType(), "response": T.StringType(), "error": T.StringType(), "cached": T.BooleanType(), "input_tokens": T.LongType(), "output_tokens": T.LongType()}
RESULT = T.StructType([T.StructField(n, k) for n, k in _RESULT.items()])


class TransientError(Exception):
    """A failure that is worth another attempt."""


def json_payload(text: str) -> dict:
    """The JSON object in a reply, fenced or with words around it."""
    start = text.find("{")
    if start < 0:
        raise ValueError("no JSON object in the reply")
    found, _ = json.JSONDecoder().raw_decode(text[start:])
    return found


@dataclass(frozen=True)
class Profile:
    """Which model is asked and how: all of it goes with every request and so into the key of the cache.

    schema: the type of an answer. Its JSON Schema is part of the request, and an
    answer that does not keep it to the letter is refused.
    """

    name: str
    model: str
    prompt_version: str = L.VERSION
    schema: T.StructType | None = None
    temperature: float | None = None

    def sent(self, request: Column) -> Column:
        """The request (JSON) within what the profile says."""
        parts = {"profile": self.name, "model": self.model, "prompt_version": self.prompt_version, "temperature": self.temperature, "schema": json_schema(self.schema) if self.schema else None}
        head = json.dumps({k: v for k, v in parts.items() if v is not None}, sort_keys=True)
        return F.concat(F.lit(head[:-1] + ', "input": '), request, F.lit("}"))


def profiles_from_config(config: dict, schemas: dict[str, T.StructType] | None = None) -> dict[str, Profile]:
    """Profiles by name from the ``profiles`` part of a configuration; a model without one of its own is ``default_model``. Unknown settings are errors."""
    found = {}
    for name, own in (config.get("profiles") or {}).items():
        if more := sorted(set(own) - {"model", "prompt_version", "temperature"}):
            raise ValueError(f"profile {name}: unknown setting {more[0]}")
        model = own.get("model") or config.get("default_model")
        if not model:
            raise ValueError(f"profile {name}: no model is named")
        found[name] = Profile(name, model, own.get("prompt_version", L.VERSION), (schemas or {}).get(name), own.get("temperature"))
    return found


def _sent(request: Column, profile: Profile | None) -> Column:
    return profile.sent(request) if profile else request


def settled(df: DataFrame) -> DataFrame:
    """df written down in the folder of ``spark.checkpoint.dir``, so that nothing is asked again when it is used twice or an executor is lost."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None and (named := df.sparkSession.conf.get("spark.checkpoint.dir", None)):
        sc.setCheckpointDir(named)
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local["):
            raise ValueError("name a shared folder in spark.checkpoint.dir, or give a store for answers")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="fableloom-"))
    return df.checkpoint()


def _asking(transport: Callable[[str], str | tuple[str, dict]], check: Callable[[dict], str | None], schema: T.StructType | None, backoff: tuple[float, ...]) -> Callable[[], Callable[[str], tuple]]:
    """A maker, for each task, of the function from a request to RESULT without its key; see call_model."""

    def judged(text: str) -> tuple[str | None, str | None]:
        try:
            found = json_payload(text)
            wrong = (mismatch(schema, found) if schema else None) or check(found)
        except ValueError as e:
            found, wrong = None, str(e)
        return json.dumps(found, ensure_ascii=False, sort_keys=True) if wrong is None else None, wrong

    def start() -> Callable[[str], tuple]:
        judge = lru_cache(1024)(judged)  # short answers are often the same

        def ask(request: str) -> tuple:
            for n, wait in enumerate(backoff, 1):
                try:
                    reply = transport(request)
                    text, usage = reply if isinstance(reply, tuple) else (reply, {})
                    response, wrong = judge(text)
                    return (wrong is None, n, response, wrong, False, usage.get("input_tokens"), usage.get("output_tokens"))
                except TransientError as e:
                    if n == len(backoff):
                        return (False, n, None, str(e), False, None, None)
                    time.sleep(wait)
            return (False, 0, None, "no attempt", False, None, None)

        return ask

    return start


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names).astype({"input_tokens": "Int64", "output_tokens": "Int64"})


def call_model(requests: DataFrame, transport: Callable[[str], str | tuple[str, dict]], check: Callable[[dict], str | None], cache: DataFrame | None = None, parallel: int | None = 8, dry_run: bool = False, backoff: tuple[float, ...] = BACKOFF, store: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """cache_key, ok, attempts, response (JSON), error, cached, input_tokens and output_tokens for the distinct requests(request, a JSON string).

    transport gives a reply, or a reply and its usage (input_tokens, output_tokens).
    schema: what a reply must keep to the letter; check then says what else is
    wrong with it, or None, from the reply alone. Transient errors are tried
    len(backoff) times, wrong replies once. A dry run answers ok without a response. Rows of
    cache(cache_key, response) are taken as they are, with no attempt, and cost no
    tokens. store: a folder of answers; good ones of earlier calls serve as cache,
    and new ones are written there. With or without one, answers are written down
    before use, so that no request is made twice. parallel: how many calls run at a
    time at most, None for a model that needs no bound.
    """
    spark = requests.sparkSession
    # Dealt by key once: dropping repeats needs no more than that, and the calls are dealt out by putting parts together.
    parts = max(parallel or 1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    own = requests.select(F.sha2("request", 256).alias("cache_key"), "request").repartition(parts, "cache_key").dropDuplicates(["cache_key"])

    def blank(frame: DataFrame, **k: object) -> DataFrame:
        return frame.select(*[F.col(n) if n in frame.columns else F.lit(k.get(n)).cast(t).alias(n) for n, t in _RESULT.items()])

    if dry_run:
        return blank(own, ok=True, attempts=0, cached=False)
    if store is not None:
        earlier = read_table(spark, *os.path.split(store), RESULT.simpleString()[7:-1].replace(":", " ")).where("ok").select("cache_key", "response")
        cache = earlier if cache is None else earlier.unionByName(cache.select("cache_key", "response"))
    hits = None
    if cache is not None:
        known = cache.select("cache_key", "response").dropDuplicates(["cache_key"])
        hits = blank(own.join(known, "cache_key").drop("request"), ok=True, attempts=0, cached=True)
        own = own.join(known, "cache_key", "left_anti")
    start = _asking(transport, check, schema, backoff)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = start()
        for b in batches:
            yield _frame([(k, *ask(r)) for k, r in zip(b["cache_key"], b["request"], strict=True)], RESULT.names)

    found = (own.coalesce(parallel) if parallel else own).mapInPandas(run, RESULT)
    found = found if hits is None else found.unionByName(hits)
    if store is None:
        return settled(found)
    fresh = f"{store}/part={uuid.uuid4().hex}"
    found.write.parquet(fresh)
    return spark.read.schema(RESULT).parquet(fresh)


def call_beside(rows: DataFrame, transport: Callable[[str], str | tuple[str, dict]], check: Callable[[dict], str | None], parallel: int | None = 8, backoff: tuple[float, ...] = BACKOFF, schema: T.StructType | None = None) -> DataFrame:
    """rows(request, ...) with the answers of call_model beside them, for requests of which no two are the same.

    Each is asked where its row stands, so nothing is moved or joined. What is
    made of the rows must be written down (see settled) before it is used.
    """
    start = _asking(transport, check, schema, backoff)
    answer = T.StructType(RESULT.fields[1:])

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ask = start()
        for b in batches:
            yield _frame([ask(r) for r in b], answer.names)

    # Not deterministic: the optimizer may then neither repeat it nor drop rows after it.
    asked = F.pandas_udf(run, answer).asNondeterministic()
    dealt = rows.coalesce(parallel) if parallel else rows
    return dealt.withColumn("_answer", asked("request")).select(*rows.columns, "_answer.*")


_SPAN = T.StructType([T.StructField("text", T.StringType(), False), T.StructField("char_start", T.IntegerType()), T.StructField("char_end", T.IntegerType()), T.StructField("source", T.StringType())])
#: An answer of the classifier.
CLASSIFICATION = T.StructType(
    [
        T.StructField("functions", T.ArrayType(T.StringType()), False),
        *[T.StructField(n, T.StringType()) for n in ("primary_function", "certainty", "emotion_expressed")],
        T.StructField("emotion_intensity", T.IntegerType()),
        T.StructField("emotions_mentioned", T.ArrayType(T.StringType())),
        T.StructField("stance", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("evidence_spans", T.ArrayType(_SPAN)),
    ]
)


def classification_requests(units: DataFrame) -> DataFrame:
    """units with ``request``: a unit with its candidates and two texts on either side, as JSON. Units that carry these texts (see segment_texts) are not moved for them."""
    if {"context_before", "context_after"} <= set(units.columns):
        context = units.withColumnsRenamed({"context_before": "_before", "context_after": "_after"})
    else:
        context = with_neighbours(units, 2, 2, lambda order: {"_before": around(order, 2, 1), "_after": around(order, -1, -2)})
    asked = F.to_json(F.struct("unit_id", "text", F.col("_before").alias("before"), F.col("_after").alias("after"), "locked_functions", "candidate_functions"))
    return context.withColumn("request", asked).drop("_before", "_after")


def classify(units: DataFrame, transport: Callable[[str], str], cache: DataFrame | None = None, dry_run: bool = False, store: str | None = None, profile: Profile | None = None, parallel: int | None = 8, distinct: bool = False, only: tuple[str, ...] | None = None) -> DataFrame:
    """Annotated units labelled by a model: locked functions always stay, what the model leaves open falls back to candidates.

    profile: of the model that is asked; where it has a schema, answers must keep
    it. ``llm_usage`` says what a unit's answer took: whether it was cached, its
    attempts and tokens.

    Where it fails (or in a dry run), the locked functions alone are taken, at confidence 0.6 and marked for review.
    Evidence spans of both are kept, each once.

    distinct: no two units have the same unit_id, and so no two the same request.
    Where there is no cache or store either, each is asked where it stands, and the
    labelled units are written down. only: the columns to give, which are then all
    that is worked out and written.
    """
    own = classification_requests(units).withColumn("request", _sent(F.col("request"), profile))

    def check(found: dict) -> str | None:
        codes = found.get("functions")
        if not isinstance(codes, list) or not codes or any(c not in L.FUNCTIONS for c in codes):
            return "functions must be a list of known codes"
        return None if found.get("confidence") is None or 0 <= found["confidence"] <= 1 else "confidence outside 0 to 1"

    schema = profile.schema if profile else None
    answer = ("ok", F.from_json("response", CLASSIFICATION).alias("m"), F.struct("cached", "attempts", "input_tokens", "output_tokens").alias("llm_usage"))
    beside = distinct and cache is None and store is None and not dry_run
    if beside:
        joined = call_beside(own, transport, check, parallel, schema=schema).select(*[c for c in own.columns if c != "request"], *answer)
    else:
        answers = call_model(own, transport, check, cache, parallel, dry_run, store=store, schema=schema)
        joined = own.withColumn("cache_key", F.sha2("request", 256)).join(answers.select("cache_key", *answer), "cache_key", "left")
    good = F.col("ok") & F.col("m").isNotNull()
    locked, m = F.col("locked_functions"), F.col("m")
    functions = normalize_codes(F.when(good, F.array_union(locked, m["functions"])).when(F.size(locked) > 0, locked).otherwise(strings("N")))
    # One code and none locked is the usual answer, and needs no order.
    functions = F.when(good & (F.size(locked) == 0) & (F.size(m["functions"]) == 1), m["functions"]).otherwise(functions)
    clash = good & (F.size(F.array_except(locked, m["functions"])) > 0)
    joined = joined.withColumns({"functions": functions, "_clash": clash})
    first = F.get(locked, F.lit(0))
    if "evidence_spans" in units.columns:
        joined = joined.withColumn("evidence_spans", merge_spans(F.col("evidence_spans"), F.when(good, m["evidence_spans"])))
    labelled = joined.withColumns(
        {
            "primary_function": F.coalesce(first, F.when(good, m["primary_function"]), F.get("functions", F.lit(0))),
            "secondary_functions": F.col("functions"),
            "certainty": F.coalesce(F.when(good, m["certainty"]), "candidate_certainty", F.lit("none")),
            "emotion_expressed": F.coalesce(F.when(good, m["emotion_expressed"]), "candidate_emotion_expressed", F.lit("N")),
            "emotion_intensity": F.coalesce(F.when(good, m["emotion_intensity"]), F.lit(0)),
            "emotions_mentioned": F.array_union(F.coalesce(F.when(good, m["emotions_mentioned"]), strings()), F.col("candidate_emotions_mentioned")),
            "stance": F.coalesce(F.when(good, m["stance"]), "candidate_stance", F.lit("neutral")),
            "confidence": F.when(good, F.coalesce(m["confidence"], F.lit(0.0))).otherwise(F.lit(0.6)),
            "method": F.when(good, "llm").otherwise("heuristic"),
            "needs_review": ~good | F.col("_clash"),
            "review_reasons": F.array_compact(F.array(F.when(~good, F.lit("llm_failed")), F.when(F.col("_clash"), F.lit("locked_heuristic_llm_conflict")))),
        }
    ).drop("request", "cache_key", "ok", "m", "_clash")
    labelled = labelled.select(*only) if only else labelled
    return settled(labelled) if beside else labelled


def merge_spans(spans: Column, more: Column) -> Column:
    """Both lists of spans, of spans with the same text, places and source the first; null is empty."""
    kind = "array<struct<text:string,char_start:int,char_end:int,source:string>>"
    return F.array_distinct(F.concat(F.coalesce(spans, F.array()).cast(kind), F.coalesce(more, F.array().cast(kind))))


def adjudicate(units: DataFrame, transport: Callable[[str], str], cache: DataFrame | None = None, store: str | None = None, profile: Profile | None = None) -> DataFrame:
    """Units with risks (see adjudication_reasons) asked again; the others pass untouched and are never sent.

    The second answer may take functions away; it adds some only with evidence
    spans. Flags that it settles go; a unit without a usable answer stays for review.
    units should be a written table, so that what comes before is not asked again.
    """
    calm, risky = units.where(F.size("risks") == 0), units.where(F.size("risks") > 0)
    asked = risky.withColumn("request", _sent(F.to_json(F.struct("unit_id", "text", "functions", "primary_function", "risks")), profile))

    def check(found: dict) -> str | None:
        codes = found.get("functions")
        return None if isinstance(codes, list) and codes and all(c in L.FUNCTIONS for c in codes) else "functions must be a list of known codes"

    answers = call_model(asked, transport, check, cache, store=store, schema=profile.schema if profile else None)
    kind = "functions array<string>, primary_function string, confidence double, evidence array<string>"
    joined = asked.withColumn("cache_key", F.sha2("request", 256)).join(answers.select("cache_key", "ok", F.from_json("response", kind).alias("m")), "cache_key", "left")
    good = F.col("ok") & F.col("m").isNotNull()
    m, old = F.col("m"), F.col("functions")
    grows = F.size(normalize_codes(m["functions"])) > F.size(old)
    taken = good & (~grows | (F.size(F.coalesce(m["evidence"], strings())) > 0))
    changes = {
        "functions": normalize_codes(F.when(taken, m["functions"]).otherwise(old)),
        "primary_function": F.when(taken, F.coalesce(m["primary_function"], "primary_function")).otherwise(F.col("primary_function")),
        "confidence": F.when(good, F.coalesce(m["confidence"], "confidence")).otherwise(F.col("confidence")),
        "method": F.when(good, "adjudicated").otherwise(F.col("method")),
        "needs_review": F.col("needs_review") | ~good,
        "review_reasons": F.array_union("review_reasons", F.when(good, strings()).otherwise(strings("adjudication_failed"))),
    }
    joined = joined.withColumns(changes)
    if "validator_flags" in units.columns:
        added = F.when(good, F.array(flag("adjudication_applied", "functions", "info"))).otherwise(F.array(flag("adjudication_failed", "functions")))
        joined = joined.withColumn("validator_flags", F.concat(F.when(good, still_relevant(F.col("validator_flags"), F.col("functions"))).otherwise(F.col("validator_flags")), added))
    return joined.select(*units.columns).unionByName(calm)


DECISIONS = ("accept", "revise", "reject", "needs_review")
GOLD = ("synthetic_gold_high_confidence", "synthetic_gold_medium_confidence", "rejected")


def _decided(found: dict) -> str | None:
    sure = found.get("confidence")
    return None if found.get("decision") in DECISIONS and isinstance(sure, (int, float)) and 0 <= sure <= 1 else "decision or confidence is wrong"


def _answered(asked: DataFrame, answers: DataFrame, kind: str) -> DataFrame:
    """asked(request, ...) with ok, error and the parsed answer m."""
    return asked.withColumn("cache_key", F.sha2("request", 256)).join(answers.select("cache_key", "ok", "error", F.from_json("response", kind).alias("m")), "cache_key", "left").drop("cache_key")


def _failures(joined: DataFrame, who: Column) -> DataFrame:
    return joined.where(~F.coalesce(F.col("ok"), F.lit(False)) | F.col("m").isNull()).select("review_item_id", who.alias("profile"), F.coalesce("error", F.lit("no answer")).alias("error"))


def aggregate_by_model(items: DataFrame, votes: DataFrame, fallback: DataFrame, transport: Callable[[str], str], store: str | None = None, profile: Profile | None = None) -> tuple[DataFrame, DataFrame]:
    """The committee's decisions as an aggregator sees them, and its failures.

    items(review_item_id, text); votes; fallback: of committee_vote, whose row
    stands where the aggregator has no usable answer.
    """
    own = votes.groupBy("review_item_id").agg(F.array_sort(F.collect_list(F.struct("position", "decision", "confidence"))).alias("votes"))
    asked = fallback.join(own, "review_item_id").join(items.select("review_item_id", "text"), "review_item_id")
    asked = asked.withColumn("request", _sent(F.to_json(F.struct(F.lit("aggregator").alias("profile"), "review_item_id", "text", "votes", "aggregate_decision", "agreement")), profile))
    joined = _answered(asked, call_model(asked, transport, _decided, store=store, schema=profile.schema if profile else None), "decision string, confidence double")
    good = F.coalesce(F.col("ok"), F.lit(False)) & F.col("m").isNotNull()
    decided = F.when(good, F.col("m.decision")).otherwise(F.col("aggregate_decision"))
    out = joined.withColumns({"confidence": F.when(good, F.round("m.confidence", 4)).otherwise(F.col("confidence")), "needs_final_adjudication": decided != "needs_review", "aggregate_decision": decided})
    return out.select(*fallback.columns), _failures(joined, F.lit("aggregator"))


def final_by_model(items: DataFrame, aggregated: DataFrame, fallback: DataFrame, transport: Callable[[str], str], store: str | None = None, profile: Profile | None = None) -> tuple[DataFrame, DataFrame]:
    """The final judge's decisions, and its failures.

    fallback: of fallback_finals, whose row stands where the judge has no usable
    answer. An item is promoted only by an answer that names a status of gold.
    """
    asked = aggregated.join(items.select("review_item_id", "text"), "review_item_id")
    asked = asked.withColumn("request", _sent(F.to_json(F.struct(F.lit("final").alias("profile"), "review_item_id", "text", "aggregate_decision", "agreement", "confidence")), profile))
    wrong = lambda found: _decided(found) or (None if found.get("gold_status") in (None, *GOLD) else "gold_status is wrong")
    joined = _answered(asked, call_model(asked, transport, wrong, store=store, schema=profile.schema if profile else None), "decision string, confidence double, gold_status string, needs_human_review boolean")
    good = F.coalesce(F.col("ok"), F.lit(False)) & F.col("m").isNotNull()
    m = F.col("m")
    judged = joined.where(good).select("review_item_id", m["decision"].alias("final_decision"), m["gold_status"].alias("gold_status"), m["confidence"].alias("reliability_score"), F.coalesce(m["needs_human_review"], F.lit(False)).alias("needs_human_review"))
    rest = fallback.join(judged.select("review_item_id"), "review_item_id", "left_anti")
    return judged.unionByName(rest.select(*judged.columns)), _failures(joined, F.lit("final"))


def review_by_committee(items: DataFrame, reviewers: DataFrame, transport: Callable[[str], str], cache: DataFrame | None = None, store: str | None = None, profile: Profile | None = None) -> tuple[DataFrame, DataFrame]:
    """Votes(review_item_id, position, decision, confidence) of every reviewer(reviewer_id, position, profile) on every item(review_item_id, text), and the failures.

    reviewers is a list of MAX_REVIEWERS at most that goes to every item; answers that fail are no votes.
    """
    if reviewers.limit(MAX_REVIEWERS + 1).count() > MAX_REVIEWERS:
        raise ValueError(f"more than {MAX_REVIEWERS} reviewers")
    asked = items.select("review_item_id", "text").crossJoin(F.broadcast(reviewers)).withColumn("request", _sent(F.to_json(F.struct("review_item_id", "reviewer_id", "profile", "text")), profile))
    joined = _answered(asked, call_model(asked, transport, _decided, cache, store=store, schema=profile.schema if profile else None), "decision string, confidence double")
    votes = joined.where("ok AND m IS NOT NULL").select("review_item_id", "position", F.col("m.decision").alias("decision"), F.col("m.confidence").alias("confidence"))
    return votes, _failures(joined, F.col("reviewer_id"))
