"""Vectors of texts by any provider, each text asked for once.

A provider is a function from a list of texts to as many vectors. Its vectors
are kept in a table keyed by provider and content: only texts that the table has
not got yet reach the provider, in batches, and what it gives is written there
before it is used.
"""

from __future__ import annotations

import importlib
import os
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..sources.sinks import read_table
from .model_calls import BACKOFF, TransientError
from .similarity import hash_embedding

Provider = Callable[[list[str]], list[list[float]]]
STORED = "provider_id string, text_sha256 string, embedding array<double>"


def named_function(name: str) -> Callable:
    """The function that ``package.module:function`` names."""
    module, _, function = name.partition(":")
    if not module or not function:
        raise ValueError(f"not of the form package.module:function: {name}")
    return getattr(importlib.import_module(module), function)


def local_vectors(texts: DataFrame, key: str, text: str, size: int = L.EMBEDDING_SIZE) -> DataFrame:
    """key and vector: hashed token counts in ``size`` buckets, by built-in functions. Texts without tokens have the zero vector."""
    cells = hash_embedding(texts, key, text, size).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("bucket", "weight"))).alias("m"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda b: F.coalesce(F.try_element_at("m", b), F.lit(0.0)))
    return texts.select(key).join(cells, key, "left").select(key, filled.alias("vector"))


def ask_provider(contents: DataFrame, provider: Provider, provider_id: str, batch: int = 64, parallel: int = 8, backoff: tuple[float, ...] = BACKOFF) -> DataFrame:
    """provider_id, text_sha256 and embedding of contents(text_sha256, text), distinct ones, ``batch`` texts a call and ``parallel`` calls at a time.

    Transient errors are tried len(backoff) times; any other error, and an answer
    of another length than the question or with a vector of another length, fails
    the job: there is no vector to go on with.
    """

    def call(texts: list[str]) -> list[list[float]]:
        for n, wait in enumerate(backoff, 1):
            try:
                found = [[float(x) for x in v] for v in provider(texts)]
                break
            except TransientError:
                if n == len(backoff):
                    raise
                time.sleep(wait)
        if len(found) != len(texts) or len({len(v) for v in found}) > 1:
            raise ValueError(f"{provider_id}: {len(found)} vectors of lengths {sorted({len(v) for v in found})} for {len(texts)} texts")
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[str] = []
        texts: list[str] = []

        def answer() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([provider_id] * len(keys)), pa.array(keys), pa.array(call(texts), pa.list_(pa.float64()))], ["provider_id", "text_sha256", "embedding"])
            keys.clear()
            texts.clear()
            return made

        for b in batches:
            for k, t in zip(b["text_sha256"].to_pylist(), b["text"].to_pylist(), strict=True):
                keys.append(k)
                texts.append(t)
                if len(keys) == batch:
                    yield answer()
        if keys:
            yield answer()

    return contents.select("text_sha256", "text").repartition(parallel, "text_sha256").mapInArrow(run, STORED)


def embed_texts(texts: DataFrame, key: str, text: str, provider: Provider, provider_id: str, store: str, batch: int = 64, parallel: int = 8, backoff: tuple[float, ...] = BACKOFF) -> DataFrame:
    """key and vector of every row of texts, by way of the table of vectors in the folder ``store``.

    Texts are told apart by their SHA-256, so equal texts are asked for once, in
    this call and over all calls with the same provider_id. Vectors of providers
    with other ids lie in the same table and are never taken. A null text is an
    empty one. Rows of ``store`` that two runs wrote at the same time count once.
    """
    spark: SparkSession = texts.sparkSession
    hashed = texts.select(key, F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("text_sha256", F.sha2("text", 256))

    def known() -> DataFrame:
        return read_table(spark, *os.path.split(store), STORED).where(F.col("provider_id") == provider_id).select("text_sha256", "embedding").dropDuplicates(["text_sha256"])

    missing = hashed.select("text_sha256", "text").join(known().select("text_sha256"), "text_sha256", "left_anti").dropDuplicates(["text_sha256"])
    ask_provider(missing, provider, provider_id, batch, parallel, backoff).write.parquet(f"{store}/part={uuid.uuid4().hex}")
    return hashed.select(key, "text_sha256").join(known(), "text_sha256").select(key, F.col("embedding").alias("vector"))


def vectors_from_config(config: dict, texts: DataFrame, key: str, text: str, default_store: str) -> DataFrame:
    """key and vector by the provider that the ``embedding`` part of a configuration names.

    provider: ``local`` (hashed buckets, as many as ``dimensions``) or
    ``package.module:function``; a ``model`` becomes part of the provider's id and
    is given to the function as its second argument. cache_dir: the store, by
    default default_store. Local vectors are cheaper to make than to look up and
    are not stored.
    """
    own = config.get("embedding") or {}
    name, model = own.get("provider", "local"), own.get("model")
    if name == "local":
        return local_vectors(texts, key, text, int(own.get("dimensions", L.EMBEDDING_SIZE)))
    function = named_function(name)
    provider = (lambda t: function(t, model)) if model else function
    return embed_texts(texts, key, text, provider, f"{name}_{model}" if model else name, own.get("cache_dir") or default_store, int(own.get("batch", 64)), int(own.get("parallel", 8)))
