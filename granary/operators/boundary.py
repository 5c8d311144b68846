"""Boundaries to models and services, with deterministic stand-ins, and a cache of their results."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: Seconds between the tries of a call.
WAITS = (10, 30, 60)


def echo_generator(system: str, prompt: str) -> str:
    """Stand-in for a language model: the last line of the prompt with a digest."""
    return f"{prompt.rstrip().rpartition(chr(10))[2]} [{hashlib.sha256((system + prompt).encode()).hexdigest()[:8]}]"


def hashed_embedder(text: str, size: int = 64) -> list[float]:
    """Stand-in for an embedding model: signed counts of hashed words, of length 1."""
    v = np.zeros(size, dtype=np.float32)
    for w in text.lower().split():
        h = int.from_bytes(hashlib.md5(w.encode()).digest()[:8], "little")
        v[h % size] += 1 if h >> 63 else -1
    return (v / max(float(np.linalg.norm(v)), 1e-9)).tolist()


def with_retries(call: Callable, waits: tuple[float, ...] = WAITS) -> Callable:
    """A call that is tried again after each wait; the last failure is raised."""
    def run(*args):
        for wait in (*waits, None):
            try:
                return call(*args)
            except Exception:
                if wait is None:
                    raise
                time.sleep(wait)

    return run


def call_table(df: DataFrame, id_column: str, prompt: str, call: Callable[[str], str], tasks: int = 12, waits: tuple[float, ...] = WAITS) -> DataFrame:
    """id, key, reply: a call for each prompt, on at most `tasks` tasks at a time, for services that bound their load."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = with_retries(call, waits)
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "key": pdf["key"], "reply": [ask(p) for p in pdf["prompt"]]})

    rows = df.select(F.col(id_column).alias("id"), F.sha2(prompt, 256).alias("key"), F.col(prompt).alias("prompt")).coalesce(tasks)
    return rows.mapInPandas(run, f"id {dict(df.dtypes)[id_column]}, key string, reply string")


def call_cached(df: DataFrame, id_column: str, prompt: str, cache: DataFrame, call: Callable[[str], str], **options) -> tuple[DataFrame, DataFrame]:
    """(id, reply for every row; key, reply of the new prompts): only prompts that the cache lacks are called, each once."""
    keyed = df.select(F.col(id_column).alias("id"), F.col(prompt).alias("prompt"), F.sha2(prompt, 256).alias("key"))
    misses = keyed.join(cache.select("key"), "key", "left_anti").groupBy("key").agg(F.first("prompt").alias("prompt"), F.min("id").alias("id"))
    new = call_table(misses, "id", "prompt", call, **options).select("key", "reply")
    return keyed.join(cache.select("key", "reply").unionByName(new), "key", "left").select("id", "reply"), new


def stop_at(reply, terms: list[str]):
    """A reply up to the first of the stop terms."""
    for t in terms:
        reply = F.substring_index(reply, t, 1)
    return reply
