"""Exact top-k retrieval by cosine in blocks, re-ranking, context and upsert."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from granary.functions import text as X


def usable(c: Column) -> Column:
    return c.isNotNull() & F.exists(c, lambda x: x != 0)


def upsert(target: DataFrame, updates: DataFrame, id_column: str, version: Column) -> DataFrame:
    """The row of the latest version of each id. Wide columns are carried once, by the window's sort; equal versions keep any of equal rows."""
    both = target.unionByName(updates)
    last = Window.partitionBy(id_column).orderBy(version.desc_nulls_last(), F.xxhash64(*[c for c, t in both.dtypes if not t.startswith("map")]))
    return both.withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n")


def top_k(queries: DataFrame, base: DataFrame, k: int = 3, query_block: int = 1024, base_block: int = 8192) -> DataFrame:
    """query_id, rank, id, similarity (rounded to 6): the k base rows nearest to each query, itself left out.

    Both sides (id, vector) are packed into blocks by a hash of the id; each pair of blocks is one matrix product in its
    task, which keeps k rows for each query. The best of the blocks follow by rank. No side is broadcast.
    """
    def packed(df: DataFrame, size: int) -> DataFrame:
        n = max(1, -(-df.count() // size))
        return df.groupBy(F.pmod(F.xxhash64("id"), F.lit(n)).alias("block")).agg(F.collect_list("id").alias("ids"), F.flatten(F.collect_list(F.transform("vector", lambda x: x.cast("double")))).alias("flat"))

    q = packed(queries, query_block).select(F.col("ids").alias("q_ids"), F.col("flat").alias("q_flat"))
    b = packed(base, base_block).select("ids", "flat")
    kind = dict(base.dtypes)["id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                qi, bi = np.asarray(row.q_ids), np.asarray(row.ids)
                unit = lambda flat, n: (m := np.asarray(flat, dtype=np.float64).reshape(n, -1)) / np.linalg.norm(m, axis=1, keepdims=True)
                sim = unit(row.q_flat, len(qi)) @ unit(row.flat, len(bi)).T
                sim[qi[:, None] == bi[None, :]] = -np.inf
                sim = np.round(sim, 6)
                best = np.lexsort((np.broadcast_to(bi, sim.shape), -sim), axis=1)[:, :k]
                kept = np.take_along_axis(sim, best, 1)
                out = pd.DataFrame({"query_id": np.repeat(qi, best.shape[1]), "id": bi[best].ravel(), "similarity": kept.ravel()})
                yield out[np.isfinite(out["similarity"])]

    pairs = q.crossJoin(b).mapInPandas(run, f"query_id {kind}, id {kind}, similarity double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "similarity")


def lexical_score(a: Column, b: Column) -> Column:
    """Stand-in for a pair model: Jaccard similarity of the token sets."""
    x, y = F.array_distinct(X.tokens(F.lower(a))), F.array_distinct(X.tokens(F.lower(b)))
    union = F.size(F.array_union(x, y))
    return F.when(union > 0, F.round(F.size(F.array_intersect(x, y)) / union, 6)).otherwise(0.0)


def rerank(hits: DataFrame, texts: DataFrame, keep: int = 3, score=lexical_score) -> DataFrame:
    """hits with score and new rank: the best `keep` by a pair scorer. texts: id, text."""
    t = hits.join(texts.select(F.col("id").alias("query_id"), F.col("text").alias("query_text")), "query_id").join(texts, "id")
    scored = t.withColumn("score", score(F.col("query_text"), F.col("text")))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return scored.withColumn("place", place).where(F.col("place") <= keep).select("query_id", "place", "id", "score", "text")


def context(reranked: DataFrame) -> DataFrame:
    """query_id, context: the stripped passages in order, joined by blank lines. Each query has at most a few."""
    return reranked.groupBy("query_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda x: X.strip(x["text"])), "\n\n").alias("context"))


def labelled_context(reranked: DataFrame) -> DataFrame:
    """query_id, context: the passages in order, each on one line after its label. Fewer than three give fewer labels."""
    label = F.when(F.col("place") == 1, "First").when(F.col("place") == 2, "Second").otherwise("Third")
    line = F.concat(label, F.lit(" result:\n"), F.replace("text", F.lit("\n"), F.lit(" ")))
    return reranked.select("query_id", "place", line.alias("line")).groupBy("query_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]), "\n").alias("context"))


def search_results(hits: DataFrame) -> DataFrame:
    """query_id, context: the snippets of search hits (query_id, rank, text) in order, joined with hard breaks."""
    return hits.groupBy("query_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda x: X.snippet(x["text"])), "  \n").alias("context"))
