"""Filling containers of fixed capacity: lexical retrieval packing (problem 9).

Documents are sized in tokens. A text above the capacity fills whole containers of its own and leaves a rest, which is
packed like any other document. Documents are spread over shards of a bounded number of rows by a hash of their id; each
shard builds a BM25 inverted index over its token ids. The largest unused document seeds a container; the index returns
its unused neighbours, which greedily fill the container while they fit. In the last part of a container the largest
unused document that fits is taken, so that small ones remain for the other containers.

Cases: null and empty texts have 0 tokens and go into the first container of their shard; documents of equal score or
size are taken in the order of their ids; an empty table gives no rows. No document is dropped, and none at or below the
capacity is split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

CAPACITY = 2048
SHARD_ROWS = 4096
#: Fixed values of BM25.
K1, B = 1.2, 0.75
#: The part of a container, at its end, that is filled by size instead of by likeness.
TAIL = 0.25


class Bm25:
    """Inverted index over lists of token ids."""

    def __init__(self, docs: list[np.ndarray]):
        self.n = len(docs)
        lens = np.array([d.size for d in docs], dtype=np.float64)
        owner = np.repeat(np.arange(self.n), lens.astype(np.int64))
        flat = np.concatenate(docs) if docs else np.zeros(0, dtype=np.int64)
        pair, tf = np.unique(flat.astype(np.int64) * max(1, self.n) + owner, return_counts=True)
        term, self.doc = np.divmod(pair, max(1, self.n))
        self.terms, first = np.unique(term, return_index=True)
        self.ends = np.r_[first, term.size].astype(np.int64)
        df = np.diff(self.ends)
        idf = np.repeat(np.log1p((self.n - df + 0.5) / (df + 0.5)), df)
        norm = K1 * (1 - B + B * lens / max(1.0, lens.mean() if self.n else 1.0))
        self.weight = idf * tf * (K1 + 1) / (tf + norm[self.doc])
        self.df = df

    def scores(self, query: np.ndarray) -> np.ndarray:
        """Score of every document for the distinct tokens of a query. Tokens of more than half of the documents weigh next to nothing and are left out."""
        at = np.searchsorted(self.terms, np.unique(query))
        at = at[self.df[at] * 2 <= max(2, self.n)]
        starts, n = self.ends[at], self.df[at]
        if not n.sum():
            return np.zeros(self.n)
        take = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts, n)
        return np.bincount(self.doc[take], weights=self.weight[take], minlength=self.n)


def fill(docs: list[np.ndarray], capacity: int = CAPACITY) -> np.ndarray:
    """The container of each document, each of at most `capacity` tokens."""
    size = np.array([d.size for d in docs], dtype=np.int64)
    index = Bm25(docs)
    unused = size > 0
    where = np.zeros(len(docs), dtype=np.int64)
    by_size = np.lexsort((np.arange(size.size), -size))
    box = 0
    for seed in by_size:
        if not unused[seed]:
            continue
        unused[seed] = False
        where[seed] = box
        room = capacity - int(size[seed])
        if room:
            score = None
            while room > 0:
                fit = unused & (size <= room)
                if not fit.any():
                    break
                if score is None:
                    score = index.scores(docs[seed])
                    rank = np.lexsort((np.arange(size.size), -score))
                if room > capacity * TAIL:
                    order = rank[fit[rank]]
                    pick = order[0]
                else:
                    most = size[fit].max()
                    same = np.flatnonzero(fit & (size == most))
                    pick = same[np.argmax(score[same])]
                unused[pick] = False
                where[pick] = box
                room -= int(size[pick])
        box += 1
    return where


def pack_table(encoded: DataFrame, id_column: str, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS, total: int | None = None) -> DataFrame:
    """`id_column`, piece_no, n_tokens, container: one row for each piece. encoded: `id_column` and ids.

    total: the number of documents, where it is known without encoding them. The ids are shuffled once, by shard; a shard holds about `shard_rows` documents whatever the size of the table.
    """
    kind = dict(encoded.dtypes)[id_column]
    rows = encoded.select(F.col(f"`{id_column}`").alias("id"), "ids")
    shards = max(1, -(-(rows.count() if total is None else total) // shard_rows))
    whole = F.floor(F.size("ids") / capacity).cast("int")
    picked = rows.select("id", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), whole.alias("whole"), F.expr(f"slice(ids, cast(floor(size(ids) / {capacity}) as int) * {capacity} + 1, {capacity})").alias("rest"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable").reset_index(drop=True)
        rests = [np.asarray(r, dtype=np.int64) for r in pdf["rest"]]
        where = fill(rests, capacity)
        size = np.array([r.size for r in rests], dtype=np.int64)
        own = pdf["whole"].to_numpy(dtype=np.int64)
        has_rest = (size > 0) | (own == 0)
        boxes = int(where.max(initial=0)) + 1
        base = int(pdf["shard"].iloc[0]) << 32
        full = np.repeat(np.arange(len(pdf)), own)
        piece = np.arange(full.size) - np.repeat(np.cumsum(own) - own, own)
        ids = np.r_[pdf["id"].to_numpy()[full], pdf["id"].to_numpy()[has_rest]]
        return pd.DataFrame({"id": ids, "piece_no": np.r_[piece, own[has_rest]].astype(np.int32), "n_tokens": np.r_[np.full(full.size, capacity), size[has_rest]].astype(np.int32), "container": base + np.r_[boxes + np.arange(full.size), where[has_rest]]})

    out = picked.groupBy("shard").applyInPandas(run, f"id {kind}, piece_no int, n_tokens int, container bigint")
    return out.withColumnRenamed("id", id_column)


def fill_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """containers, tokens, least containers possible, and the share of unused space."""
    boxes = packed.groupBy("container").agg(F.sum("n_tokens").alias("used"))
    return boxes.agg(F.count("*").alias("containers"), F.sum("used").alias("tokens"), F.ceil(F.sum("used") / capacity).alias("least"), F.round(1 - F.sum("used") / (F.count("*") * capacity), 6).alias("unused_share"))
