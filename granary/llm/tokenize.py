"""Byte-level BPE of whole corpora: batched numpy merge rounds (problem 8).

The symbols of many words lie in one flat array. In each round the pair keys of all neighbouring symbols are looked up
by binary search in the sorted pair keys of the vocabulary; in each word every occurrence of its lowest-rank pair is
merged. Words without a pair that can be merged are final and leave the array. A merged symbol always has a higher rank
than the pair that made it, so merging all occurrences of a word's lowest pair at once equals merging one at a time.

Cases: null and empty texts give an empty list; special-token strings are ordinary text; other columns are ignored.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

#: The pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Words kept per worker with their ids; the cache is emptied when it is full.
CACHE_WORDS = 200_000
#: Characters of text that are encoded together.
CHUNK_CHARS = 4_000_000


class ByteBpe:
    """Encoder of one vocabulary file of lines `base64(token) rank`."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        keys, merged = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.merged = np.array(merged, dtype=np.int64)[order]
        self.split = regex.compile(PATTERN)
        self.cache: dict[str, np.ndarray] = {}

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one flat array, and the number of ids of each word."""
        lens = np.fromiter((len(w) for w in words), dtype=np.int64, count=len(words))
        symbols = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(words)), lens)
        done_symbols, done_owner = [], []
        while symbols.size:
            at = np.flatnonzero(owner[1:] == owner[:-1])
            key = symbols[at] << 32 | symbols[at + 1]
            pos = np.minimum(np.searchsorted(self.keys, key), self.keys.size - 1)
            hit = self.keys[pos] == key
            at, rank = at[hit], self.merged[pos[hit]]
            alive = np.zeros(len(words), dtype=bool)
            alive[owner[at]] = True
            stay = alive[owner]
            if not stay.all():
                done_symbols.append(symbols[~stay])
                done_owner.append(owner[~stay])
                at = (np.cumsum(stay) - 1)[at]
                symbols, owner = symbols[stay], owner[stay]
            if not at.size:
                break
            own = owner[at]
            starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, at.size]))
            chosen, rank = at[rank == lowest], rank[rank == lowest]
            # in a run of overlapping pairs (aaaa) every other one, from the left
            begins = np.r_[True, (chosen[1:] != chosen[:-1] + 1) | (owner[chosen[1:]] != owner[chosen[:-1]])]
            run = np.flatnonzero(begins)[np.cumsum(begins) - 1]
            even = (np.arange(chosen.size) - run) % 2 == 0
            chosen, rank = chosen[even], rank[even]
            symbols[chosen] = rank
            keep = np.ones(symbols.size, dtype=bool)
            keep[chosen + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        if not done_symbols:
            return np.zeros(0, dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        flat, who = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(who, kind="stable")
        return flat[order], np.bincount(who, minlength=len(words))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one flat array, and the offsets of the texts in it."""
        index: dict[str, int] = {}
        use: list[int] = []
        per_text = np.zeros(len(texts) + 1, dtype=np.int64)
        for i, text in enumerate(texts):
            if text:
                words = self.split.findall(text)
                use.extend([index.setdefault(w, len(index)) for w in words])
                per_text[i + 1] = len(words)
        known = list(index)
        if len(self.cache) + len(known) > CACHE_WORDS:
            self.cache.clear()
        missing = [w for w in known if w not in self.cache]
        if missing:
            flat, counts = self.merge([w.encode("utf-8", "surrogatepass") for w in missing])
            for w, ids in zip(missing, np.split(flat.astype(np.int32), np.cumsum(counts)[:-1])):
                self.cache[w] = ids
        pieces = [self.cache[w] for w in known]
        sizes = np.fromiter((p.size for p in pieces), dtype=np.int64, count=len(pieces))
        flat = np.concatenate(pieces) if pieces else np.zeros(0, dtype=np.int32)
        starts = np.r_[0, np.cumsum(sizes)][:-1] if pieces else np.zeros(0, dtype=np.int64)
        w = np.array(use, dtype=np.int64)
        n = sizes[w] if w.size else np.zeros(0, dtype=np.int64)
        ends = np.cumsum(n)
        total = int(ends[-1]) if ends.size else 0
        ids = flat[np.arange(total) - np.repeat(ends - n, n) + np.repeat(starts[w], n)] if total else np.zeros(0, dtype=np.int32)
        return ids, np.r_[0, ends][np.cumsum(per_text)]


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteBpe:
    return ByteBpe(path)


def chunks(texts: list[str | None], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `limit` characters together; a longer text is a range of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def encode_table(df: DataFrame, id_column: str, text_column: str, tokenizer_dir: str | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """`id_column`, `ids` array<int>: each text as token ids, without special tokens. One narrow pass, no shuffle."""
    path = f"{tokenizer_dir or TOKENIZERS}/{vocabulary}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in chunks(texts):
                ids, offsets = bpe.encode(texts[a:b])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names=["id", "ids"])

    kind = dict(df.dtypes)[id_column]
    picked = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    return picked.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_column)
