"""Same or near-same records across splits (problem 3).

A record is its set of words. Its fingerprint is a bit code cut into segments: each word goes to one segment, by its hash,
and flips bits of that segment alone. Two sets that differ in at most r words differ in at most r segments, so of r + 1
segments one is equal: the radius r follows from the sizes for which a similarity of 0.8 is possible, and no pair is lost.
Sizes lie in intervals, each with its r; a train record has the code of its interval, a held-out record those of all
intervals with which it can be similar. Segments are joined across splits. A segment that many records of both splits
share is no key by itself: its records are cut a second time, by another permutation of the words, and one of these
segments must be equal too; so common segments fall apart without losing a pair. Candidates beyond the Hamming radius of
a second, folded code of 64 bits (a word flips one bit, so the distance is never above the number of differing words)
are dropped, the rest is verified on the words.

Equal sets of words are one class: only class representatives are joined, and pairs of rows follow from the membership.
Sets are told apart by SHA-256 of their sorted words; a class is named by its least id.

Cases: null counts as no words; records without words have no similarity and are in no pair; repeated rows are members of
one class; rows of other splits or without a split are left out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from granary.session import cut

SIMILAR = 0.8
#: Sizes of an interval: its largest is at most so many times its least.
WIDTH = 1.12
#: A key is common, and is refined, if it would join more pairs than this for each of its records: then a second cut costs less than the pairs. So often keys are cut.
COMMON, LEVELS = 200, 3


def _text(df: DataFrame, columns: list[str]):
    return F.lower(F.concat_ws(" ", *(F.col(f"`{c}`") for c in columns)))


def _words(df: DataFrame, columns: list[str]):
    return F.array_distinct(F.regexp_extract_all(_text(df, columns), F.lit("[a-z0-9]+"), F.lit(0)))


@lru_cache(maxsize=None)
def intervals(most: int) -> np.ndarray:
    """Largest sizes of the intervals, in order, up to the one that holds `most`."""
    ends, low = [], 1
    while not ends or ends[-1] < most:
        ends.append(max(low, int(low * WIDTH)))
        low = ends[-1] + 1
    return np.array(ends, dtype=np.int64)


def radius(end: np.ndarray, similar: float = SIMILAR) -> np.ndarray:
    """Words in which a set of at most `end` words differs at most from a similar one."""
    return np.floor(end * (1 - similar) / similar + 1e-9).astype(np.int64)


def mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A hash of 64-bit numbers (finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def segment_keys(hashes: np.ndarray, sizes: np.ndarray, parts: np.ndarray, seed: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of each segment. hashes: of the words of all rows in one array; parts: segments of each row; seed: what a key stands for besides its segment."""
    owner = np.repeat(np.arange(sizes.size), sizes)
    first = np.cumsum(parts) - parts
    spread = mix(hashes, 2 * level + 1)
    at = first[owner] + (spread >> np.uint64(32)).astype(np.int64) % parts[owner]
    codes = np.zeros(int(parts.sum()), dtype=np.uint64)
    np.bitwise_xor.at(codes, at, mix(hashes, 2 * level + 2))
    row = np.repeat(np.arange(sizes.size), parts)
    number = (np.arange(row.size) - first[row]).astype(np.uint64)
    return row, mix(codes ^ mix(seed[row] + number, 3), 4).view(np.int64)


def folded(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A code of 64 bits for each row, in which each word flips one bit."""
    out = np.zeros(sizes.size, dtype=np.uint64)
    np.bitwise_xor.at(out, np.repeat(np.arange(sizes.size), sizes), np.uint64(1) << (hashes & np.uint64(63)))
    return out.view(np.int64)


def side_intervals(sizes: np.ndarray, train: bool, similar: float = SIMILAR) -> tuple[np.ndarray, np.ndarray]:
    """(row, largest size of an interval): the interval of a train row, all those that hold a size similar to that of a held-out row."""
    ends = intervals(int(sizes.max() / similar) + 1) if sizes.size else np.zeros(0, np.int64)
    if train:
        return np.arange(sizes.size), ends[np.searchsorted(ends, sizes)]
    low = np.searchsorted(ends, np.ceil(sizes * similar - 1e-9).astype(np.int64))
    n = np.searchsorted(ends, np.floor(sizes / similar + 1e-9).astype(np.int64)) - low + 1
    row = np.repeat(np.arange(sizes.size), n)
    return row, ends[low[row] + np.arange(row.size) - np.repeat(np.cumsum(n) - n, n)]


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column in one array, and the size of each list."""
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.diff(column.offsets.to_numpy())


def _picked(hashes: np.ndarray, sizes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The hashes of the rows in the order of `row`."""
    first, n = (np.cumsum(sizes) - sizes)[row], sizes[row]
    return hashes[np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())]


def encode(df: DataFrame, id_column: str, columns: list[str], split_column: str, train: str = "train", held_out: tuple[str, ...] = ("validate", "test")) -> DataFrame:
    """id, split, train, set, hashes: one row for each record with words."""
    rows = df.where(F.col(f"`{split_column}`").isin(train, *held_out)).select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{split_column}`").alias("split"), _words(df, columns).alias("w")).where("size(w) > 0")
    return rows.select("id", "split", (F.col("split") == train).alias("train"), F.unhex(F.sha2(F.array_join(F.array_sort("w"), " "), 256)).alias("set"), F.transform("w", lambda w: F.xxhash64(w)).alias("hashes"))


def keyed(classes: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """key, cls, train, n, code, size_to: the segments of all classes. size_to: the largest size of the interval that the key belongs to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for train, flag in ((True, 1), (False, 2)):
                part = batch.filter(batch.column(flag))
                hashes, sizes = _lists(part.column(3))
                code = folded(hashes, sizes)
                row, end = side_intervals(sizes, train, similar)
                at, key = segment_keys(_picked(hashes, sizes, row), sizes[row], radius(end, similar) + 1, end.astype(np.uint64) << np.uint64(32), 0)
                who = row[at]
                yield pa.RecordBatch.from_arrays([pa.array(key), part.column(0).take(pa.array(who)), pa.array(np.full(who.size, train)), pa.array(sizes[who].astype(np.int32)), pa.array(code[who]), pa.array(end[at].astype(np.int32))], names=["key", "cls", "train", "n", "code", "size_to"])

    return classes.select("cls", "in_train", "in_held", "hashes").mapInArrow(run, f"key bigint, cls {dict(classes.dtypes)['cls']}, train boolean, n int, code bigint, size_to int")


def refined(keys: DataFrame, classes: DataFrame, level: int, similar: float = SIMILAR) -> DataFrame:
    """The keys, each cut again by the segments of another permutation of the words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, sizes = _lists(batch.column(6))
            at, key = segment_keys(hashes, sizes, radius(batch.column(5).to_numpy().astype(np.int64), similar) + 1, batch.column(0).to_numpy().view(np.uint64), level)
            yield pa.RecordBatch.from_arrays([pa.array(key), *(batch.column(i).take(pa.array(at)) for i in range(1, 6))], names=["key", "cls", "train", "n", "code", "size_to"])

    schema = ", ".join(f"{n} {t}" for n, t in keys.dtypes)
    return keys.join(classes.select("cls", "hashes"), "cls").select(*keys.columns, "hashes").mapInArrow(run, schema)


def candidates(classes: DataFrame, similar: float = SIMILAR, common: int = COMMON, levels: int = LEVELS) -> DataFrame:
    """cls_train, cls_held: different classes across splits with an equal key, within the radius of sizes and codes. Each level's common keys are refined at the next."""
    keys, found = cut(keyed(classes, similar), "p3-keys"), None
    for level in range(1, levels + 1):
        count = keys.groupBy("key").agg(F.count_if("train").alias("t"), F.count_if(~F.col("train")).alias("h")).where("t > 0 AND h > 0")
        met = cut(keys.join(count, "key"), "p3-met")
        often = F.col("t") * F.col("h") > common * (F.col("t") + F.col("h"))
        last = level == levels
        rare = met if last else met.where(~often)
        t = rare.where("train").select("key", F.col("cls").alias("cls_train"), F.col("n").alias("n_t"), F.col("code").alias("code_t"))
        h = rare.where("NOT train").select("key", F.col("cls").alias("cls_held"), F.col("n").alias("n_h"), F.col("code").alias("code_h"))
        reach = (1 - similar) / (1 + similar)
        close = (F.bit_count(F.col("code_t").bitwiseXOR(F.col("code_h"))) <= reach * (F.col("n_t") + F.col("n_h")) + 1e-9) & (F.least("n_t", "n_h") >= similar * F.greatest("n_t", "n_h") - 1e-9)
        near = t.join(h, "key").where(close & (F.col("cls_train") != F.col("cls_held"))).select("cls_train", "cls_held")
        found = near if found is None else found.unionByName(near)
        if last or met.where(often).isEmpty():
            return found.distinct()
        keys = cut(refined(met.where(often).drop("t", "h"), classes, level, similar), "p3-keys")


def overlaps(df: DataFrame, id_column: str, columns: list[str], split_column: str, train: str = "train", held_out: tuple[str, ...] = ("validate", "test"), similar: float = SIMILAR, common: int = COMMON, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): pairs of classes `cls_train`, `cls_held` with their similarity; members id, split, cls of the classes that are in a pair.

    A class holds the records with one set of words. A class that is on both sides is paired with itself.
    """
    coded = cut(encode(df, id_column, columns, split_column, train, held_out), "p3-codes")
    classes = cut(coded.groupBy("set").agg(F.min("id").alias("cls"), F.bool_or("train").alias("in_train"), F.bool_or(~F.col("train")).alias("in_held"), F.any_value("hashes").alias("hashes")), "p3-classes")
    near = cut(candidates(classes, similar, common, levels), "p3-near")
    # verify on the words of the row that names each class
    wanted = cut(near.select(F.col("cls_train").alias("cls")).union(near.select("cls_held")).distinct(), "p3-wanted")
    words = cut(df.select(F.col(f"`{id_column}`").alias("cls"), _words(df, columns).alias("w")).join(wanted, "cls", "left_semi"), "p3-words")
    both = near.join(words.select(F.col("cls").alias("cls_train"), F.col("w").alias("w_t")), "cls_train").join(words.select(F.col("cls").alias("cls_held"), F.col("w").alias("w_h")), "cls_held")
    same = F.size(F.array_intersect("w_t", "w_h"))
    pairs = both.select("cls_train", "cls_held", (same / (F.size("w_t") + F.size("w_h") - same)).alias("similarity")).where(F.col("similarity") >= similar - 1e-12)
    equal = classes.where("in_train AND in_held").select(F.col("cls").alias("cls_train"), F.col("cls").alias("cls_held"), F.lit(1.0).alias("similarity"))
    pairs = cut(pairs.unionByName(equal), "p3-pairs")
    paired = pairs.select(F.col("cls_train").alias("cls")).union(pairs.select("cls_held")).distinct()
    named = classes.select("set", "cls").join(paired, "cls", "left_semi")
    return pairs, cut(coded.select("id", "split", "set").join(named, "set").select("id", "split", "cls"), "p3-members")


def row_pairs(pairs: DataFrame, members: DataFrame, train: str = "train") -> DataFrame:
    """id_a < id_b and split_held: every pair of rows across splits."""
    t = members.where(F.col("split") == train).select(F.col("cls").alias("cls_train"), F.col("id").alias("id_t"))
    h = members.where(F.col("split") != train).select(F.col("cls").alias("cls_held"), F.col("id").alias("id_h"))
    both = pairs.join(t, "cls_train").join(h, "cls_held")
    return both.select(F.least("id_t", "id_h").alias("id_a"), F.greatest("id_t", "id_h").alias("id_b"))


def overlap_report(pairs: DataFrame, members: DataFrame, sources: DataFrame, id_column: str, source_column: str, train: str = "train") -> DataFrame:
    """split_name, source (of the held-out row), pairs, rows: counted from classes, without making the pairs."""
    held = members.where(F.col("split") != train).join(sources.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{source_column}`").alias("source")), "id")
    sizes = members.where(F.col("split") == train).groupBy("cls").agg(F.count("*").alias("k"))
    partners = pairs.join(sizes, pairs.cls_train == sizes.cls).groupBy("cls_held").agg(F.sum("k").alias("k"))
    return held.join(partners, held.cls == partners.cls_held).groupBy(F.col("split").alias("split_name"), "source").agg(F.sum("k").alias("pairs"), F.count("*").alias("rows"))
