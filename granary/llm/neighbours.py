"""Most similar vectors for every vector (problem 2).

Unit vectors are assigned to the cell of the most similar centre; the centres are sampled vectors, one for each CELL_ROWS
rows. The cells are a written table in the shared folder, a directory for each bucket of cells. Each task takes the
vectors of one bucket and reads the buckets one after the other, at most three times whatever the number of cells: each
cell is compared, by matrix products, with those vectors of the task that ask for it, and with no others. A vector asks
for the FIRST cells, then for as many of the NEAR likeliest as the test below wants. Where it wants more (a vector that
nothing is near to), the vector alone is compared with the middles of all groups of like rows, and with the rows
of each group that could hold a nearer one. No number of candidates is capped.

The test: a neighbour at distance d from a vector is in another cell only if it is nearer to that one's centre, thus if
its offset along the line of the two centres is above z. Over the centres that offset has a deviation of at most
d / sqrt(dims), where dims is the trace of the centres' covariance by its largest eigenvalue. A vector is done when a
neighbour as near as its k-th so far would be in a cell not yet seen with a probability below 1 - CONFIDENCE, summed over
those cells.

Cases: null, all-zero and non-finite vectors and those of another number of values than most are left out, after the
latest row of each id is taken; equal vectors are searched once; of equal similarity the lower id is nearer; an empty
table gives no rows; null dates count as the earliest.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window, functions as F

from granary.session import cut, work_dir

CONFIDENCE, SEED = 0.99, 7
#: Rows of a cell, about; rows of a bucket at most, about; cells that a vector is compared with before its first test; cells that are ranked for it; rows multiplied together; sampled rows, at least; similarity in a group; groups whose largest radius holds for all of them.
CELL_ROWS, BUCKET_ROWS, FIRST, NEAR, STEP, SAMPLE, ALIKE, PART = 4096, 131_072, 6, 128, 256, 20_000, 0.95, 512


def chi2_quantile(p: float, dims: int) -> float:
    """The p-quantile of chi-square for an even number of degrees of freedom."""
    def below(x: float) -> float:
        term = total = 1.0
        for i in range(1, dims // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 4.0 * dims + 60
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


class Bucket(NamedTuple):
    """Rows of some cells, by cell, in a cell by group."""

    cells: np.ndarray
    ids: np.ndarray
    vectors: np.ndarray
    groups: np.ndarray


def stable_rank(sample: np.ndarray) -> float:
    """Trace of the covariance by its largest eigenvalue."""
    if len(sample) < 2:
        return 1.0
    spread = np.linalg.eigvalsh(np.cov(sample.T.astype(np.float64)).reshape(sample.shape[1], -1))
    return float(spread.sum() / max(spread[-1], 1e-30)) if spread.sum() > 0 else 1.0


def cell_of(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([np.argmax(vectors[i : i + STEP] @ centres.T, axis=1) for i in range(0, len(vectors), STEP)])


def groups_of(vectors: np.ndarray) -> np.ndarray:
    """For each row the first row that it is alike to: rows with the same one are a group, none is far from its middle."""
    first = np.empty(len(vectors), dtype=np.int64)
    for i in range(0, len(vectors), STEP):
        alike = vectors[i : i + STEP] @ vectors.T >= ALIKE
        alike[np.arange(len(alike)), np.arange(i, i + len(alike))] = True
        first[i : i + STEP] = alike.argmax(axis=1)
    return first


def middles(part: Bucket) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First row, rows, middle and radius (an angle) of each group, by radius."""
    starts = np.flatnonzero(np.diff(part.groups, prepend=-1))
    sizes = np.diff(starts, append=len(part.groups))
    middle = np.add.reduceat(part.vectors, starts, axis=0)
    middle /= np.maximum(np.linalg.norm(middle, axis=1, keepdims=True), 1e-30)
    radius = np.zeros(len(starts))
    many = np.flatnonzero(sizes > 1)
    if many.size:
        rows = np.flatnonzero(np.repeat(sizes > 1, sizes))
        cosine = np.einsum("ij,ij->i", part.vectors[rows], np.repeat(middle[many], sizes[many], axis=0))
        radius[many] = np.arccos(np.clip(np.minimum.reduceat(cosine, np.cumsum(sizes[many]) - sizes[many]), -1, 1)) + 1e-3
    order = np.argsort(radius, kind="stable")
    return starts[order], sizes[order], middle[order], radius[order]


def rank_marks(near: int, count: int) -> list[int]:
    """Ranks from which on z is known of one cell for many: near, twice near and so on."""
    marks = []
    while (at := near << len(marks)) < count:
        marks.append(at)
    return marks


def near_cells(home: Bucket, centres: np.ndarray, dims: float, near: int) -> tuple[np.ndarray, np.ndarray]:
    """For each vector the cells with the lowest z, its own first, and z, in deviations at distance 1, of these and at the marks."""
    near = min(near, len(centres))
    marks = rank_marks(near, len(centres))
    cells, far = np.empty((len(home.ids), near), dtype=np.int32), np.empty((len(home.ids), near + len(marks)), dtype=np.float32)
    bounds = np.flatnonzero(np.diff(home.cells, prepend=-1, append=-1))
    for a, b in zip(bounds[:-1], bounds[1:]):
        own = home.cells[a]
        wide = math.sqrt(dims) / np.maximum(np.linalg.norm(centres - centres[own], axis=1), 1e-6)
        for i in range(a, b, STEP):
            sim = home.vectors[i : min(b, i + STEP)] @ centres.T
            z = np.maximum(sim[:, own, None] - sim, 0) * wide
            z[:, own] = -1
            part = np.argpartition(z, [near - 1, *marks], axis=1)
            top = np.take_along_axis(part[:, :near], np.argsort(np.take_along_axis(z, part[:, :near], 1), axis=1), 1)
            cells[i : i + len(z)], far[i : i + len(z)] = top, np.take_along_axis(z, np.concatenate([top, part[:, marks]], axis=1), 1)
    return cells, far


def wanted(far: np.ndarray, kth: np.ndarray, near: int, count: int, confidence: float) -> np.ndarray:
    """How many of its ranked cells each vector must have seen; one more than there are where all of them aren't enough."""
    t = np.maximum(far, 0) / np.sqrt(np.maximum(2 - 2 * kth, 1e-12))[:, None]
    p = np.exp(-0.5 * t**2) * np.minimum(0.5, 0.3990 / np.maximum(t, 1e-6))  # at least the normal tail
    marks = rank_marks(near, count)
    rest = p[:, near:] @ np.diff([*marks, count]).astype(p.dtype) if marks else 0
    left = np.concatenate([np.cumsum(p[:, near - 1 :: -1], axis=1)[:, ::-1], np.zeros((len(p), 1), p.dtype)], axis=1) + np.reshape(rest, (-1, 1))
    return (left > 1 - confidence).sum(axis=1)


class Best:
    """The k most similar so far of each vector of a bucket."""

    def __init__(self, home: Bucket, k: int):
        self.home, self.k = home, k
        self.sim = np.full((len(home.ids), k), -2.0, dtype=np.float32)
        self.who = np.full((len(home.ids), k), -1, dtype=np.int64)
        self.floor = np.full(len(home.ids), -2.0, dtype=np.float32)
        self.room = np.empty(0, dtype=np.float32)

    def _above(self, q: np.ndarray, vectors: np.ndarray, low: Callable[[np.ndarray], np.ndarray], own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in q, row, similarity) of what isn't below low, which gets the highest similarities of 64 parts of the rows. own: the row that isn't compared."""
        rows = len(vectors)
        width = 64 if rows >= 1024 else rows
        deep = -(-rows // width)
        if deep * width > rows:
            vectors = np.concatenate([vectors, np.zeros((deep * width - rows, vectors.shape[1]), np.float32)])
        if self.room.size < len(q) * len(vectors):
            self.room = np.empty(len(q) * len(vectors), dtype=np.float32)
        sim = self.room[: len(q) * len(vectors)].reshape(len(q), -1)
        np.matmul(self.home.vectors[q], vectors.T, out=sim)
        sim[:, rows:] = -3
        if own is not None:
            some = np.flatnonzero((own >= 0) & (own < rows))
            sim[some, own[some]] = -3
        sim = sim.reshape(len(q), deep, width)
        peaks = sim.max(axis=1)
        least = low(peaks)
        r, c = np.nonzero(peaks >= least[:, None])
        column = sim[r, :, c]
        hit, d = np.nonzero(column >= least[r][:, None])
        return r[hit], d * width + c[hit], column[hit, d]

    def compare(self, asking: np.ndarray, ids: np.ndarray, vectors: np.ndarray, at: int | None) -> None:
        """Vectors (by number) with rows they haven't met. at: number of the first row if they are of the same bucket."""
        for i in range(0, len(asking), STEP):
            q = asking[i : i + STEP]

            def low(peaks: np.ndarray) -> np.ndarray:
                least = np.maximum(self.floor[q], self.sim[q, -1])
                fresh = np.flatnonzero(least <= -2)
                if fresh.size and peaks.shape[1] >= self.k:
                    least[fresh] = np.maximum(least[fresh], np.partition(peaks[fresh], peaks.shape[1] - self.k, axis=1)[:, peaks.shape[1] - self.k])
                return least

            r, row, sim = self._above(q, vectors, low, None if at is None else q - at)
            if r.size:
                self._add(q, r, sim, ids[row])

    def compare_groups(self, asking: np.ndarray, part: Bucket, own: bool) -> None:
        """Vectors with all rows of a bucket: only groups are left out that can't hold a nearer one (triangle inequality of angles)."""
        starts, sizes, middle, radius = middles(part)
        for i in range(0, len(asking), STEP):
            q = asking[i : i + STEP]
            least = np.maximum(self.floor[q], self.sim[q, -1])
            found = []
            for g in range(0, len(starts), PART):
                angle = np.arccos(np.clip(least, -1, 1)) + radius[g : g + PART].max()
                reach = np.where(angle < math.pi, np.cos(angle), -2) - 1e-5
                r, group, _ = self._above(q, middle[g : g + PART], lambda peaks, reach=reach: reach)
                found.append((r, g + group))
            place, group = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(place, kind="stable")
            place, group = place[order], group[order]
            size = sizes[group]
            rows = np.repeat(starts[group] - np.cumsum(size) + size, size) + np.arange(size.sum())
            place = np.repeat(place, size)
            cuts = np.flatnonzero(np.diff(place, prepend=-1, append=len(q)))
            if not len(place):
                continue
            sim = np.concatenate([part.vectors[rows[x:y]] @ self.home.vectors[q[place[x]]] for x, y in zip(cuts[:-1], cuts[1:])])
            good = np.flatnonzero((sim >= least[place]) & ~(own & (q[place] == rows)))
            if good.size:
                self._add(q, place[good], sim[good], part.ids[rows[good]])

    def _add(self, q: np.ndarray, row: np.ndarray, sim: np.ndarray, ids: np.ndarray) -> None:
        some, row = np.unique(row, return_inverse=True)
        rows = np.concatenate([np.repeat(np.arange(len(some)), self.k), row])
        sims, names = np.concatenate([self.sim[q[some]].ravel(), sim]), np.concatenate([self.who[q[some]].ravel(), ids])
        order = np.lexsort((names, -sims, rows))
        rank = np.arange(len(rows)) - np.searchsorted(rows[order], np.arange(len(some)))[rows[order]]
        order = order[rank < self.k]
        self.sim[q[some]], self.who[q[some]] = sims[order].reshape(-1, self.k), names[order].reshape(-1, self.k)


def search_bucket(own: int, buckets: int, read: Callable[[int], Bucket], centres: np.ndarray, dims: float, k: int, confidence: float, near: int = NEAR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, neighbour ids, similarities) of the vectors of a bucket. read: gives a bucket by its number."""
    home = read(own)
    best = Best(home, k)
    if not len(home.ids):
        return home.ids, best.who, best.sim
    cells, far = near_cells(home, centres, dims, near)
    numbers = np.arange(cells.shape[1])

    def visit(asks: np.ndarray) -> None:
        """asks: which of its ranked cells each vector asks for."""
        vector, place = np.nonzero(asks)
        order = np.argsort(cells[vector, place], kind="stable")
        vector, cell = vector[order], cells[vector, place][order]
        for b in sorted(range(buckets), key=lambda b: b != own) if vector.size else ():
            part = home if b == own else read(b)
            bounds = np.flatnonzero(np.diff(part.cells, prepend=-1, append=-1))
            for x, y in zip(bounds[:-1], bounds[1:]):
                v = vector[np.searchsorted(cell, part.cells[x]) : np.searchsorted(cell, part.cells[x], side="right")]
                if v.size:
                    best.compare(v, part.ids[x:y], part.vectors[x:y], int(x) if b == own else None)

    seen = np.full(len(home.ids), min(FIRST, len(numbers)))
    visit(numbers < seen[:, None])
    need = np.maximum(np.minimum(wanted(far, best.sim[:, -1], len(numbers), len(centres), confidence), len(numbers)), seen)
    visit((numbers >= seen[:, None]) & (numbers < need[:, None]))
    alone = np.flatnonzero(wanted(far, best.sim[:, -1], len(numbers), len(centres), confidence) > need)
    if alone.size:  # they meet all rows again; what is below the k-th so far can be left out
        best.floor[alone] = np.maximum(best.sim[alone, -1] - 1e-5, -2)
        best.sim[alone], best.who[alone] = -2, -1
        for b in range(buckets):
            part = home if b == own else read(b)
            if len(part.ids):
                best.compare_groups(alone, part, b == own)
    return home.ids, best.who, best.sim


def latest_vectors(df: DataFrame, id_column: str, vector_column: str, date) -> DataFrame:
    """id and vector of the latest row of each id; null vectors are left out afterwards."""
    rows = df.select(F.col(f"`{id_column}`").alias("id"), date.alias("date"), F.col(f"`{vector_column}`").alias("vector"))
    return rows.groupBy("id").agg(F.max(F.struct("date", "vector")).alias("x")).select("id", F.col("x.vector").alias("vector")).where("vector IS NOT NULL AND size(vector) > 0")


def _matrix(column: pa.ChunkedArray | pa.Array, values: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, values)


def _unpacked(column: pa.Array, values: int) -> np.ndarray:
    """Vectors that were written as bytes; none is null."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].view(np.float32).reshape(-1, values)


def nearest(vectors: DataFrame, k: int = 10, confidence: float = CONFIDENCE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """id, rank, neighbour, similarity (cosine): the k nearest others of every vector. vectors: id (bigint, unique), vector."""
    spark = vectors.sparkSession
    base = cut(vectors.where(F.exists("vector", lambda x: x != 0) & F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < F.lit(1e30)))).select("id", F.xxhash64("vector").alias("cls"), "vector"), "p2-vectors")
    sizes = base.groupBy(F.size("vector").alias("values")).count().orderBy(F.desc("count"), "values").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "id bigint, rank int, neighbour bigint, similarity float")
    values, total = sizes[0]["values"], sizes[0]["count"]
    base = base.where(F.size("vector") == values)
    # equal vectors: one is searched; of their ids the k + 1 lowest can be neighbours
    by_class = Window.partitionBy("cls").orderBy("id")
    lowest = base.select("cls", "id").withColumn("rn", F.row_number().over(by_class)).where(F.col("rn") <= k + 1)
    repeated = lowest.where("rn = 2").select("cls")
    groups = cut(lowest.join(repeated, "cls", "left_semi").groupBy("cls").agg(F.array_sort(F.collect_list("id")).alias("ids")), "p2-copies")
    searched = base.join(groups, "cls", "left").where("ids IS NULL OR id = ids[0]").select("id", "vector")
    unit = lambda x: (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)).astype(np.float32)
    vectors_ = base.select("vector")
    sample = unit(_matrix(vectors_.sample(False, min(1.0, max(1 / cell_rows, SAMPLE / total)), SEED).toArrow()["vector"], values).astype(np.float64))
    dims, many = stable_rank(sample), max(1, math.ceil(total / cell_rows))
    centres = np.unique(sample[np.random.default_rng(SEED).permutation(len(sample))[:many]], axis=0)
    if not len(centres):
        centres = np.eye(1, values, dtype=np.float32)
    count = len(centres)
    buckets = min(count, max(math.ceil(total / BUCKET_ROWS), 3 * spark.sparkContext.defaultParallelism))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = unit(_matrix(batch.column(1), values).astype(np.float64))
                cell = cell_of(x, centres)
                raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * values), len(x), [None, pa.py_buffer(np.ascontiguousarray(x))]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array((cell * buckets // count).astype(np.int32)), pa.array(cell.astype(np.int32)), batch.column(0), raw], names=["bucket", "cell", "id", "raw"])

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            if batch.num_rows:
                cell = batch.column(1).to_numpy()
                x = _unpacked(batch.column(3), values)
                ends = np.flatnonzero(np.diff(cell, prepend=-1, append=-1))
                first = np.concatenate([a + groups_of(x[a:b]) for a, b in zip(ends[:-1], ends[1:])])
                order = np.argsort(first, kind="stable")
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(order)).columns, pa.array((at + first[order]).astype(np.int64))], names=[*batch.schema.names, "grp"])
                at += batch.num_rows

    path = f"{work_dir(spark)}/p2-index-{uuid.uuid4().hex}"
    index = searched.mapInArrow(assign, "bucket int, cell int, id bigint, raw binary")
    index.repartition(min(buckets, 2000), "bucket").sortWithinPartitions("bucket", "cell").mapInArrow(group, "bucket int, cell int, id bigint, raw binary, grp bigint").write.partitionBy("bucket").option("compression", "none").option("parquet.enable.dictionary", "false").parquet(path)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)

        def read(b: int) -> Bucket:
            at = f"{root}/bucket={b}"
            if fs.get_file_info(at).type == pafs.FileType.NotFound:
                return Bucket(np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros((0, values), np.float32), np.zeros(0, np.int64))
            got = pq.read_table(at, filesystem=fs, columns=["cell", "id", "raw", "grp"], partitioning=None)
            x = np.concatenate([_unpacked(c, values) for c in got["raw"].chunks if len(c)])
            part = Bucket(got["cell"].to_numpy(), got["id"].to_numpy(), x, got["grp"].to_numpy())
            order = np.lexsort((part.groups, part.cells)) if (np.diff(part.groups) < 0).any() or (np.diff(part.cells) < 0).any() else None
            return part if order is None else Bucket(*(y[order] for y in part))

        for batch in batches:
            for own in batch.column(0).to_pylist():
                ids, who, best = search_bucket(own, buckets, read, centres, dims, k, confidence)
                for i in range(0, len(ids), STEP):
                    w, s = who[i : i + STEP].ravel(), best[i : i + STEP].ravel()
                    yield pa.RecordBatch.from_arrays([pa.array(x[w >= 0]) for x in (np.repeat(ids[i : i + STEP], k), w, s)], names=["id", "neighbour", "similarity"])

    tasks = spark.range(0, buckets, 1, buckets).select(F.col("id").cast("int").alias("own"))
    found = cut(tasks.mapInArrow(search, "id bigint, neighbour bigint, similarity float"), "p2-found")
    # copies: as neighbours of others, of each other, and with the neighbours of the one that was searched
    copies = groups.select(F.col("ids")[0].alias("head"), "cls", "ids")
    wide = found.join(copies.select(F.col("head").alias("neighbour"), "ids"), "neighbour", "left").select("id", F.explode(F.coalesce("ids", F.array("neighbour"))).alias("neighbour"), "similarity")
    own = copies.select(F.col("head").alias("id"), F.explode("ids").alias("neighbour"), F.lit(1.0).cast("float").alias("similarity"))
    members = base.select("id", "cls").join(copies, "cls").select("head", F.col("id").alias("member"))
    per = wide.unionByName(own).join(members.withColumnRenamed("head", "id"), "id", "left").select(F.coalesce("member", "id").alias("id"), "neighbour", "similarity").where("id <> neighbour")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("similarity"), "neighbour"))
    return per.withColumn("rank", rank).where(F.col("rank") <= k).select("id", "rank", "neighbour", "similarity")


def neighbour_pairs(found: DataFrame, a: str = "vec_id_a", b: str = "vec_id_b") -> DataFrame:
    """Each pair once, the lower id first."""
    return found.select(F.least("id", "neighbour").alias(a), F.greatest("id", "neighbour").alias(b)).distinct()
