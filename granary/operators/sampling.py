"""Reproducible choices, splits, nearest-CDF picks and score-guided sampling."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from granary.session import cut


def hash_order(*parts: Column | str) -> Column:
    """A choice that md5 makes, equal on every engine and independent of order."""
    return F.md5(F.concat_ws("|", *(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts)))


def bucket(*parts: Column | str) -> Column:
    """0 to 99."""
    return F.conv(F.substring(hash_order(*parts), 1, 8), 16, 10).cast("long") % 100


def hash_split(df: DataFrame, id_column: str, percent: int = 90, seed: str = "0") -> DataFrame:
    return df.withColumn("part", F.when(bucket(seed, F.col(id_column)) < percent, "train").otherwise("test"))


def truncated_normal(spark, n: int, mean: float = 0.25, sd: float = 0.45, seed: int = 0) -> DataFrame:
    """sample_no, value: n draws in (0, 1). Enough are drawn that their number falls short with a vanishing probability."""
    accept = 0.5 * (math.erf((1 - mean) / sd / math.sqrt(2)) + math.erf(mean / sd / math.sqrt(2)))
    drawn = spark.range(math.ceil(n / accept + 10 * math.sqrt(n) + 20)).select("id", (F.lit(mean) + sd * F.randn(seed)).alias("value"))
    kept = drawn.where((F.col("value") > 0) & (F.col("value") < 1)).orderBy("id").limit(n)
    return kept.select(F.col("id").alias("sample_no"), "value")


def nearest_pick(cdf: DataFrame, samples: DataFrame, cells: int = 4096) -> DataFrame:
    """sample_no, id: the row whose cdf is nearest to each sample, of two equally near ones the later.

    A nearest as-of join without pairs: samples and rows are put into equal cells of (0, 1] and sorted there together; the
    last row before and the first row after a sample follow by running windows, and from the cells' edges where a cell
    has none. At equal cdf the row of lowest rank counts.
    """
    cell = lambda c: F.least(F.greatest(F.floor(c * cells), F.lit(0)), F.lit(cells - 1)).cast("int")
    rows = cdf.groupBy("cdf").agg(F.min_by("id", "rank").alias("id")).select(cell(F.col("cdf")).alias("cell"), F.col("cdf").alias("v"), F.struct("cdf", "id").alias("x"), F.lit(None).cast("bigint").alias("sample_no"))
    edges = rows.groupBy("cell").agg(F.min("x").alias("first"), F.max("x").alias("last"))
    every = cdf.sparkSession.range(cells).select(F.col("id").cast("int").alias("cell")).join(F.broadcast(edges), "cell", "left")
    so_far = (Window.unboundedPreceding, 0)
    earlier = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as there are cells
    later = Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    near = every.select("cell", F.last("last", True).over(earlier).alias("before"), F.last("first", True).over(later).alias("after"))
    both = rows.unionByName(samples.select(cell(F.col("value")).alias("cell"), F.col("value").alias("v"), "sample_no"), allowMissingColumns=True)
    up = Window.partitionBy("cell").orderBy(F.asc("v"), F.asc_nulls_first("sample_no")).rowsBetween(*so_far)
    down = Window.partitionBy("cell").orderBy(F.desc("v"), F.asc_nulls_first("sample_no")).rowsBetween(*so_far)
    placed = both.withColumn("prev", F.last("x", True).over(up)).withColumn("next", F.last("x", True).over(down)).where("sample_no IS NOT NULL").join(F.broadcast(near), "cell")
    two = placed.select("sample_no", "v", F.explode(F.array(F.coalesce("prev", "before"), F.coalesce("next", "after"))).alias("y")).where("y IS NOT NULL")
    return two.groupBy("sample_no").agg(F.min_by("y.id", F.struct(F.round(F.abs(F.col("v") - F.col("y.cdf")), 12), -F.col("y.cdf"))).alias("id"))


def guided_sample(pdf: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """round, id: n distinct rows whose place in the CDF is nearest to truncated-normal draws.

    Each round makes twice as many draws as the one before. Rows whose share is below what draws can tell apart are never
    reached; an error is raised if three rounds on end find nothing new, so that a sample is never short.
    """
    from granary.operators.scoring import score_cdf

    cdf = cut(score_cdf(pdf).select("id", "cdf", "rank"), "cdf")
    found, have, idle, r = None, 0, 0, 0
    while have < n:
        draws = truncated_normal(pdf.sparkSession, n << min(r, 6), seed=seed + r)
        new = nearest_pick(cdf, draws).select(F.lit(r).alias("round"), "id")
        found = cut((new if found is None else found.unionByName(new)).groupBy("id").agg(F.min("round").alias("round")), "picked")
        now, r = found.count(), r + 1
        idle = idle + 1 if now == have else 0
        if idle == 3:
            raise ValueError(f"only {now} of {n} rows can be reached")
        have = now
    return found.orderBy("round", "id").limit(n).select("round", "id")


#: So many examples are carried in the plan; more are joined.
FEW = 1000


def few_shot(entries: DataFrame, examples: DataFrame, id_column: str, example_id: str, k: int = 3, seed: str = "0") -> DataFrame:
    """id, example_id, place: k examples for each entry in hash order. Up to FEW examples, whose ids are an array in the plan, nothing is shuffled; above, entries and examples are joined."""
    e = examples.select(F.col(example_id).alias("example_id"))
    ids = [r[0] for r in e.limit(FEW + 1).collect()]
    rows = entries.select(F.col(id_column).alias("id"))
    if len(ids) <= FEW:
        kind = dict(e.dtypes)["example_id"]
        drawn = F.transform(F.array(*map(F.lit, ids)).cast(f"array<{kind}>"), lambda x: F.struct(hash_order(seed, F.col("id"), x).alias("h"), x.alias("example_id")))
        return rows.select("id", F.posexplode(F.slice(F.array_sort(drawn), 1, k)).alias("pos", "x")).select("id", F.col("x.example_id").alias("example_id"), (F.col("pos") + 1).alias("place"))
    place = F.row_number().over(Window.partitionBy("id").orderBy(hash_order(seed, F.col("id"), F.col("example_id")), "example_id"))
    return rows.crossJoin(e).withColumn("place", place).where(F.col("place") <= k)
