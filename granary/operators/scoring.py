"""Word statistics, information scores, multipliers, PDF and CDF of scores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from granary.functions import text as X
from granary.session import cut

#: Multiplier where a name has exactly the mean ratio, for which the formula divides by zero.
MULTIPLIER_CAP = 1e6


def words(df: DataFrame, id_column: str, text: Column) -> DataFrame:
    """id, pos, word."""
    return df.select(F.col(id_column).alias("id"), F.posexplode(X.tokens(text)).alias("pos", "word"))


def word_counts(spread: DataFrame) -> DataFrame:
    return spread.groupBy("word").agg(F.count("*").alias("n"))


def entropy(counts: DataFrame) -> DataFrame:
    """entropy in bits, and the same over the number of distinct words. One pass over the counts: H = log2 T - sum(n log2 n) / T."""
    total = F.sum("n")
    h = F.log2(total) - F.sum(F.col("n") * F.log2("n")) / total
    return counts.agg(h.alias("h"), F.count("*").alias("d"), total.alias("t")).select(F.round("h", 6).alias("entropy"), F.round(F.col("h") / F.col("d"), 6).alias("per_word"))


def _by_document(spread: DataFrame) -> DataFrame:
    """id, word, n, avg_pos, len, q_n, total: a word's counts in its row and in the corpus, which is counted once."""
    tf = spread.groupBy("id", "word").agg(F.count("*").alias("n"), F.avg("pos").alias("avg_pos"))
    corpus = tf.groupBy("word").agg(F.sum("n").alias("q_n"))
    total = corpus.agg(F.sum("q_n").alias("total"))
    length = F.sum("n").over(Window.partitionBy("id")).alias("len")
    return tf.select("*", length).join(corpus, "word").crossJoin(F.broadcast(total))


def kl_average(spread: DataFrame) -> DataFrame:
    """id, score: mean over a row's distinct words of p log2(p / q)."""
    p, q = F.col("n") / F.col("len"), F.col("q_n") / F.col("total")
    return _by_document(spread).groupBy("id").agg(F.round(F.avg(p * F.log2(p / q)), 6).alias("score"))


def kl_corrected(spread: DataFrame) -> DataFrame:
    """id, score: kl_average with less weight for late words, paths and numbers. Rows without words have no score."""
    p, q = F.col("n") / F.col("len"), F.col("q_n") / F.col("total")
    pos = F.when(F.col("len") > 2, F.col("avg_pos") / (F.col("len") - 1)).otherwise(F.lit(0.0))
    late = 1 - 0.8 / (1 + F.exp(-(10 * pos - 5)))
    path = F.pow(F.lit(0.5), F.length("word") - F.length(F.replace("word", F.lit("/"), F.lit(""))))
    number = F.when(F.col("word").rlike(r"^\p{N}+$"), F.pow(F.lit(0.07), F.col("n"))).otherwise(1.0)
    return _by_document(spread).groupBy("id").agg(F.round(F.avg(late * path * number * p * F.log2(p / q)), 6).alias("score"))


def name_ratio(df: DataFrame, base: DataFrame, name: str = "command_name") -> DataFrame:
    """name, n, base_n, ratio: 1 where the base has none."""
    a = df.groupBy(name).agg(F.count("*").alias("n"))
    b = base.groupBy(F.col(name).alias("base_name")).agg(F.count("*").alias("base_n"))
    return a.join(b, F.col(name) == F.col("base_name"), "left").select(name, "n", F.coalesce("base_n", F.lit(0)).alias("base_n"), F.coalesce(F.col("n") / F.col("base_n"), F.lit(1.0)).alias("ratio"))


def adaptive_multiplier(ratios: DataFrame, name: str = "command_name") -> DataFrame:
    """name, multiplier: rare names of the geometric mean's distance d get 10/d, frequent ones 0.05 d."""
    mean = ratios.agg(F.exp(F.avg(F.log("ratio"))).alias("g"))
    d = F.abs(F.col("ratio") - F.col("g"))
    m = F.when(F.col("ratio") < F.col("g"), 0.05 * d).when(d < 1e-12, MULTIPLIER_CAP).otherwise(10 / F.when(d >= 1e-12, d))
    return ratios.crossJoin(F.broadcast(mean)).select(name, m.alias("multiplier"))


def multiplied(scored: DataFrame, names: DataFrame, multipliers: DataFrame, name: str = "command_name") -> DataFrame:
    """scored with weighted: each score times the multiplier of its row's name. names: id, name. A name is aggregated to one row, so a hot one costs no more than its rows."""
    m = multipliers.select(F.col(name).alias("__name"), "multiplier")
    return scored.join(names.select("id", name), "id").join(m, F.col(name).eqNullSafe(F.col("__name"))).select("id", "score", (F.col("score") * F.col("multiplier")).alias("weighted"))


def score_pdf(scored: DataFrame, value: str = "score") -> DataFrame:
    """id, score, pdf: values shifted to a least of 0 and divided by their sum. Equal values have equal shares."""
    stats = scored.agg(F.min(value).alias("low"), (F.sum(value) - F.count("*") * F.min(value)).alias("sum"), F.count("*").alias("rows"))
    return scored.crossJoin(F.broadcast(stats)).select("id", "score", F.when(F.col("sum") > 0, (F.col(value) - F.col("low")) / F.col("sum")).otherwise(1.0 / F.col("rows")).alias("pdf"))


def running_total(df: DataFrame, order: list[Column], value: str, out: str, rank: str | None = None) -> DataFrame:
    """A global running total (and rank) without a single-task window: rows are shuffled once, into ranges; each range is summed in order as it is written, and begins with the sum of those before it. Null values add nothing."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    at = ranged.columns.index(value)
    whole = dict(df.dtypes)[value] in ("tinyint", "smallint", "int", "bigint")
    kind = pa.int64() if whole else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = 0, 0
        for batch in batches:
            v = pc.fill_null(batch.column(at).cast(kind), 0).to_numpy(zero_copy_only=False)
            if v.size:
                sums = np.cumsum(np.concatenate([[total], v]))[1:]  # one after the other, as a window would
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, kind), pa.array(np.arange(rows + 1, rows + v.size + 1))], names=[*batch.schema.names, "__sum", "__row"])
                total, rows = sums[-1], rows + v.size

    summed = ranged.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in ranged.dtypes) + f", __sum {'bigint' if whole else 'double'}, __row bigint")
    ranges = cut(summed, "running")
    ends = ranges.groupBy("__part").agg(F.max_by("__sum", "__row").alias("__sum"), F.max("__row").alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = ends.select("__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__from"), F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__first"))
    total = ranges.join(F.broadcast(starts), "__part").withColumn(out, F.col("__from") + F.col("__sum"))
    if rank:
        total = total.withColumn(rank, F.col("__first") + F.col("__row"))
    return total.drop("__part", "__from", "__first", "__sum", "__row")


def score_cdf(pdf: DataFrame) -> DataFrame:
    """id, score, pdf, rank, cdf in the order of falling scores."""
    return running_total(pdf, [F.desc("score"), F.asc("id")], "pdf", "cdf", "rank")


def percentile_prefixes(ranked: DataFrame, fractions: int = 10) -> DataFrame:
    """fraction, rows, avg_score, entropy of the best fraction of rows, for 0, 1/n ... 1. ranked: id, score, rank.

    Each row falls into its first prefix; prefixes are running sums over the few fractions, so nothing is counted again.
    """
    total = ranked.agg(F.count("*").alias("total"))
    ids = F.broadcast(ranked.sparkSession.range(fractions + 1).withColumnRenamed("id", "step"))
    first = F.ceil(F.col("rank") * fractions / F.col("total")).cast("long")
    steps = ranked.crossJoin(F.broadcast(total)).withColumn("first", first).groupBy("first", "total").agg(F.count("*").alias("k"), F.sum("score").alias("s"))
    joined = ids.crossJoin(F.broadcast(total)).join(steps.drop("total"), F.col("first") <= F.col("step"), "left").groupBy("step").agg(F.coalesce(F.sum("k"), F.lit(0)).alias("rows"), F.round(F.sum("s") / F.sum("k"), 6).alias("avg_score"))
    return joined.select((F.col("step") / fractions).alias("fraction"), "rows", "avg_score", F.round(F.log2(F.col("rows")), 6).alias("row_entropy"))


def histogram(df: DataFrame, value: str, bins: int = 100, weight: str | None = None) -> DataFrame:
    """bin, n and the summed weight of equal-width bins."""
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    at = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)))
    w = F.sum(weight) if weight else F.count("*")
    return df.crossJoin(F.broadcast(ends)).groupBy(at.cast("int").alias("bin")).agg(F.count("*").alias("n"), F.round(w, 6).alias("weight"))
