"""Classification metrics and ROUGE."""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def macro_metrics(matrix: DataFrame) -> DataFrame:
    """accuracy and unweighted means over the labels of precision, recall and F1; an undefined part counts as 0."""
    m = matrix.select(F.explode(F.array(F.struct(F.col("label").alias("k"), F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0).alias("tp"), F.col("n").alias("t"), F.lit(0).cast("long").alias("p")), F.struct(F.col("predicted").alias("k"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("t"), F.col("n").alias("p")))).alias("x")).select("x.*")
    per = m.groupBy("k").agg(F.sum("tp").alias("tp"), F.sum("t").alias("t"), F.sum("p").alias("p"))
    precision, recall = F.when(F.col("p") > 0, F.col("tp") / F.col("p")).otherwise(0.0), F.when(F.col("t") > 0, F.col("tp") / F.col("t")).otherwise(0.0)
    f1 = F.when(F.col("tp") > 0, 2 * F.col("tp") / (F.col("t") + F.col("p"))).otherwise(0.0)
    return per.agg(F.round(F.sum("tp") / F.sum("t"), 6).alias("accuracy"), F.round(F.avg(precision), 6).alias("precision"), F.round(F.avg(recall), 6).alias("recall"), F.round(F.avg(f1), 6).alias("f1"))


def _f_measure(hits: int, n: int, m: int) -> float:
    return round(2 * hits / (n + m), 6) if hits else 0.0


def _of_pairs(df: DataFrame, id_column: str, reference: str, candidate: str, score) -> DataFrame:
    """id, rouge: score(words of the reference, words of the candidate) of each row, in Arrow batches: both texts are in one row, so nothing is shuffled."""
    w = lambda c: F.regexp_extract_all(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))

    def run(batches):
        for batch in batches:
            scores = [score(r, c) for r, c in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["id", "rouge"])

    return df.select(F.col(id_column).alias("id"), w(reference).alias("r"), w(candidate).alias("c")).mapInArrow(run, f"id {dict(df.dtypes)[id_column]}, rouge double")


def rouge_n(df: DataFrame, id_column: str, reference: str, candidate: str, n: int = 1) -> DataFrame:
    """id, rouge: F-measure of n-gram multisets, words of a-z and 0-9 in lower case. Pairs without common n-grams have 0."""
    def score(r: list, c: list) -> float:
        a, b = (Counter(zip(*(words[i:] for i in range(n)))) for words in (r, c))
        return _f_measure(sum((a & b).values()), a.total(), b.total())

    return _of_pairs(df, id_column, reference, candidate, score)


def lcs_length(a: list, b: list) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def rouge_l(df: DataFrame, id_column: str, reference: str, candidate: str) -> DataFrame:
    """id, rouge: F-measure of the longest common subsequence of words."""
    return _of_pairs(df, id_column, reference, candidate, lambda r, c: _f_measure(lcs_length(r, c), len(r), len(c)))


def _lcs_places(a: list, b: list) -> set[int]:
    """Positions in a of a longest common subsequence with b."""
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            t[i][j] = t[i - 1][j - 1] + 1 if x == y else max(t[i - 1][j], t[i][j - 1])
    i, j, places = len(a), len(b), set()
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            places.add(i)
        elif t[i][j - 1] > t[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return places


def rouge_lsum(reference: str | None, candidate: str | None) -> float:
    """ROUGE-Lsum of a pair: F-measure of the union of each reference line's common subsequences with all candidate lines; a word counts as often as both texts have it."""
    ref, can = ([w for line in (t or "").lower().split("\n") if (w := re.findall("[a-z0-9]+", line))] for t in (reference, candidate))
    has, may = (Counter(w for line in lines for w in line) for lines in (ref, can))
    hits = 0
    for line in ref:
        for i in sorted(set().union(*(_lcs_places(line, c) for c in can))):
            if has[line[i]] > 0 and may[line[i]] > 0:
                hits += 1
                has[line[i]] -= 1
                may[line[i]] -= 1
    return round(2 * hits / (sum(map(len, ref)) + sum(map(len, can))), 6) if hits else 0.0


def rouge_lsum_table(df: DataFrame, id_column: str, reference: str, candidate: str) -> DataFrame:
    """id, rouge: ROUGE-Lsum of each pair, in Arrow batches."""
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "rouge": [rouge_lsum(r, c) for r, c in zip(pdf["r"], pdf["c"])]})

    return df.select(F.col(id_column).alias("id"), F.col(reference).alias("r"), F.col(candidate).alias("c")).mapInPandas(run, f"id {dict(df.dtypes)[id_column]}, rouge double")
