"""Readers and writers, with explicit schemas and no inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from granary import schemas


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array (or lines) of entries; unknown fields are dropped and malformed rows fail."""
    return spark.read.schema(schemas.ENTRY).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_few_shot(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object with a field examples."""
    from pyspark.sql import types as T

    root = T.StructType([T.StructField("examples", T.ArrayType(schemas.FEW_SHOT))])
    return spark.read.schema(root).option("multiLine", True).json(path).select(F.inline("examples"))


def read_rule_set(spark: SparkSession, path: str) -> DataFrame:
    """ordinal, rule, values in the order of the file, which breaks ties of priority."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.from_json("value", schemas.RULE_SET).alias("m")).select(F.posexplode(F.map_entries("m")).alias("ordinal", "e")).select("ordinal", F.col("e.key").alias("rule"), F.col("e.value").alias("values"))


def read_toc(spark: SparkSession, path: str) -> DataFrame:
    """chapter_no, chapter, part_no, part, parts of a table of contents."""
    toc = spark.read.schema(schemas.TOC).option("multiLine", True).json(path)
    chapters = toc.select(F.posexplode("chapter_metadata").alias("chapter_no", "c")).select("chapter_no", F.col("c.title").alias("chapter"), F.posexplode_outer("c.parts").alias("part_no", "p"))
    return chapters.select("chapter_no", "chapter", "part_no", F.col("p.title").alias("part"), F.col("p.parts").alias("subparts"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """path, text of whole files, as a stand-in for fetched pages and extracted documents."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def read_binary(spark: SparkSession, path: str) -> DataFrame:
    """path, length, content of images and other files."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "content")


def extract_pages(binaries: DataFrame, extractor) -> DataFrame:
    """path, pages: what an extractor (bytes -> list of page texts) makes of each file; a file that it fails on has null pages. Files that can't be read don't stop the others."""
    def run(batches):
        for pdf in batches:
            pages = []
            for content in pdf.pop("content"):
                try:
                    pages.append([str(p) for p in extractor(bytes(content))])
                except Exception:  # noqa: BLE001 - any failure of a file is that file's
                    pages.append(None)
            pdf["pages"] = pages
            yield pdf

    return binaries.select("path", "content").mapInPandas(run, "path string, pages array<string>")


def search_web(asked: DataFrame, search) -> DataFrame:
    """query_id, rank, text: the hits of a search boundary (question -> list of snippets) for each question; a search that fails has none. asked: query_id, prompt."""
    kind = dict(asked.dtypes)["query_id"]

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = []
            for query_id, prompt in zip(pdf["query_id"], pdf["prompt"]):
                try:
                    hits = list(search(prompt))
                except Exception:  # noqa: BLE001 - a search without an answer gives no documentation
                    hits = []
                rows += [(query_id, i + 1, h) for i, h in enumerate(hits)]
            yield pd.DataFrame(rows, columns=["query_id", "rank", "text"])

    return asked.select("query_id", "prompt").mapInPandas(run, f"query_id {kind}, rank int, text string")


def from_page(df: DataFrame, pages: str, first: int = 15) -> DataFrame:
    """The pages from number `first` on, each after a blank line. pages: an array of texts."""
    return df.select("*", F.posexplode(pages).alias("page_no", "page")).where(F.col("page_no") >= first).withColumn("page", F.concat(F.lit("\n"), "page"))


def write_entries(df: DataFrame, path: str) -> None:
    """JSON lines of the entry columns."""
    df.select(*schemas.ENTRY.fieldNames()).write.mode("overwrite").json(path)


def write_splits(df: DataFrame, path: str, split: str) -> None:
    """One parquet folder for each split."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def write_report(df: DataFrame, path: str, column: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


class VectorIndex:
    """A vector table in a folder: create, drop, describe, upsert by id (the latest upload counts)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _versions(self) -> list[str]:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(s.getPath().getName() for s in fs.listStatus(hadoop)) if fs.exists(hadoop) else []

    def exists(self) -> bool:
        return bool(self._versions())

    def create(self, df: DataFrame, replace: bool = True) -> int:
        """Writes the table; with replace=False an existing one is kept. The number of rows."""
        if not replace and self.exists():
            return 0
        return self._write(df)

    def _write(self, df: DataFrame) -> int:
        done = self._versions()
        df.write.mode("overwrite").parquet(f"{self.path}/v{int(done[-1][1:]) + 1 if done else 0:06d}")
        return self.read().count()

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{self._versions()[-1]}")

    def upsert(self, df: DataFrame, id_column: str, version) -> int:
        """A new version of the table; readers of the one before aren't disturbed. The number of rows delivered."""
        from granary.operators.retrieval import upsert

        n = df.count()
        self._write(upsert(self.read(), df, id_column, version) if self.exists() else df)
        return n

    def describe(self) -> DataFrame:
        return self.read().agg(F.count("*").alias("vectors"), F.max(F.size("embedding")).alias("dimension"))

    def drop(self) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)
