"""Queries of the training-data problems: name -> function of (spark, sf_dir), each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from granary.llm import lookalike, neighbours, overlap, packing, pairs, residue, scanned, splitting, tokenize, truncation
from granary.session import table


REQUEST = ["objective", "question", "command"]


def chunks(spark: SparkSession, d: str) -> DataFrame:
    """table_name, row_id, chunk_no, text: the texts of book_subpart, entry and vector_record are brought to this form."""
    rows = table(spark, d, "book_subpart").select(F.lit("book_subpart").alias("table_name"), F.col("subpart_id").alias("row_id"), F.posexplode("content").alias("chunk_no", "text"))
    return rows.select("table_name", "row_id", "chunk_no", "text")


def one_text(spark: SparkSession, d: str, name: str, row_id: str, text: str) -> DataFrame:
    return table(spark, d, name).select(F.lit(name).alias("table_name"), F.col(row_id).alias("row_id"), F.lit(0).alias("chunk_no"), F.col(text).alias("text"))


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return neighbours.latest_vectors(table(spark, d, "vector_record"), "vec_id", "embedding", F.col("metadata.date_uploaded"))


def _repaired(spark: SparkSession, d: str) -> DataFrame:
    chunks_ = scanned.book_chunks(table(spark, d, "book_chapter"), table(spark, d, "book_part"), table(spark, d, "book_subpart"))
    return scanned.repaired(chunks_, ["table_name", "row_id", "chunk_no"])


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _repaired(spark, d).select("table_name", "row_id", "chunk_no", F.explode("noise").alias("noise")).distinct()


def p1_repaired(spark: SparkSession, d: str) -> DataFrame:
    return _repaired(spark, d).select("table_name", "row_id", "chunk_no", "text", F.array_join("noise", ",").alias("noise"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return neighbours.neighbour_pairs(neighbours.nearest(_vectors(spark, d)))


def p2_neighbours(spark: SparkSession, d: str) -> DataFrame:
    found = neighbours.nearest(_vectors(spark, d))
    return found.select(F.col("id").alias("vec_id"), "rank", F.col("neighbour").alias("neighbour_id"), F.round("similarity", 5).alias("similarity"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    pairs_, members = overlap.overlaps(table(spark, d, "entry"), "entry_id", REQUEST, "split_name")
    return overlap.row_pairs(pairs_, members).select(F.col("id_a").alias("entry_id_a"), F.col("id_b").alias("entry_id_b")).distinct()


def p3_by_split_source(spark: SparkSession, d: str) -> DataFrame:
    entry = table(spark, d, "entry")
    return overlap.overlap_report(*overlap.overlaps(entry, "entry_id", REQUEST, "split_name"), entry, "entry_id", "source")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return pairs.defects(table(spark, d, "entry"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_pieces(spark, d).where("piece_no = 0").select("table_name", "row_id", "chunk_no")


def p5_pieces(spark: SparkSession, d: str) -> DataFrame:
    texts = chunks(spark, d).unionByName(one_text(spark, d, "vector_record", "vec_id", "metadata.text"))
    long = texts.where(F.char_length("text") > splitting.LIMIT).distinct()  # repeated deliveries give the same pieces
    return splitting.split_long(long, ["table_name", "row_id", "chunk_no"], "text")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue(table(spark, d, "entry"), "entry_id", "question", "source", ("command", "objective")).select("entry_id")


def p6_clean(spark: SparkSession, d: str) -> DataFrame:
    return residue.without_residue(table(spark, d, "entry"), "entry_id", "question", "source", ("command", "objective")).select("entry_id", "question")


def _alike(spark: SparkSession, d: str) -> DataFrame:
    return one_text(spark, d, "entry", "entry_id", "description").unionByName(chunks(spark, d))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.faulty(_alike(spark, d), ["table_name", "row_id", "chunk_no"], "text").select("table_name", "row_id", "chunk_no").distinct()


def p7_one_form(spark: SparkSession, d: str) -> DataFrame:
    # a subpart that was delivered again has the same content: one row of it remains
    return lookalike.normalised(_alike(spark, d).dropDuplicates(["table_name", "row_id", "chunk_no"]), ["table_name", "row_id", "chunk_no"], "text")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenize.encode_table(table(spark, d, "documents"), "doc_id", "text")


def p9_containers(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return packing.pack_table(tokenize.encode_table(docs, "doc_id", "text"), "doc_id", total=docs.count())


def p9_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p9_containers(spark, d))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cut_documents(table(spark, d, "documents").select("doc_id", "text")).select("doc_id")


def p10_by_source(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    return truncation.cut_share(docs, truncation.cut_documents(docs))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_repaired, p2_found, p2_neighbours, p3_found, p3_by_split_source, p4_found, p5_found, p5_pieces, p6_found, p6_clean, p7_found, p7_one_form, p8_ids, p9_containers, p9_fill, p10_found, p10_by_source)
}
#: Exact SQL where there is one. The other operators can't be expressed in it; they are tested against brute force, exact round trips and held-out cases.
ORACLES: dict[str, str] = {
    "p2_found": """
        WITH v AS (SELECT vec_id, CAST(arg_max(embedding, metadata.date_uploaded) AS DOUBLE[]) AS v FROM vector_record GROUP BY vec_id),
             ok AS (SELECT vec_id, v FROM v WHERE v IS NOT NULL AND list_sum(list_transform(v, lambda x: abs(x))) > 0),
             top AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY list_cosine_similarity(a.v, b.v) DESC, b.vec_id) <= 10)
        SELECT DISTINCT least(a, b) AS vec_id_a, greatest(a, b) AS vec_id_b FROM top""",
    "p7_found": r"""
        WITH t AS (SELECT 'entry' AS table_name, entry_id AS row_id, 0 AS chunk_no, description AS text FROM entry
                   UNION ALL SELECT 'book_subpart', subpart_id, CAST(i - 1 AS INTEGER), content[i] FROM (SELECT subpart_id, content, unnest(range(1, len(content) + 1)) AS i FROM book_subpart))
        SELECT DISTINCT table_name, row_id, chunk_no FROM t
        WHERE regexp_matches(text, '[\x{FF01}-\x{FF5E}\p{M}\p{Cf}]') OR regexp_matches(replace(text, ' ', ''), '\p{Zs}')
           OR regexp_matches(regexp_replace(text, '\p{Cf}', '', 'g'), '\p{Latin}[\p{L}\p{M}]*[\p{Cyrillic}\p{Greek}\p{Armenian}]|[\p{Cyrillic}\p{Greek}\p{Armenian}][\p{L}\p{M}]*\p{Latin}')""",
    "p5_found": """
        SELECT DISTINCT 'book_subpart' AS table_name, subpart_id AS row_id, CAST(i - 1 AS INTEGER) AS chunk_no FROM (SELECT subpart_id, content, unnest(range(1, len(content) + 1)) AS i FROM book_subpart) WHERE length(content[i]) > 2000
        UNION SELECT 'vector_record', vec_id, 0 FROM vector_record WHERE length(metadata.text) > 2000""",
    "p3_found": """
        WITH w AS (SELECT entry_id, split_name, list_distinct(regexp_extract_all(lower(concat_ws(' ', objective, question, command)), '[a-z0-9]+')) AS words FROM entry),
             u AS (SELECT entry_id, split_name, len(words) AS n, unnest(words) AS word FROM w),
             s AS (SELECT a.entry_id AS x, b.entry_id AS y, any_value(a.n) AS m, any_value(b.n) AS n, count(*) AS k FROM u a JOIN u b ON a.word = b.word AND a.split_name = 'train' AND b.split_name IN ('validate', 'test') GROUP BY ALL)
        SELECT least(x, y) AS entry_id_a, greatest(x, y) AS entry_id_b FROM s WHERE k >= 0.8 * (m + n - k) - 1e-9""",
    "p3_by_split_source": """
        WITH w AS (SELECT entry_id, split_name, list_distinct(regexp_extract_all(lower(concat_ws(' ', objective, question, command)), '[a-z0-9]+')) AS words FROM entry),
             u AS (SELECT entry_id, split_name, len(words) AS n, unnest(words) AS word FROM w),
             s AS (SELECT a.entry_id AS x, b.entry_id AS y, any_value(a.n) AS m, any_value(b.n) AS n, count(*) AS k FROM u a JOIN u b ON a.word = b.word AND a.split_name = 'train' AND b.split_name IN ('validate', 'test') GROUP BY ALL)
        SELECT e.split_name, e.source, count(*) AS pairs, count(DISTINCT y) AS rows FROM s JOIN entry e ON e.entry_id = y WHERE k >= 0.8 * (m + s.n - k) - 1e-9 GROUP BY ALL""",
}
