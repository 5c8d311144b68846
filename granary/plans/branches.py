"""More queries of the core: operators on inputs that reach every branch, built from the columns of the tables, and the rest of the operator list."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from granary.functions import text as X
from granary.operators import dedupe, evaluate, prompts, retrieval, sampling, scoring, segment
from granary.plans.catalogue import _CHUNKS, _CUT, _KL, _MULTIPLIED, _RATIO, _RERANK, _STRIP, _TOK, _WHOLE, _chunks, _entry, _hits, _multiplied, _ratios, _rouge_sql, query
from granary.session import table
from granary.streaming import events as streams

# --- cleaning, on texts that are built so that each rule has rows to act on


_ASKED = """asked AS (SELECT entry_id, CASE entry_id % 7 WHEN 0 THEN 'To begin, ' || question WHEN 1 THEN 'Please use the following command: ' || question WHEN 2 THEN 'run the following command: ' || question WHEN 3 THEN 'An INSTRUCTION for ' || question
 WHEN 4 THEN 'The Following Command of ' || question WHEN 5 THEN question || '. ' || repeat(question, 4) ELSE question || chr(10) || repeat(question, 4) END AS question FROM entry WHERE question IS NOT NULL)"""


def _asked(spark, d):
    q = F.col("question")
    begin = {0: F.concat(F.lit("To begin, "), q), 1: F.concat(F.lit("Please use the following command: "), q), 2: F.concat(F.lit("run the following command: "), q), 3: F.concat(F.lit("An INSTRUCTION for "), q), 4: F.concat(F.lit("The Following Command of "), q), 5: F.concat(q, F.lit(". "), F.repeat(q, 4))}
    built = F.concat(q, F.lit("\n"), F.repeat(q, 4))
    for k, value in begin.items():
        built = F.when(F.col("entry_id") % 7 == k, value).otherwise(built)
    return _entry(spark, d, "entry_id", "question").where("question IS NOT NULL").select("entry_id", built.alias("question"))


_FIRST_OF = "least(CASE WHEN instr(question, '. ') > 0 THEN instr(question, '. ') ELSE length(question) + 1 END, CASE WHEN instr(question, chr(10)) > 0 THEN instr(question, chr(10)) ELSE length(question) + 1 END)"


@query(f"""WITH {_ASKED}, cut AS (SELECT entry_id, length(question) >= 128 AS long, CASE WHEN length(question) < 128 THEN question ELSE left(question, {_FIRST_OF} - 1) END AS question FROM asked)
 SELECT entry_id, question, CASE WHEN contains(question, 'use the following command:') OR contains(question, 'run the following command:') THEN 'phrase' WHEN starts_with(question, 'To') THEN 'prefix' WHEN contains(lower(question), 'instruction') OR contains(lower(question), 'following command') THEN 'word' WHEN long THEN 'cut' ELSE 'kept' END AS rule FROM cut""")
def clean_rules(spark, d):
    """Which rule of the question cleanup meets each built question."""
    q = _asked(spark, d).select("entry_id", (F.length("question") >= 128).alias("long"), X.first_statement(F.col("question")).alias("question"))
    c = F.col("question")
    rule = F.when(c.contains("use the following command:") | c.contains("run the following command:"), "phrase").when(c.startswith("To"), "prefix").when(F.lower(c).contains("instruction") | F.lower(c).contains("following command"), "word").when(F.col("long"), "cut").otherwise("kept")
    return q.select("entry_id", "question", rule.alias("rule"))


@query("SELECT entry_id, CAST(row_number() OVER (ORDER BY length(question) >= 128, entry_id) AS BIGINT) AS place, length(question) >= 128 AS trimmed FROM entry WHERE question IS NOT NULL")
def ok_rows_first(spark, d):
    """Short questions, then those that were trimmed, numbered in one order without a window over the whole table."""
    e = _entry(spark, d, "entry_id", "question").where("question IS NOT NULL").select("entry_id", (F.length("question") >= 128).alias("trimmed"), F.lit(1).alias("one"))
    short, long = e.where("NOT trimmed"), e.where("trimmed")
    placed = scoring.running_total(short.unionByName(long), [F.asc("trimmed"), F.asc("entry_id")], "one", "place")
    return placed.select("entry_id", F.col("place").cast("long").alias("place"), "trimmed")


@query("SELECT entry_id, length(chain_of_thought) AS n FROM entry WHERE chain_of_thought IS NOT NULL ORDER BY n DESC, entry_id LIMIT 1")
def longest_reasoning(spark, d):
    e = _entry(spark, d, "entry_id", "chain_of_thought").where("chain_of_thought IS NOT NULL")
    return e.agg(F.max(F.struct(F.length("chain_of_thought").alias("n"), (-F.col("entry_id")).alias("id"))).alias("x")).select((-F.col("x.id")).alias("entry_id"), F.col("x.n").cast("long").alias("n"))


_PARTS = "SELECT entry_id, CASE entry_id % 3 WHEN 0 THEN chr(10) || '  ' || chr(10) || ' ' || chain_of_thought || ' ' || chr(10) || ' ' || chr(10) || command WHEN 1 THEN repeat(chain_of_thought || chr(10), 20) ELSE ' ' || chr(10) || chr(10) || ' ' END AS chain_of_thought FROM entry WHERE chain_of_thought IS NOT NULL"
_BUILT_LINES = f"list_transform(string_split(chain_of_thought, chr(10)), lambda x: {_STRIP.format('x')})"
_BUILT = f"""para AS (SELECT entry_id, CASE WHEN s IS NULL THEN '' ELSE array_to_string(CASE WHEN b IS NULL THEN rest ELSE list_slice(rest, 1, b - 1) END, chr(10)) END AS cot
 FROM (SELECT *, nullif(list_position(rest, ''), 0) AS b FROM (SELECT *, CASE WHEN s IS NULL THEN l ELSE list_slice(l, s, len(l)) END AS rest FROM (SELECT entry_id, l, nullif(list_position(list_transform(l, lambda x: x <> ''), true), 0) AS s FROM (SELECT entry_id, {_BUILT_LINES} AS l FROM ({_PARTS}))))))"""


@query(f"WITH {_BUILT} SELECT entry_id, cot, length(cot) <= 2000 AS kept FROM para")
def first_paragraph_built(spark, d):
    """Texts with leading blank lines, a second paragraph, far too long, or of blanks alone."""
    c, k = F.col("chain_of_thought"), F.col("entry_id") % 3
    built = F.when(k == 0, F.concat(F.lit("\n  \n "), c, F.lit(" \n \n"), F.col("command"))).when(k == 1, F.repeat(F.concat(c, F.lit("\n")), 20)).otherwise(" \n\n ")
    e = _entry(spark, d, "entry_id", "chain_of_thought", "command").where("chain_of_thought IS NOT NULL")
    return e.select("entry_id", X.first_paragraph(built).alias("cot")).select("entry_id", "cot", (F.length("cot") <= 2000).alias("kept"))


_FLAG_LIST = "[" + ", ".join("'" + f.replace("'", "''") + "'" for f in X.RED_FLAGS) + "]"
_FLAGGED = f"para AS (SELECT entry_id, 'one' || chr(10) || CASE WHEN entry_id % 5 = 0 THEN {_FLAG_LIST}[1 + entry_id % {len(X.RED_FLAGS)}] ELSE 'two' END || chr(10) || command || chr(10) || CASE WHEN entry_id % 3 > 0 THEN upper({_FLAG_LIST}[1 + entry_id % {len(X.RED_FLAGS)}]) ELSE 'four' END || chr(10) || CASE WHEN entry_id % 4 > 1 THEN {_FLAG_LIST}[1 + (entry_id + 1) % {len(X.RED_FLAGS)}] ELSE 'five' END || chr(10) || chain_of_thought || chr(10) || {_FLAG_LIST}[1 + (entry_id + 2) % {len(X.RED_FLAGS)}] || chr(10) || repeat(command || chr(10), 8) AS cot FROM entry WHERE chain_of_thought IS NOT NULL AND command IS NOT NULL)"


@query(f"WITH {_FLAGGED}, {_CUT} SELECT entry_id, cot, CASE WHEN length(cot) > 500 THEN {_WHOLE('left(cot, 500)')} ELSE {_STRIP.format('cot')} END AS capped FROM cutted")
def redflag_built(spark, d):
    """Red flags on chosen lines, before and after the third, and texts beyond the cap."""
    i = F.col("entry_id")
    flag = lambda by: F.get(F.array(*map(F.lit, X.RED_FLAGS)), ((i + by) % len(X.RED_FLAGS)).cast("int"))
    built = F.concat(F.lit("one\n"), F.when(i % 5 == 0, flag(0)).otherwise("two"), F.lit("\n"), F.col("command"), F.lit("\n"), F.when(i % 3 > 0, F.upper(flag(0))).otherwise("four"), F.lit("\n"), F.when(i % 4 > 1, flag(1)).otherwise("five"), F.lit("\n"), F.col("chain_of_thought"), F.lit("\n"), flag(2), F.lit("\n"), F.repeat(F.concat("command", F.lit("\n")), 8))
    e = _entry(spark, d, "entry_id", "chain_of_thought", "command").where("chain_of_thought IS NOT NULL AND command IS NOT NULL")
    return e.select("entry_id", X.red_flag_cut(built).alias("cot")).select("entry_id", "cot", X.cap_lines(F.col("cot")).alias("capped"))


@query(rf"WITH {_CHUNKS} SELECT subpart_id, chunk_no, regexp_replace('Figure ' || subpart_id || '-' || chunk_no || '. A caption' || chr(10) || text || chr(10) || 'Figure 3-1 has none' || chr(10) || 'Figure 12-4. Another', '(?m)^Figure [0-9]+-[0-9]+\..*$', '', 'g') AS text FROM chunks")
def figure_captions_built(spark, d):
    built = F.concat(F.lit("Figure "), F.col("subpart_id").cast("string"), F.lit("-"), F.col("chunk_no").cast("string"), F.lit(". A caption\n"), F.col("text"), F.lit("\nFigure 3-1 has none\nFigure 12-4. Another"))
    return _chunks(spark, d).withColumn("text", X.drop_figures(built))


@query(rf"WITH {_CHUNKS} SELECT subpart_id, chunk_no, array_to_string(list_transform(string_split('# ' || subpart_id || chr(10) || '---' || chr(10) || '  ## ' || text || chr(10) || '-', chr(10)), lambda x: CASE WHEN regexp_full_match(x, '-*') THEN replace(x, '-', '_') ELSE regexp_replace(x, '^( *)#', '\1\\#') END), '  ' || chr(10)) AS text FROM chunks")
def markdown_built(spark, d):
    built = F.concat(F.lit("# "), F.col("subpart_id").cast("string"), F.lit("\n---\n  ## "), F.col("text"), F.lit("\n-"))
    return _chunks(spark, d).withColumn("text", X.markdown(built))


# --- rows and sets


@query("SELECT entry_id, copy FROM (SELECT entry_id, unnest(range(0, 12)) AS copy FROM entry) ORDER BY entry_id, copy LIMIT 19800")
def limit_of_copies(spark, d):
    return _entry(spark, d, "entry_id").select("entry_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(11).cast("long"))).alias("copy")).orderBy("entry_id", "copy").limit(19_800)


@query("SELECT vec_id, max(metadata.date_uploaded) AS date_uploaded, count(*) > 1 AS replaced, round(list_sum(list_transform(arg_max(embedding, metadata.date_uploaded), lambda x: CAST(x AS DOUBLE))), 4) AS total FROM vector_record GROUP BY vec_id")
def vector_upsert_replaced(spark, d):
    """The first upload of each id is the index; all later ones are upserted over it."""
    v = table(spark, d, "vector_record").select("vec_id", F.col("metadata.date_uploaded").alias("date_uploaded"), F.round(F.aggregate(F.transform("embedding", lambda x: x.cast("double")), F.lit(0.0), lambda a, x: a + x), 4).alias("total"))
    placed = v.withColumn("n", F.row_number().over(Window.partitionBy("vec_id").orderBy("date_uploaded")))
    first, later = placed.where("n = 1").drop("n"), placed.where("n > 1").drop("n")
    ids = later.select("vec_id").distinct().withColumn("replaced", F.lit(True))
    return retrieval.upsert(first, later, "vec_id", F.col("date_uploaded")).join(ids, "vec_id", "left").withColumn("replaced", F.coalesce("replaced", F.lit(False)))


@query("SELECT event_id FROM events")
def events_stream_dedupe_repeated(spark, d):
    """Every event arrives three times in the stream; one of each remains."""
    stream = streams.stream_of(spark, d, "events").withColumn("copy", F.explode(F.array(*map(F.lit, range(3)))))
    return streams.run_to_end(streams.first_of_key(stream, "ts", ["event_id"])).select("event_id")


@query("SELECT example_id, CASE WHEN coalesce(specific, false) THEN 'specific' ELSE 'general' END AS part FROM few_shot_example")
def example_partition(spark, d):
    """The filter and its complement: no example is in both or in none."""
    ex = table(spark, d, "few_shot_example").withColumn("specific", F.coalesce("specific", F.lit(False)))
    return ex.where("specific").select("example_id", F.lit("specific").alias("part")).unionByName(ex.where("NOT specific").select("example_id", F.lit("general").alias("part")))


@query(f"WITH t AS (SELECT entry_id, {_TOK.format('command')} AS t FROM entry) SELECT entry_id, i - 1 AS pos, t[i] AS a, t[i + 1] AS b FROM (SELECT entry_id, t, unnest(range(1, len(t))) AS i FROM t)")
def adjacent_tokens(spark, d):
    """Neighbouring tokens within the row, without a window."""
    t = _entry(spark, d, "entry_id", "command").select("entry_id", X.tokens(F.col("command")).alias("t")).where("size(t) > 1")
    pairs = F.arrays_zip(F.slice("t", F.lit(1), F.size("t") - 1).alias("a"), F.slice("t", F.lit(2), F.size("t") - 1).alias("b"))
    return t.select("entry_id", F.posexplode(pairs).alias("pos", "x")).select("entry_id", F.col("pos").cast("long").alias("pos"), F.col("x.a").alias("a"), F.col("x.b").alias("b"))


@query("SELECT count(*) AS rows, count(*) AS ids, true AS well_formed FROM entry")
def unique_ids(spark, d):
    ids = _entry(spark, d, "entry_id").withColumn("uid", F.expr("uuid()"))
    return ids.agg(F.count("*").alias("rows"), F.count_distinct("uid").alias("ids"), F.bool_and(F.col("uid").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).alias("well_formed"))


@query("SELECT entry_id, split_name, (n - 1) // 100 AS batch_no, (n - 1) % 100 AS place FROM (SELECT entry_id, split_name, row_number() OVER (PARTITION BY split_name ORDER BY CASE WHEN split_name = 'train' THEN md5('0|' || entry_id) ELSE '' END, entry_id) AS n FROM entry)")
def mini_batches(spark, d):
    """Batches of 100 rows of each split; train alone is shuffled. Rows are numbered by ranges, not by a window over a split."""
    e = _entry(spark, d, "entry_id", "split_name").withColumn("order", F.when(F.col("split_name") == "train", sampling.hash_order("0", F.col("entry_id"))).otherwise("")).withColumn("one", F.lit(1))
    run = scoring.running_total(e, [F.asc("split_name"), F.asc("order"), F.asc("entry_id")], "one", "n")
    starts = run.groupBy(F.col("split_name").alias("__split")).agg(F.min("n").alias("first"))  # as many rows as there are splits
    placed = run.join(F.broadcast(starts), F.col("split_name").eqNullSafe(F.col("__split"))).select("entry_id", "split_name", (F.col("n") - F.col("first")).cast("long").alias("at"))
    return placed.select("entry_id", "split_name", F.floor(F.col("at") / 100).alias("batch_no"), (F.col("at") % 100).alias("place"))


@query("WITH b AS (SELECT event_id // 100 AS batch_no, avg(value) AS loss FROM events GROUP BY 1) SELECT batch_no, round(loss, 6) AS loss, round(sum(loss) OVER w / count(*) OVER w, 6) AS running FROM b WINDOW w AS (ORDER BY batch_no ROWS UNBOUNDED PRECEDING)")
def running_loss(spark, d):
    """The mean loss of the batches so far."""
    b = table(spark, d, "events").groupBy(F.floor(F.col("event_id") / 100).alias("batch_no")).agg(F.avg("value").alias("loss"))
    run = scoring.running_total(b, [F.asc("batch_no")], "loss", "total", "rank")
    return run.select("batch_no", F.round("loss", 6).alias("loss"), F.round(F.col("total") / F.col("rank"), 6).alias("running"))


@query("WITH v AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM vector_record WHERE embedding IS NOT NULL) SELECT round((SELECT avg(list_avg(v)) FROM v), 6) AS mean_of_means, round((SELECT stddev_pop(x) FROM (SELECT unnest(v) AS x FROM v)), 6) AS sd")
def value_stats(spark, d):
    """The mean of the rows' means and the population deviation of all values, from sums within rows: nothing is exploded."""
    v = table(spark, d, "vector_record").where("embedding IS NOT NULL").select(F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    s = v.select(F.size("v").alias("n"), F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("s"), F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x).alias("q"))
    mean = F.sum("s") / F.sum("n")
    return s.agg(F.round(F.avg(F.col("s") / F.col("n")), 6).alias("mean_of_means"), F.round(F.sqrt(F.sum("q") / F.sum("n") - mean * mean), 6).alias("sd"))


# --- scores with multipliers


@query(f"WITH {_RATIO} SELECT command_name, n, base_n, round(CASE WHEN base_n > 0 THEN n / base_n ELSE 0 END, 6) AS ratio FROM (SELECT command_name, n, CASE WHEN command_name LIKE 'g%' THEN 0 ELSE base_n END AS base_n FROM ratios)")
def name_ratio_report(spark, d):
    """The report's ratio, 0 where the base has none of a name: here the base is without the names that begin with g."""
    e = _entry(spark, d, "command_name", "split_name")
    base = e.where("split_name = 'train' AND NOT startswith(command_name, 'g')")
    return scoring.name_ratio(e, base).select("command_name", "n", "base_n", F.round(F.when(F.col("base_n") > 0, F.col("ratio")).otherwise(0.0), 6).alias("ratio"))


_WEIGHTED_CDF = _MULTIPLIED + """, ws AS (SELECT min(weighted) AS low, sum(weighted) - count(*) * min(weighted) AS s FROM ml), wp AS (SELECT id, score, (weighted - low) / s AS pdf FROM ml CROSS JOIN ws),
 wc AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS rank, sum(pdf) OVER (ORDER BY score DESC, id ROWS UNBOUNDED PRECEDING) AS cdf FROM wp)"""


@query(f"WITH {_WEIGHTED_CDF} SELECT id AS entry_id, rank, round(cdf, 6) AS cdf FROM wc")
def multiplied_cdf(spark, d):
    """The CDF from which rows are drawn: shares of the multiplied scores, in the order of the plain ones."""
    cdf = scoring.score_cdf(scoring.score_pdf(_multiplied(spark, d), "weighted"))
    return cdf.select(F.col("id").alias("entry_id"), F.col("rank").cast("long").alias("rank"), F.round("cdf", 6).alias("cdf"))


# --- tokens, labels, evaluation


_LENGTH, _PAD = 128, 0
_VOCABULARY = f"tk AS (SELECT entry_id, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM (SELECT entry_id, {_TOK.format('command')} AS t FROM entry)), vo AS (SELECT w, row_number() OVER (ORDER BY count(*) DESC, w) AS id FROM tk GROUP BY w)"


@query(f"""WITH {_VOCABULARY}, x AS (SELECT entry_id, list(vo.id ORDER BY i) AS ids FROM tk JOIN vo USING (w) WHERE i <= {_LENGTH} GROUP BY entry_id)
 SELECT entry_id, array_to_string(list_concat(ids, list_transform(range(len(ids), {_LENGTH}), lambda k: {_PAD})), ' ') AS input_ids, len(ids) AS attended, array_to_string(list_concat(ids, list_transform(range(len(ids), {_LENGTH}), lambda k: -100)), ' ') AS labels FROM x""")
def token_ids(spark, d):
    """Commands as ids of a vocabulary in order of frequency, cut and padded to 128, with the length of the attention mask and labels that ignore the padding."""
    t = _entry(spark, d, "entry_id", "command").select("entry_id", F.posexplode(X.tokens(F.col("command"))).alias("i", "w"))
    counts = t.groupBy("w").agg(F.count("*").alias("n")).withColumn("one", F.lit(1))
    vocabulary = scoring.running_total(counts, [F.desc("n"), F.asc("w")], "one", "id").select("w", F.col("id").cast("long").alias("id"))
    rows = t.where(F.col("i") < _LENGTH).join(vocabulary, "w").groupBy("entry_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "id"))), lambda x: x["id"]).alias("ids"))
    padded = lambda with_: F.array_join(F.concat("ids", F.array_repeat(F.lit(with_).cast("long"), F.lit(_LENGTH) - F.size("ids"))).cast("array<string>"), " ")
    return rows.select("entry_id", padded(_PAD).alias("input_ids"), F.size("ids").cast("long").alias("attended"), padded(-100).alias("labels"))


@query(f"SELECT 1 AS n, round(avg(rouge), 6) AS mean FROM ({_rouge_sql(1)}) UNION ALL SELECT 2, round(avg(rouge), 6) FROM ({_rouge_sql(2)})")
def rouge_means(spark, d):
    pairs = _entry(spark, d, "entry_id", "objective", "question")
    means = [evaluate.rouge_n(pairs, "entry_id", "objective", "question", n).agg(F.lit(n).alias("n"), F.round(F.avg("rouge"), 6).alias("mean")) for n in (1, 2)]
    return means[0].unionByName(means[1])


@query()
def rouge_lsum(spark, d):
    """ROUGE-Lsum of each entry's steps against its question and command, line by line; compared with brute force in the tests."""
    e = _entry(spark, d, "entry_id", "question", "command", "chain_of_thought").select("entry_id", F.concat_ws("\n", "question", "command").alias("r"), F.col("chain_of_thought").alias("c"))
    return evaluate.rouge_lsum_table(e, "entry_id", "r", "c").withColumnRenamed("id", "entry_id")


# --- retrieval


_LABELLED = "CASE place WHEN 1 THEN 'First' WHEN 2 THEN 'Second' ELSE 'Third' END || ' result:' || chr(10) || replace(text, chr(10), ' ')"


@query(f"WITH {_RERANK} SELECT query_id, string_agg({_LABELLED}, chr(10) ORDER BY place) AS context FROM ranked WHERE text IS NOT NULL GROUP BY query_id")
def context_labelled(spark, d):
    hits, v = _hits(spark, d, 9)
    return retrieval.labelled_context(retrieval.rerank(hits, v.select("id", "text")).where("text IS NOT NULL"))


_GUIDE = "'You are a helpful kubernetes professional. [INST] Use the following documentation, if it is relevant to answer the question below. [/INST]' || chr(10) || 'Documentation: ' || documentation || ' </s>' || chr(10) || '<s> [INST] Answer the following question: ' || prompt || ' [/INST]' || chr(10) || 'Answer:' || chr(10) || chr(10)"


@query(f"""WITH {_RERANK}, asked AS (SELECT vec_id AS query_id, text AS prompt FROM ok WHERE vec_id % 100 = 0 AND text IS NOT NULL),
 book AS (SELECT query_id, string_agg({_STRIP.format('text')}, chr(10) || chr(10) ORDER BY place) AS documentation FROM ranked WHERE text IS NOT NULL GROUP BY query_id),
 web AS (SELECT t.query_id, string_agg({_STRIP.format("regexp_replace(o.text, '^[^—]*—', '')")}, '  ' || chr(10) ORDER BY rank) AS documentation FROM top t JOIN ok o ON o.vec_id = t.id WHERE o.text IS NOT NULL GROUP BY t.query_id),
 every AS (SELECT query_id, prompt, 'none' AS retriever, NULL AS documentation FROM asked UNION ALL SELECT query_id, prompt, 'semantic', documentation FROM asked LEFT JOIN book USING (query_id) UNION ALL SELECT query_id, prompt, 'web', coalesce(documentation, '') FROM asked LEFT JOIN web USING (query_id))
 SELECT query_id, retriever, md5(CASE WHEN documentation IS NULL THEN '[INST] Answer the following question: ' || prompt || ' [/INST]' || chr(10) || 'Answer: ' ELSE {_GUIDE} END) AS prompt_md5, documentation IS NOT NULL AS documented FROM every""")
def retriever_fan_out(spark, d):
    """Each question with the prompts of all retrievers, as one batch for the model: without documentation, with re-ranked passages of the index, with joined search results (here the plain hits)."""
    hits, v = _hits(spark, d, 9)
    asked = v.where("id % 100 = 0 AND text IS NOT NULL").select(F.col("id").alias("query_id"), F.col("text").alias("prompt"))
    passages = retrieval.rerank(hits, v.select("id", "text")).where("text IS NOT NULL")
    results = hits.join(v.select("id", "text"), "id").where("text IS NOT NULL")
    out = prompts.fan_out(asked, {"none": None, "semantic": retrieval.context(passages), "web": retrieval.search_results(results)})
    return out.select("query_id", "retriever", F.md5("full_prompt").alias("prompt_md5"), (F.length("trace") > 0).alias("documented"))


@query()
def chunk_pipeline(spark, d):
    """The whole chunker over the book: code masked, text reflowed, windows of tokens, code put back."""
    chunks = _chunks(spark, d).withColumn("id", F.concat_ws("-", "subpart_id", "chunk_no"))
    return segment.chunk_texts(chunks, "id", "text")
