"""All queries of the core with their SQL. Each runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from granary.functions import text as X
from granary.operators import dedupe, evaluate, html, prompts, retrieval, rules, sampling, scoring, segment
from granary.session import table
from granary.streaming import events as streams

_ALL: dict[str, tuple[Callable, str | None]] = {}

#: A substitution rule set over the commands of the entries.
RULES = {
    "namespace prod:prod": [{"d-sub": "namespace live", "c-sub": "live"}, {"d-sub": "namespace main", "c-sub": "main"}],
    "[deployment, namespace]:": [{"d-sub": "[rollout, space]", "c-sub": ""}],
    "$logs#pod | container:logs": [{"d-sub": "workload", "c-sub": "logs"}],
    "$get#:get": [{"d-sub": "", "c-sub": "describe"}],
    "staging:[-n, staging]": [{"d-sub": "rehearsal", "c-sub": "[--namespace, rehearsal]"}],
}
_TOK = r"list_filter(regexp_split_to_array({0}, '\s*[,=]\s*|\s+'), lambda w: w <> '')"
_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_WORDS = f"words AS (SELECT entry_id AS id, unnest({_TOK.format('''regexp_replace(command, '^kubectl ', '')''')}) AS word, generate_subscripts({_TOK.format('''regexp_replace(command, '^kubectl ', '')''')}, 1) - 1 AS pos FROM entry)"
_TF = _WORDS + """, tf AS (SELECT id, word, count(*) AS n, avg(pos) AS avg_pos FROM words GROUP BY id, word),
 ln AS (SELECT id, sum(n) AS len FROM tf GROUP BY id), cf AS (SELECT word, sum(n) AS q_n FROM tf GROUP BY word), tt AS (SELECT sum(n) AS total FROM tf)"""
_KL = _TF + """, kl AS (SELECT id, round(avg((1 - 0.8 / (1 + exp(-(10 * CASE WHEN len > 2 THEN avg_pos / (len - 1) ELSE 0 END - 5)))) * pow(0.5, length(word) - length(replace(word, '/', '')))
   * CASE WHEN regexp_full_match(word, '\\p{N}+') THEN pow(0.07, n) ELSE 1 END * (n / len) * log2((n / len) / (q_n / total))), 6) AS score
   FROM tf JOIN ln USING (id) JOIN cf USING (word) CROSS JOIN tt GROUP BY id)"""
_KEY = "command_name, objective, command, question, chain_of_thought"
_PDF = _KL + ", st AS (SELECT min(score) AS low, sum(score) - count(*) * min(score) AS s FROM kl), pdf AS (SELECT id, score, (score - low) / s AS pdf FROM kl CROSS JOIN st)"
_CDF = _PDF + ", cdf AS (SELECT id, score, pdf, row_number() OVER (ORDER BY score DESC, id) AS rank, sum(pdf) OVER (ORDER BY score DESC, id ROWS UNBOUNDED PRECEDING) AS cdf FROM pdf)"
_LATEST = "latest AS (SELECT vec_id, arg_max(embedding, metadata.date_uploaded) AS v, any_value(metadata.text) AS text FROM vector_record GROUP BY vec_id)"
_TOPK = _LATEST + """, ok AS (SELECT vec_id, CAST(v AS DOUBLE[]) AS v, text FROM latest WHERE v IS NOT NULL AND list_sum(list_transform(v, lambda x: abs(x))) > 0),
 sims AS (SELECT q.vec_id AS query_id, b.vec_id AS id, round(list_cosine_similarity(q.v, b.v), 6) AS similarity FROM ok q JOIN ok b ON q.vec_id % 100 = 0 AND q.vec_id <> b.vec_id),
 top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank FROM sims QUALIFY rank <= 9)"""
_SCORE = f"""CASE WHEN len(list_distinct(list_concat(x, y))) > 0 THEN round(len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))), 6) ELSE 0 END"""
_RERANK = _TOPK + f""", pairs AS (SELECT t.query_id, t.id, b.text, list_distinct({_TOK.format('lower(q.text)')}) AS x, list_distinct({_TOK.format('lower(b.text)')}) AS y FROM top t JOIN ok q ON q.vec_id = t.query_id JOIN ok b ON b.vec_id = t.id),
 ranked AS (SELECT query_id, id, text, {_SCORE} AS score, row_number() OVER (PARTITION BY query_id ORDER BY {_SCORE} DESC, id) AS place FROM pairs QUALIFY place <= 3)"""
_CHUNKS = "chunks AS (SELECT subpart_id, i - 1 AS chunk_no, content[i] AS text FROM (SELECT subpart_id, content, unnest(range(1, len(content) + 1)) AS i FROM (SELECT subpart_id, arg_max(content, scanned_at) AS content FROM book_subpart GROUP BY subpart_id)))"


def query(sql: str | None = None):
    def add(f: Callable) -> Callable:
        _ALL[f.__name__] = (f, sql)
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, (f, _) in _ALL.items()}


def oracles() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _ALL.items() if sql}


def _entry(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return table(spark, d, "entry").select(*columns) if columns else table(spark, d, "entry")


def _words(spark: SparkSession, d: str) -> DataFrame:
    return scoring.words(_entry(spark, d, "entry_id", "command"), "entry_id", X.context(F.col("command")))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return scoring.kl_corrected(_words(spark, d))


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    last = table(spark, d, "book_subpart").groupBy("subpart_id").agg(F.max_by("content", "scanned_at").alias("content"))
    return last.select("subpart_id", F.posexplode("content").alias("chunk_no", "text"))


# --- word statistics and scores


@query(f"WITH {_KL} SELECT id AS entry_id, score FROM kl ORDER BY score DESC, id LIMIT 20")
def kl_corrected_topk(spark, d):
    return _scored(spark, d).orderBy(F.desc("score"), "id").limit(20).select(F.col("id").alias("entry_id"), "score")


@query(f"WITH {_KL} SELECT id AS entry_id, score FROM kl")
def kl_corrected(spark, d):
    return _scored(spark, d).withColumnRenamed("id", "entry_id")


@query(f"WITH {_TF} SELECT id AS entry_id, round(avg((n / len) * log2((n / len) / (q_n / total))), 6) AS score FROM tf JOIN ln USING (id) JOIN cf USING (word) CROSS JOIN tt GROUP BY id")
def kl_average(spark, d):
    return scoring.kl_average(_words(spark, d)).withColumnRenamed("id", "entry_id")


@query(f"WITH {_WORDS} SELECT word, count(*) AS n FROM words GROUP BY word")
def word_count(spark, d):
    return scoring.word_counts(_words(spark, d))


@query(f"WITH {_WORDS}, c AS (SELECT word, count(*) AS n FROM words GROUP BY word), t AS (SELECT sum(n) AS t FROM c), h AS (SELECT -sum(n / t * log2(n / t)) AS h, count(*) AS d FROM c CROSS JOIN t) SELECT round(h, 6) AS entropy, round(h / d, 6) AS per_word FROM h")
def corpus_entropy(spark, d):
    return scoring.entropy(scoring.word_counts(_words(spark, d)))


_RATIO = "ratios AS (SELECT a.command_name, a.n, coalesce(b.n, 0) AS base_n, coalesce(a.n / b.n, 1) AS ratio FROM (SELECT command_name, count(*) AS n FROM entry GROUP BY 1) a LEFT JOIN (SELECT command_name, count(*) AS n FROM entry WHERE split_name = 'train' GROUP BY 1) b USING (command_name))"


def _ratios(spark, d):
    e = _entry(spark, d, "command_name", "split_name")
    return scoring.name_ratio(e, e.where("split_name = 'train'"))


@query(f"WITH {_RATIO} SELECT command_name, n, base_n, round(ratio, 6) AS ratio FROM ratios")
def name_histogram_ratio(spark, d):
    return _ratios(spark, d).withColumn("ratio", F.round("ratio", 6))


@query(f"WITH {_RATIO}, g AS (SELECT exp(avg(ln(ratio))) AS g FROM ratios) SELECT command_name, round(CASE WHEN ratio < g THEN 0.05 * abs(ratio - g) WHEN abs(ratio - g) < 1e-12 THEN 1000000 ELSE 10 / abs(ratio - g) END, 4) AS multiplier FROM ratios CROSS JOIN g")
def adaptive_multiplier(spark, d):
    return scoring.adaptive_multiplier(_ratios(spark, d)).withColumn("multiplier", F.round("multiplier", 4))


def _multiplied(spark, d) -> DataFrame:
    names = _entry(spark, d, "entry_id", "command_name").withColumnRenamed("entry_id", "id")
    return scoring.multiplied(_scored(spark, d), names, scoring.adaptive_multiplier(_ratios(spark, d)))


_MULTIPLIED = _KL + f""", {_RATIO}, g AS (SELECT exp(avg(ln(ratio))) AS g FROM ratios), mu AS (SELECT command_name, CASE WHEN ratio < g THEN 0.05 * abs(ratio - g) WHEN abs(ratio - g) < 1e-12 THEN 1000000 ELSE 10 / abs(ratio - g) END AS multiplier FROM ratios CROSS JOIN g),
 ml AS (SELECT id, score, score * multiplier AS weighted FROM kl JOIN entry ON id = entry_id JOIN mu ON entry.command_name IS NOT DISTINCT FROM mu.command_name)"""


@query(f"WITH {_MULTIPLIED} SELECT id AS entry_id, score, round(weighted, 4) AS weighted FROM ml")
def multiplied_scores(spark, d):
    return _multiplied(spark, d).select(F.col("id").alias("entry_id"), "score", F.round("weighted", 4).alias("weighted"))


@query(f"WITH {_PDF} SELECT id AS entry_id, round(pdf, 9) AS pdf FROM pdf")
def score_pdf(spark, d):
    return scoring.score_pdf(_scored(spark, d)).select(F.col("id").alias("entry_id"), F.round("pdf", 9).alias("pdf"))


@query(f"WITH {_CDF} SELECT id AS entry_id, rank, round(cdf, 6) AS cdf FROM cdf")
def score_cdf(spark, d):
    return scoring.score_cdf(scoring.score_pdf(_scored(spark, d))).select(F.col("id").alias("entry_id"), F.col("rank").cast("long").alias("rank"), F.round("cdf", 6).alias("cdf"))


@query(f"WITH {_CDF}, t AS (SELECT count(*) AS total FROM cdf), s AS (SELECT unnest(range(0, 11)) AS step) SELECT step / 10 AS fraction, count(rank) AS rows, round(avg(score), 6) AS avg_score, round(log2(nullif(count(rank), 0)), 6) AS row_entropy FROM s CROSS JOIN t LEFT JOIN cdf ON rank <= floor(total * step / 10) GROUP BY step")
def percentile_prefix_stats(spark, d):
    ranked = scoring.running_total(_scored(spark, d), [F.desc("score"), F.asc("id")], "score", "run", "rank")
    return scoring.percentile_prefixes(ranked)


@query(f"WITH {_KL}, e AS (SELECT min(score) AS lo, max(score) AS hi FROM kl) SELECT CAST(least(floor((score - lo) / (hi - lo) * 100), 99) AS INTEGER) AS bin, count(*) AS n, round(sum(score), 6) AS weight FROM kl CROSS JOIN e GROUP BY 1")
def score_histogram(spark, d):
    return scoring.histogram(_scored(spark, d), "score", 100, "score")


# --- rows, sets and samples


@query(f"SELECT entry_id FROM (SELECT entry_id, row_number() OVER (PARTITION BY {_KEY} ORDER BY entry_id) AS n FROM entry) WHERE n = 1")
def dedupe_first_wins(spark, d):
    return dedupe.first_wins(_entry(spark, d, "entry_id", *dedupe.ENTRY_KEY), dedupe.ENTRY_KEY, "entry_id").select("entry_id")


def _parts(spark, d):
    e = _entry(spark, d, "entry_id", "split_name", *dedupe.ENTRY_KEY)
    return e.where("split_name = 'train'"), e.where("split_name <> 'train'")


_SEEN = " AND ".join(f"t.{c} IS NOT DISTINCT FROM e.{c}" for c in dedupe.ENTRY_KEY)


@query(f"SELECT entry_id FROM entry e WHERE split_name <> 'train' AND NOT EXISTS (SELECT 1 FROM entry t WHERE t.split_name = 'train' AND {_SEEN})")
def anti_seen(spark, d):
    train, other = _parts(spark, d)
    return dedupe.unseen(other, train, dedupe.ENTRY_KEY).select("entry_id")


@query(f"SELECT entry_id, false AS inserted FROM entry WHERE split_name = 'train' UNION ALL SELECT entry_id, true FROM (SELECT entry_id, row_number() OVER (PARTITION BY {_KEY} ORDER BY entry_id) AS n FROM entry e WHERE split_name <> 'train' AND NOT EXISTS (SELECT 1 FROM entry t WHERE t.split_name = 'train' AND {_SEEN})) WHERE n = 1")
def insert_if_absent(spark, d):
    return dedupe.insert_if_absent(*_parts(spark, d), dedupe.ENTRY_KEY, "entry_id").select("entry_id", "inserted")


@query("SELECT entry_id FROM entry ORDER BY entry_id LIMIT 19800")
def limit_first_n(spark, d):
    return _entry(spark, d, "entry_id").orderBy("entry_id").limit(19_800)


@query("SELECT entry_id, objective, command_name, regexp_replace(command, '^kubectl ', '') AS context, description, syntax, len(flags) AS n_flags, question, chain_of_thought FROM entry")
def row_projection(spark, d):
    e = _entry(spark, d)
    n = F.when(F.col("flags").isNotNull(), F.size("flags")).cast("long")
    return e.select("entry_id", "objective", "command_name", X.context(F.col("command")).alias("context"), "description", "syntax", n.alias("n_flags"), "question", "chain_of_thought")


@query("SELECT entry_id, copy FROM entry CROSS JOIN (SELECT unnest(range(1, 5)) AS copy)")
def replicate_rows(spark, d):
    return _entry(spark, d, "entry_id").select("entry_id", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(4).cast("long"))).alias("copy"))


_MD5 = "CAST(('0x' || substr(md5('0|' || CAST(entry_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100"


@query(f"SELECT entry_id, CASE WHEN {_MD5} < 90 THEN 'train' ELSE 'test' END AS part FROM entry")
def hash_split(spark, d):
    return sampling.hash_split(_entry(spark, d, "entry_id"), "entry_id")


@query("SELECT id, example_id, place FROM (SELECT entry_id AS id, example_id, row_number() OVER (PARTITION BY entry_id ORDER BY md5('0|' || entry_id || '|' || example_id), example_id) AS place FROM entry CROSS JOIN few_shot_example) WHERE place <= 3")
def few_shot_pick(spark, d):
    return sampling.few_shot(_entry(spark, d, "entry_id"), table(spark, d, "few_shot_example"), "entry_id", "example_id").withColumn("place", F.col("place").cast("long"))


_GRID = "grid AS (SELECT i AS sample_no, (2 * i + 1) / 2001 AS value FROM (SELECT unnest(range(0, 1000)) AS i))"


@query(f"WITH {_CDF}, u AS (SELECT cdf, arg_min(id, rank) AS id FROM cdf GROUP BY cdf), {_GRID} SELECT sample_no, arg_min(id, round(abs(value - cdf), 12) * 1e6 - cdf * 1e-9) AS entry_id FROM grid CROSS JOIN u GROUP BY sample_no")
def nearest_cdf_pick(spark, d):
    cdf = scoring.score_cdf(scoring.score_pdf(_scored(spark, d)))
    grid = spark.range(1000).select(F.col("id").alias("sample_no"), ((2 * F.col("id") + 1) / 2001).alias("value"))
    return sampling.nearest_pick(cdf, grid).withColumnRenamed("id", "entry_id")


@query()
def guided_sample(spark, d):
    """A tenth of the entries, by scores with the multipliers of their commands."""
    n = max(1, table(spark, d, "entry").count() // 10)
    return sampling.guided_sample(scoring.score_pdf(_multiplied(spark, d), "weighted"), n).withColumnRenamed("id", "entry_id")


@query()
def truncated_normal(spark, d):
    return sampling.truncated_normal(spark, 1000)


# --- cleaning


_FIRST = "least(CASE WHEN instr(question, '. ') > 0 THEN instr(question, '. ') ELSE length(question) + 1 END, CASE WHEN instr(question, chr(10)) > 0 THEN instr(question, chr(10)) ELSE length(question) + 1 END)"


@query(f"""SELECT entry_id, question FROM (SELECT entry_id, CASE WHEN length(question) < 128 THEN question ELSE left(question, {_FIRST} - 1) END AS question FROM entry WHERE question IS NOT NULL)
 WHERE NOT (contains(question, 'use the following command:') OR contains(question, 'run the following command:')) AND NOT starts_with(question, 'To') AND NOT contains(lower(question), 'instruction') AND NOT contains(lower(question), 'following command')""")
def clean_questions(spark, d):
    q = _entry(spark, d, "entry_id", "question").where("question IS NOT NULL").withColumn("question", X.first_statement(F.col("question")))
    c = F.col("question")
    return q.where(~(c.contains("use the following command:") | c.contains("run the following command:")) & ~c.startswith("To") & ~F.lower(c).contains("instruction") & ~F.lower(c).contains("following command"))


_LINES = f"list_transform(string_split(chain_of_thought, chr(10)), lambda x: {_STRIP.format('x')})"
_PARA = f"""para AS (SELECT entry_id, CASE WHEN s IS NULL THEN '' ELSE array_to_string(CASE WHEN b IS NULL THEN rest ELSE list_slice(rest, 1, b - 1) END, chr(10)) END AS cot
 FROM (SELECT *, nullif(list_position(rest, ''), 0) AS b FROM (SELECT *, CASE WHEN s IS NULL THEN l ELSE list_slice(l, s, len(l)) END AS rest FROM (SELECT entry_id, l, nullif(list_position(list_transform(l, lambda x: x <> ''), true), 0) AS s FROM (SELECT entry_id, {_LINES} AS l FROM entry WHERE chain_of_thought IS NOT NULL)))))"""


@query(f"WITH {_PARA} SELECT entry_id, cot FROM para WHERE length(cot) <= 2000")
def trim_first_paragraph(spark, d):
    e = _entry(spark, d, "entry_id", "chain_of_thought").where("chain_of_thought IS NOT NULL")
    return e.select("entry_id", X.first_paragraph(F.col("chain_of_thought")).alias("cot")).where(F.length("cot") <= 2000)


_SHAPED = r"len(list_filter(string_split(cot, chr(10)), lambda x: NOT regexp_matches(x, '^\s*\S+\s+\pL'))) = 0"


@query(f"WITH {_PARA} SELECT entry_id FROM para WHERE {_SHAPED}")
def list_shape_filter(spark, d):
    return trim_first_paragraph(spark, d).where(X.list_shaped(F.col("cot"))).select("entry_id")


_FLAGS = ", ".join("'" + f.replace("'", "''") + "'" for f in X.RED_FLAGS)
_WHOLE = lambda t: _STRIP.format(f"array_to_string(list_slice(string_split({t}, chr(10)), 1, len(string_split({t}, chr(10))) - 1), chr(10))")
_CUT = f"""marked AS (SELECT entry_id, cot, list_filter(list_sort(list_filter(list_transform([{_FLAGS}], lambda f: instr(lower(cot), f)), lambda p: p > 0)), lambda p: length(left(cot, p - 1)) - length(replace(left(cot, p - 1), chr(10), '')) + 1 > 3) AS m FROM para),
 lined AS (SELECT entry_id, cot, m, list_transform(m, lambda p: length(left(cot, p - 1)) - length(replace(left(cot, p - 1), chr(10), '')) + 1) AS l FROM marked),
 cutted AS (SELECT entry_id, CASE WHEN len(m) = 0 THEN cot ELSE {_WHOLE('left(cot, CASE WHEN len(m) > 2 AND l[3] < 6 THEN m[3] WHEN len(m) > 1 AND l[2] < 6 THEN m[2] ELSE m[1] END - 1)')} END AS cot FROM lined)"""


@query(f"WITH {_PARA}, {_CUT} SELECT entry_id, CASE WHEN length(cot) > 500 THEN {_WHOLE('left(cot, 500)')} ELSE {_STRIP.format('cot')} END AS cot FROM cutted WHERE cot <> ''")
def redflag_truncate(spark, d):
    e = _entry(spark, d, "entry_id", "chain_of_thought").where("chain_of_thought IS NOT NULL")
    cut = e.select("entry_id", X.first_paragraph(F.col("chain_of_thought")).alias("cot")).select("entry_id", X.red_flag_cut(F.col("cot")).alias("cot"))
    return cut.where("cot <> ''").withColumn("cot", X.cap_lines(F.col("cot")))


# --- prompts


_FLAG_ON = "(coalesce(f.option, '') <> '' AND contains(command, ' --' || f.option)) OR (trim(coalesce(f.short, '')) <> '' AND contains(command, ' -' || trim(f.short))) OR coalesce(f.default_value, '') <> ''"


@query(f"SELECT entry_id, syntax, array_to_string(list_transform(list_filter(coalesce(flags, []), lambda f: coalesce({_FLAG_ON}, false)), lambda f: f.option), ',') AS options FROM entry")
def relevant_flags(spark, d):
    e = _entry(spark, d, "entry_id", "command", "syntax", "flags")
    kept = prompts.relevant_flags(F.col("command"), F.col("flags"))
    return e.select("entry_id", "syntax", F.coalesce(F.array_join(F.transform(kept, lambda f: f["option"]), ","), F.lit("")).alias("options"))


def _examples_sql(reasoned: bool) -> str:
    text = r"'General idea: ' || general_form || '\Instruction: ' || instruction || chr(10) || 'Command: ' || command || chr(10) || 'Chain of Thought: ' || chain_of_thought" if reasoned else "'General idea: ' || general_form || chr(10) || 'Command: ' || command || chr(10) || 'Instruction: ' || instruction"
    return f"ex AS (SELECT id, string_agg(t, chr(10) || chr(10) ORDER BY place) AS examples FROM (SELECT entry_id AS id, {text} AS t, row_number() OVER (PARTITION BY entry_id ORDER BY md5('0|' || entry_id || '|' || example_id), example_id) AS place FROM (SELECT entry_id FROM entry) CROSS JOIN few_shot_example QUALIFY place <= 3) GROUP BY id)"


def _with_examples(spark, d, reasoned: bool) -> DataFrame:
    e, ex = _entry(spark, d, "entry_id", "objective", "question", "command", "syntax", "flags"), table(spark, d, "few_shot_example")
    block = prompts.examples_block(sampling.few_shot(e, ex, "entry_id", "example_id"), ex, reasoned)
    return e.join(block, e.entry_id == block.id)


@query(f"WITH {_examples_sql(True)} SELECT entry_id, md5('Generate the chain of thought process for the given command, based on the general idea and the instruction.' || chr(10) || chr(10) || examples || chr(10) || chr(10) || 'General idea: ' || coalesce(objective, 'None') || chr(10) || 'Instruction: ' || coalesce(question, 'None') || chr(10) || 'Command: ' || coalesce(command, 'None') || chr(10) || 'Chain of Thought: ') AS prompt_md5 FROM entry JOIN ex ON entry_id = id WHERE len(list_filter(coalesce(flags, []), lambda f: coalesce({_FLAG_ON}, false))) = 0")
def prompt_cot_plain(spark, d):
    """Prompts of the rows without relevant flags; those with flags have JSON whose spelling differs between engines."""
    rows = _with_examples(spark, d, True)
    kept = prompts.relevant_flags(F.col("command"), F.col("flags"))
    prompt = prompts.reasoning_prompt(F.col("objective"), F.col("question"), F.col("command"), F.col("examples"), F.lit(""), F.lit(False))
    return rows.where(F.coalesce(F.size(kept), F.lit(0)) == 0).select("entry_id", F.md5(prompt).alias("prompt_md5"))


_DOCS = f"to_json({{'syntax': syntax, 'flags': list_transform(list_filter(coalesce(flags, []), lambda f: coalesce({_FLAG_ON}, false)), lambda f: {{'option': f.option, 'short': f.short, 'default_value': f.default_value, 'description': f.description}})}})"
_ABOUT = f"CASE WHEN len(list_filter(coalesce(flags, []), lambda f: coalesce({_FLAG_ON}, false))) > 0 THEN 'Do not comment about flags that could be used' || chr(10) || 'If a flag is not specified in the command, consider the default found in the docs' || chr(10) || 'To understand the flags use the documentation JSON format here: ' || {_DOCS} || chr(10) || chr(10) ELSE '' END"


@query(f"WITH {_examples_sql(True)} SELECT entry_id, md5('Generate the chain of thought process for the given command, based on the general idea and the instruction.' || chr(10) || chr(10) || examples || chr(10) || chr(10) || 'General idea: ' || coalesce(objective, 'None') || chr(10) || 'Instruction: ' || coalesce(question, 'None') || chr(10) || 'Command: ' || coalesce(command, 'None') || chr(10) || {_ABOUT} || 'Chain of Thought: ') AS prompt_md5 FROM entry JOIN ex ON entry_id = id")
def prompt_cot_all(spark, d):
    return prompt_cot(spark, d).select("entry_id", F.md5("prompt").alias("prompt_md5"))


@query()
def prompt_cot(spark, d):
    rows = _with_examples(spark, d, True).withColumn("kept", prompts.relevant_flags(F.col("command"), F.col("flags")))
    docs = F.to_json(F.struct("syntax", F.col("kept").alias("flags")), {"ignoreNullFields": "false"})
    return rows.select("entry_id", prompts.reasoning_prompt(F.col("objective"), F.col("question"), F.col("command"), F.col("examples"), docs, F.coalesce(F.size("kept") > 0, F.lit(False))).alias("prompt"))


@query(f"WITH {_examples_sql(False)} SELECT entry_id, md5('For a given command, provide in instruction for which the command is the answer, please give a general instruction as your answer' || chr(10) || chr(10) || examples || chr(10) || chr(10) || 'General idea: ' || coalesce(objective, 'None') || chr(10) || 'Command: ' || coalesce(command, 'None') || chr(10) || 'Instruction: ') AS prompt_md5 FROM entry JOIN ex ON entry_id = id")
def prompt_instruction(spark, d):
    rows = _with_examples(spark, d, False)
    return rows.select("entry_id", F.md5(prompts.instruction_prompt(F.col("objective"), F.col("command"), F.col("examples"), F.lit(False))).alias("prompt_md5"))


_BY_KIND = "e AS (SELECT *, md5('0|kind|' || entry_id) < '8' AS k FROM entry), ex AS (SELECT id, string_agg(t, chr(10) || chr(10) ORDER BY place) AS examples FROM (SELECT entry_id AS id, 'General idea: ' || general_form || chr(10) || 'Command: ' || f.command || chr(10) || 'Instruction: ' || instruction AS t, row_number() OVER (PARTITION BY entry_id ORDER BY md5('0|' || entry_id || '|' || example_id), example_id) AS place FROM e JOIN few_shot_example f ON k = coalesce(specific, false) QUALIFY place <= 3) GROUP BY id)"


@query(f"WITH {_BY_KIND} SELECT entry_id, k AS specific, md5(CASE WHEN k THEN 'For a given command and the general idea, provide in instruction for which the command is the answer, please include the parameters in your instruction' ELSE 'For a given command, provide in instruction for which the command is the answer, please give a general instruction as your answer' END || chr(10) || chr(10) || examples || chr(10) || chr(10) || 'General idea: ' || coalesce(objective, 'None') || chr(10) || 'Command: ' || coalesce(command, 'None') || chr(10) || 'Instruction: ') AS prompt_md5 FROM e JOIN ex ON entry_id = id")
def prompt_instruction_by_kind(spark, d):
    """A kind for each entry by hash, with examples and lead of that kind."""
    e = _entry(spark, d, "entry_id", "objective", "command").withColumn("specific", F.md5(F.concat(F.lit("0|kind|"), F.col("entry_id").cast("string"))) < "8")
    ex = table(spark, d, "few_shot_example").withColumn("specific", F.coalesce("specific", F.lit(False)))
    general, specific = (sampling.few_shot(e.where(of), ex.where(of), "entry_id", "example_id") for of in (~F.col("specific"), F.col("specific")))
    rows = e.join(prompts.examples_block(general.unionByName(specific), ex, False), F.col("entry_id") == F.col("id"))
    return rows.select("entry_id", "specific", F.md5(prompts.instruction_prompt(F.col("objective"), F.col("command"), F.col("examples"), F.col("specific"))).alias("prompt_md5"))


@query("SELECT entry_id, '#Steps:' || chr(10) || chain_of_thought || chr(10) || '#Code:' || chr(10) || command AS label FROM entry")
def label_template(spark, d):
    return _entry(spark, d).select("entry_id", prompts.label_text(F.col("chain_of_thought"), F.col("command")).alias("label"))


@query("SELECT entry_id, k AS kind, CASE k WHEN 0 THEN '[INST] ' || question || chr(10) || ' Lets think step by step. [/INST] ### Answer:' WHEN 1 THEN '[INST] Answer the following question: ' || question || ' [/INST]' || chr(10) || 'Answer: ' ELSE '[INST] ' || question || ' [/INST]' END AS prompt FROM (SELECT *, CASE WHEN contains(question, '0') THEN 0 WHEN contains(question, '1') THEN 1 ELSE 2 END AS k FROM entry WHERE question IS NOT NULL)")
def route_prompt(spark, d):
    e = _entry(spark, d, "entry_id", "question").where("question IS NOT NULL").withColumn("kind", prompts.route(F.col("question")))
    return e.select("entry_id", "kind", prompts.routed_prompt(F.col("question"), F.col("kind")).alias("prompt"))


@query(f"SELECT entry_id, {_STRIP.format('chain_of_thought')} AS answer FROM entry WHERE chain_of_thought IS NOT NULL AND question IS NOT NULL AND NOT contains(chain_of_thought, '#End') AND NOT contains(question, '#') AND NOT contains(question, '### Answer:')")
def answer_extract(spark, d):
    e = _entry(spark, d, "entry_id", "question", "chain_of_thought").where("chain_of_thought IS NOT NULL AND question IS NOT NULL AND NOT contains(chain_of_thought, '#End') AND NOT contains(question, '#')")
    said = F.concat("question", F.lit("\n### Answer:\n"), "chain_of_thought", F.lit("\n#End of text"))
    return e.select("entry_id", X.answer(said, F.length("question")).alias("answer"))


_SAID = "SELECT entry_id, prompt, prompt || chr(10) || chain_of_thought || chr(10) || '#End of text' AS s FROM (SELECT *, CASE WHEN contains(question, '0') THEN '[INST] ' || question || chr(10) || ' Lets think step by step. [/INST] ### Answer:' WHEN contains(question, '1') THEN '[INST] Answer the following question: ' || question || ' [/INST]' || chr(10) || 'Answer: ' ELSE '[INST] ' || question || ' [/INST]' END AS prompt FROM entry WHERE question IS NOT NULL AND chain_of_thought IS NOT NULL)"


@query(f"WITH said AS ({_SAID}), spans AS (SELECT *, CASE WHEN contains(s, '# Command:') THEN strpos(s, '# Command:') + 10 WHEN contains(s, '### Answer:') THEN strpos(s, '### Answer:') + 11 ELSE length(prompt) + 1 END AS b, strpos(s, '#End') AS e FROM said) SELECT entry_id, {_STRIP.format('CASE WHEN e > b THEN substr(s, b, e - b) ELSE chr(32) END')} AS answer FROM spans")
def answer_extract_all(spark, d):
    """All rows with a question and a reply: the marks decide wherever they stand, and prompts without an answer mark go by their length."""
    e = _entry(spark, d, "entry_id", "question", "chain_of_thought").where("chain_of_thought IS NOT NULL AND question IS NOT NULL")
    e = e.withColumn("prompt", prompts.routed_prompt(F.col("question"), prompts.route(F.col("question"))))
    said = F.concat("prompt", F.lit("\n"), "chain_of_thought", F.lit("\n#End of text"))
    return e.select("entry_id", X.answer(said, F.length("prompt")).alias("answer"))


# --- book text


@query(f"WITH {_CHUNKS} SELECT subpart_id, chunk_no, " + "replace(" * len(X.UNICODE_MAP) + "text" + "".join(", " + " || ".join("chr(10)" if ch == "\n" else "'" + ch.replace("'", "''") + "'" for ch in (a if "\n" in a else [a])) + ", '" + b.replace("'", "''") + "')" for a, b in X.UNICODE_MAP) + " AS text FROM chunks")
def unicode_normalise(spark, d):
    return _chunks(spark, d).withColumn("text", X.map_unicode(F.col("text")))


@query(rf"WITH {_CHUNKS} SELECT subpart_id, chunk_no, regexp_replace(regexp_replace(text, '(?m)^.* \| [0-9]+$\n', '', 'g'), '(?m)^[0-9]+ \| .*$\n', '', 'g') AS text FROM chunks")
def running_header_strip(spark, d):
    return _chunks(spark, d).withColumn("text", X.drop_running_headers(F.col("text")))


@query(rf"WITH {_CHUNKS} SELECT subpart_id, chunk_no, regexp_replace(regexp_replace(text, '(?m)^\s*[0-9]+\s*$', '', 'g'), '(?m)^Figure [0-9]+-[0-9]+\..*$', '', 'g') AS text FROM chunks")
def page_number_strip(spark, d):
    return _chunks(spark, d).withColumn("text", X.drop_figures(X.drop_page_numbers(F.col("text"))))


@query(rf"WITH {_CHUNKS} SELECT subpart_id, chunk_no, regexp_replace({_STRIP.format('text')}, ' +', ' ', 'g') AS text FROM chunks")
def single_spaces(spark, d):
    return _chunks(spark, d).withColumn("text", X.single_spaces(F.col("text")))


@query(rf"WITH {_CHUNKS}, p AS (SELECT subpart_id, chunk_no, string_split(text, '.' || chr(10)) AS l FROM chunks), q AS (SELECT subpart_id, chunk_no, i - 1 AS paragraph_no, l[i] || '.' AS text FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM p)) SELECT * FROM q WHERE length(text) > 10")
def paragraph_split(spark, d):
    out = _chunks(spark, d).select("subpart_id", F.col("chunk_no").cast("long").alias("chunk_no"), F.posexplode(X.paragraphs(F.col("text"))).alias("paragraph_no", "text"))
    return out.withColumn("paragraph_no", F.col("paragraph_no").cast("long")).where(F.length("text") > 10)


@query(rf"WITH {_CHUNKS} SELECT subpart_id, chunk_no, array_to_string(list_transform(string_split(text, chr(10)), lambda x: CASE WHEN regexp_full_match(x, '-*') THEN replace(x, '-', '_') ELSE regexp_replace(x, '^( *)#', '\1\\#') END), '  ' || chr(10)) AS text FROM chunks")
def markdown_escape(spark, d):
    return _chunks(spark, d).withColumn("text", X.markdown(F.col("text")))


@query("SELECT part_id, trim(title) AS title FROM book_part WHERE trim(title) <> 'Discussion'")
def title_exclude(spark, d):
    return table(spark, d, "book_part").where(F.trim("title") != "Discussion").select("part_id", F.trim("title").alias("title"))


@query()
def reflow(spark, d):
    repaired = X.repair_hyphen_items(X.reflow(F.col("text")))
    return _chunks(spark, d).withColumn("text", X.rstrip_lines(X.single_spaces(X.drop_chapter_references(repaired))))


@query()
def block_mask(spark, d):
    masked = segment.mask_table(_chunks(spark, d), ["subpart_id", "chunk_no"], "text")
    return masked.select("subpart_id", "chunk_no", "text", F.size("blocks").alias("n_blocks"))


_TREE = """SELECT chapter_id, 0 AS part_no, 0 AS subpart_no, i - 1 AS chunk_no, intr[i] AS text FROM (SELECT *, unnest(range(1, len(intr) + 1)) AS i FROM book_chapter)
 UNION ALL SELECT chapter_id, part_no, 0, i - 1, intr[i] FROM (SELECT *, unnest(range(1, len(intr) + 1)) AS i FROM book_part)
 UNION ALL SELECT p.chapter_id, p.part_no, s.subpart_no, i - 1, content[i] FROM (SELECT *, unnest(range(1, len(content) + 1)) AS i FROM (SELECT subpart_id, any_value(part_id) AS part_id, any_value(subpart_no) AS subpart_no, arg_max(content, scanned_at) AS content FROM book_subpart GROUP BY subpart_id)) s JOIN book_part p USING (part_id)"""


@query(_TREE)
def tree_flatten(spark, d):
    out = segment.flatten_tree(table(spark, d, "book_chapter"), table(spark, d, "book_part"), table(spark, d, "book_subpart"))
    return out.withColumn("chunk_no", F.col("chunk_no").cast("long"))


@query("SELECT c.chapter_id, c.title, coalesce(string_agg(p.title, '|' ORDER BY p.part_no, p.part_id), '') AS parts FROM book_chapter c LEFT JOIN book_part p USING (chapter_id) GROUP BY ALL")
def toc_sections(spark, d):
    return segment.toc_sections(table(spark, d, "book_chapter"), table(spark, d, "book_part")).withColumn("parts", F.array_join("parts", "|"))


@query()
def section_split(spark, d):
    """Each chapter's parts as one text, split again at their titles."""
    parts = table(spark, d, "book_part").groupBy("chapter_id").agg(F.array_sort(F.collect_list(F.struct("part_no", "part_id", "title", "intr"))).alias("p"))
    whole = parts.select("chapter_id", F.array_join(F.transform("p", lambda x: F.concat(x["title"], F.lit("\n"), F.coalesce(F.array_join(x["intr"], "\n\n"), F.lit("")))), "\n").alias("text"), F.transform("p", lambda x: x["title"]).alias("titles"))
    return segment.split_sections(whole, ["chapter_id"], "text", "titles")


@query(f"""WITH RECURSIVE l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: {_STRIP.format('x')} <> '') AS lines FROM documents WHERE text IS NOT NULL),
 c AS (SELECT doc_id, len(lines) AS n, list_transform(lines, lambda x: len({_TOK.format('x')})) AS k FROM l),
 t AS (SELECT doc_id, n, list_prepend(0, list_transform(range(1, n + 1), lambda i: list_sum(k[1:i]))) AS p FROM c),
 w AS (SELECT doc_id, n, p, 0 AS window_no, 0::BIGINT AS s, coalesce(list_min(list_filter(range(0, n + 1), lambda e: p[e + 1] >= 512)), n) AS e FROM t
   UNION ALL SELECT doc_id, n, p, window_no + 1, s2, coalesce(list_min(list_filter(range(e, n + 1), lambda x: p[x + 1] - p[s2 + 1] >= 512)), n)
   FROM (SELECT *, list_min(list_filter(range(s, n + 1), lambda x: p[x + 1] - p[s + 1] >= 128)) AS s2 FROM w WHERE e < n))
 SELECT doc_id, CAST(window_no AS INTEGER) AS window_no, CAST(s AS INTEGER) AS first_line, CAST(e AS INTEGER) AS end_line, CAST(p[e + 1] - p[s + 1] AS INTEGER) AS n_tokens FROM w""")
def chunk_windows(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text").where("text IS NOT NULL")
    out = segment.chunk_windows(docs, "doc_id", X.lines(F.col("text")))
    return out.select(F.col("id").alias("doc_id"), "window_no", "first_line", "end_line", "n_tokens")


def _nested(spark, d) -> DataFrame:
    """Entries as documents of examples: one for each command name and syntax, whose examples hold their questions."""
    e = _entry(spark, d, "entry_id", "command_name", "syntax", "objective", "command", "chain_of_thought", "question").where("question IS NOT NULL")
    ex = F.struct(F.col("objective").alias("description"), F.col("command").alias("code"), F.col("chain_of_thought").alias("cot"), F.array("question").alias("questions"))
    # salted by the hundred of the id: a hot command is many documents of bounded size
    return e.groupBy("command_name", "syntax", F.floor(F.col("entry_id") / 100).alias("h")).agg(F.array_sort(F.collect_list(F.struct("entry_id", ex.alias("e")))).alias("x")).select(F.col("command_name").alias("command"), F.lit(None).cast("string").alias("description"), "syntax", F.transform("x", lambda v: v["e"]).alias("examples"))


@query("SELECT command_name AS command, syntax, command AS code, chain_of_thought AS cot, question FROM entry WHERE question IS NOT NULL")
def nested_flatten_train(spark, d):
    return segment.nested_train(_nested(spark, d)).drop("description")


@query("SELECT command_name AS command, syntax, command AS code, chain_of_thought AS cot, objective AS question FROM entry WHERE question IS NOT NULL")
def nested_flatten_validate(spark, d):
    return segment.nested_validate(_nested(spark, d)).drop("description")


# --- rules


_IN_ORDER = lambda t, a, b: f"instr({t}, '{a}') > 0 AND instr(substr({t}, instr({t}, '{a}') + {len(a)}), '{b}') > 0"
_MATCHES = {
    0: "contains(objective, 'namespace prod') AND contains(command, 'prod')",
    1: _IN_ORDER("objective", "deployment", "namespace"),
    2: "command_name = 'logs' AND (contains(objective, 'pod') OR contains(objective, 'container')) AND contains(command, 'logs')",
    3: "command_name = 'get' AND contains(command, 'get')",
    4: f"contains(objective, 'staging') AND {_IN_ORDER('command', '-n', 'staging')}",
}
_PRIORITY = {0: 6, 1: 4, 2: 22, 3: 19, 4: 7}


@query("SELECT entry_id, ordinal, priority FROM (SELECT entry_id, ordinal, priority, row_number() OVER (PARTITION BY entry_id ORDER BY priority DESC, ordinal) AS n FROM (" + " UNION ALL ".join(f"SELECT entry_id, {o} AS ordinal, {_PRIORITY[o]} AS priority FROM entry WHERE {m}" for o, m in _MATCHES.items()) + ")) WHERE n = 1")
def rule_match_top1(spark, d):
    parsed = rules.rules_table(spark, rules.parse_rules(RULES))
    out = rules.best_rule(_entry(spark, d, "entry_id", "objective", "command", "command_name"), parsed, "entry_id", "objective", "command", "command_name")
    return out.select(F.col("id").alias("entry_id"), "ordinal", "priority")


@query()
def rule_expand(spark, d):
    e = _entry(spark, d, "entry_id", "objective", "command", "command_name")
    return rules.expand_table(e, rules.parse_rules(RULES), "entry_id", "objective", "command", "command_name", copies=2).withColumnRenamed("id", "entry_id")


# --- vectors


def _vectors(spark, d) -> DataFrame:
    v = table(spark, d, "vector_record").select("vec_id", "embedding", "metadata")
    last = v.groupBy("vec_id").agg(F.max_by(F.struct("embedding", F.col("metadata.text").alias("text")), "metadata.date_uploaded").alias("x"))
    return last.select(F.col("vec_id").alias("id"), F.col("x.embedding").alias("vector"), F.col("x.text").alias("text")).where(retrieval.usable(F.col("vector")))


def _hits(spark, d, k: int) -> tuple[DataFrame, DataFrame]:
    v = _vectors(spark, d)
    return retrieval.top_k(v.where("id % 100 = 0").select("id", "vector"), v.select("id", "vector"), k), v


@query(f"WITH {_TOPK} SELECT query_id, CAST(rank AS INTEGER) AS rank, id, similarity FROM top WHERE rank <= 3")
def vector_topk(spark, d):
    return _hits(spark, d, 3)[0]


@query(f"WITH {_RERANK} SELECT query_id, CAST(place AS INTEGER) AS place, id, score FROM ranked")
def rerank_topk(spark, d):
    hits, v = _hits(spark, d, 9)
    return retrieval.rerank(hits, v.select("id", "text")).drop("text")


@query(f"WITH {_RERANK} SELECT query_id, string_agg({_STRIP.format('text')}, chr(10) || chr(10) ORDER BY place) AS context FROM ranked GROUP BY query_id")
def context_join(spark, d):
    hits, v = _hits(spark, d, 9)
    return retrieval.context(retrieval.rerank(hits, v.select("id", "text")))


@query("SELECT vec_id, max(metadata.date_uploaded) AS date_uploaded FROM vector_record GROUP BY vec_id")
def vector_upsert(spark, d):
    v = table(spark, d, "vector_record").select("vec_id", F.col("metadata.date_uploaded").alias("date_uploaded"))
    return retrieval.upsert(v.where("vec_id % 2 = 0"), v.where("vec_id % 2 = 1"), "vec_id", F.col("date_uploaded"))


@query("SELECT vec_id, md5(metadata.text) AS id FROM vector_record")
def md5_ids(spark, d):
    return table(spark, d, "vector_record").select("vec_id", F.md5("metadata.text").alias("id"))


# --- evaluation


@query("SELECT command_name AS label, regexp_extract(command, '^kubectl (\\S+)', 1) AS predicted, count(*) AS n FROM entry WHERE command_name IS NOT NULL AND command IS NOT NULL GROUP BY ALL")
def confusion_matrix(spark, d):
    e = _entry(spark, d, "command_name", "command").where("command_name IS NOT NULL AND command IS NOT NULL").withColumn("predicted", F.regexp_extract("command", r"^kubectl (\S+)", 1))
    return evaluate.confusion(e, "command_name", "predicted")


@query("""WITH m AS (SELECT command_name AS y, regexp_extract(command, '^kubectl (\\S+)', 1) AS p FROM entry WHERE command_name IS NOT NULL AND command IS NOT NULL),
 k AS (SELECT y AS k FROM m UNION SELECT p FROM m), c AS (SELECT k, count(*) FILTER (WHERE y = k AND p = k) AS tp, count(*) FILTER (WHERE y = k) AS t, count(*) FILTER (WHERE p = k) AS pr FROM k CROSS JOIN m GROUP BY k)
 SELECT round(sum(tp) / sum(t), 6) AS accuracy, round(avg(CASE WHEN pr > 0 THEN tp / pr ELSE 0 END), 6) AS precision, round(avg(CASE WHEN t > 0 THEN tp / t ELSE 0 END), 6) AS recall, round(avg(CASE WHEN tp > 0 THEN 2 * tp / (t + pr) ELSE 0 END), 6) AS f1 FROM c""")
def classification_metrics(spark, d):
    return evaluate.macro_metrics(confusion_matrix(spark, d))


_GRAM = lambda c, n: f"list_transform(range(1, len(w{c}) - {n - 2}), lambda i: array_to_string(w{c}[i:i + {n - 1}], ' '))"


def _rouge_sql(n: int) -> str:
    w = lambda c: f"regexp_extract_all(lower(coalesce({c}, '')), '[a-z0-9]+')"
    return f"""WITH b AS (SELECT entry_id AS id, {w('objective')} AS wr, {w('question')} AS wc FROM entry), g AS (SELECT id, {_GRAM('r', n)} AS r, {_GRAM('c', n)} AS c FROM b),
 u AS (SELECT id, x, 1 AS a, 0 AS b FROM (SELECT id, unnest(r) AS x FROM g) UNION ALL SELECT id, x, 0, 1 FROM (SELECT id, unnest(c) AS x FROM g)), h AS (SELECT id, sum(k) AS k FROM (SELECT id, x, least(sum(a), sum(b)) AS k FROM u GROUP BY id, x) GROUP BY id)
 SELECT id AS entry_id, round(CASE WHEN coalesce(k, 0) > 0 THEN 2 * k / (len(r) + len(c)) ELSE 0 END, 6) AS rouge FROM g LEFT JOIN h USING (id)"""


@query(_rouge_sql(1))
def rouge1(spark, d):
    return evaluate.rouge_n(_entry(spark, d, "entry_id", "objective", "question"), "entry_id", "objective", "question", 1).withColumnRenamed("id", "entry_id")


@query(_rouge_sql(2))
def rouge2(spark, d):
    return evaluate.rouge_n(_entry(spark, d, "entry_id", "objective", "question"), "entry_id", "objective", "question", 2).withColumnRenamed("id", "entry_id")


_W = lambda c: f"regexp_extract_all(lower(coalesce({c}, '')), '[a-z0-9]+')"


# the rows of the table of common subsequences, folded over the words of the reference; words are numbers, as a fold has one type
@query(f"""WITH b AS (SELECT entry_id, {_W('objective')} AS r, {_W('question')} AS c FROM entry), n AS (SELECT entry_id, len(r) AS nr, len(c) AS nc, list_transform(r, lambda w: [list_position(c, w)]) AS r, list_transform(c, lambda w: list_position(c, w)) AS c FROM b),
 k AS (SELECT entry_id, nr, nc, list_reduce(r, lambda prev, e: list_reduce(list_transform(range(1, nc + 1), lambda j: [CAST(j AS INTEGER)]), lambda acc, f: list_append(acc, CASE WHEN c[f[1]] = e[1] THEN prev[f[1]] + 1 ELSE greatest(prev[f[1] + 1], acc[f[1]]) END), [0]), list_transform(range(0, nc + 1), lambda j: 0))[nc + 1] AS k FROM n)
 SELECT entry_id, round(CASE WHEN coalesce(k, 0) > 0 THEN 2 * k / (nr + nc) ELSE 0 END, 6) AS rouge FROM k""")
def rouge_l(spark, d):
    return evaluate.rouge_l(_entry(spark, d, "entry_id", "objective", "question"), "entry_id", "objective", "question").withColumnRenamed("id", "entry_id")


@query(f"SELECT entry_id, array_to_string(list_concat(list_slice(t, 1, 16), list_transform(range(0, greatest(16 - len(t), 0)), lambda i: '<pad>')), ' ') AS padded, least(len(t), 16) AS used FROM (SELECT entry_id, {_TOK.format('command')} AS t FROM entry WHERE command IS NOT NULL)")
def pad_truncate_tokens(spark, d):
    t = _entry(spark, d, "entry_id", "command").where("command IS NOT NULL").withColumn("t", X.tokens(F.col("command")))
    padded = F.concat(F.slice("t", 1, 16), F.array_repeat(F.lit("<pad>"), F.greatest(16 - F.size("t"), F.lit(0))))
    return t.select("entry_id", F.array_join(padded, " ").alias("padded"), F.least(F.size("t"), F.lit(16)).cast("long").alias("used"))


@query(f"WITH {_LATEST}, ok AS (SELECT vec_id, CAST(v AS DOUBLE[]) AS v FROM latest WHERE v IS NOT NULL) SELECT vec_id, list_position(v, list_max(v)) - 1 AS best, round(exp(list_max(v)) / list_sum(list_transform(v, lambda x: exp(x))), 6) AS p FROM ok")
def softmax_argmax(spark, d):
    v = table(spark, d, "vector_record").groupBy("vec_id").agg(F.max_by("embedding", "metadata.date_uploaded").alias("v")).where("v IS NOT NULL").withColumn("v", F.transform("v", lambda x: x.cast("double")))
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + F.exp(x))
    return v.select("vec_id", (F.array_position("v", F.array_max("v")) - 1).alias("best"), F.round(F.exp(F.array_max("v")) / total, 6).alias("p"))


# --- pages


def _html(spark, d) -> DataFrame:
    e = _entry(spark, d).where("objective IS NOT NULL AND command IS NOT NULL AND command_name IS NOT NULL")
    return e.select("entry_id", html.entry_page(*(F.col(c) for c in ("objective", "command_name", "command", "description", "syntax", "flags"))).alias("html"))


@query(f"SELECT entry_id, command_name, {_STRIP.format('objective')} AS objective, {_STRIP.format('command')} AS command, len(coalesce(flags, [])) AS n_flags FROM entry WHERE objective IS NOT NULL AND command IS NOT NULL AND command_name IS NOT NULL")
def html_entries(spark, d):
    out = html.parse_pages(_html(spark, d), "entry_id", "html")
    return out.select(F.col("id").alias("entry_id"), "command_name", "objective", "command", F.size("flags").cast("long").alias("n_flags"))


@query("SELECT entry_id, command_name || '|Usage|Flags|Examples' AS titles FROM entry WHERE objective IS NOT NULL AND command IS NOT NULL AND command_name IS NOT NULL")
def html_titles(spark, d):
    return _html(spark, d).select("entry_id", F.array_join(html.titles(F.col("html")), "|").alias("titles"))


# --- beyond the reference: time windows, rollups, streams


@query("SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY ALL")
def events_tumbling(spark, d):
    return table(spark, d, "events").groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("window_start"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value"))


@query("SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY ALL")
def events_stream_tumbling(spark, d):
    return streams.run_to_end(streams.tumbling_counts(streams.stream_of(spark, d, "events"), "ts", "event_type"), "complete")


@query("SELECT DISTINCT event_id FROM events")
def events_stream_dedupe(spark, d):
    return streams.run_to_end(streams.first_of_key(streams.stream_of(spark, d, "events"), "ts", ["event_id"])).select("event_id")


@query("SELECT split_name, source, count(*) AS n, count(question) AS asked FROM entry GROUP BY ROLLUP (split_name, source)")
def entry_rollup(spark, d):
    return _entry(spark, d, "split_name", "source", "question").rollup("split_name", "source").agg(F.count("*").alias("n"), F.count("question").alias("asked"))
