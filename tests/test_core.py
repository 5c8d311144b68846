"""Core operators on literal tables, with expectations written by hand or in plain Python."""

import json
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from granary.functions import text as X
from granary.operators import boundary, dedupe, evaluate, html, prompts, retrieval, rules, sampling, scoring, segment
from granary.plans import catalogue
from granary.sources import readers
from granary.streaming import events


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("fn", "value", "expected"),
    [
        (X.tokens, "a --b=c,d  e", ["a", "--b", "c", "d", "e"]), (X.tokens, "", []), (X.context, "kubectl get kubectl x", "get kubectl x"),
        (X.first_paragraph, "\n \n a \n b\n\nc", "a\nb"), (X.first_paragraph, " \n ", ""), (X.first_paragraph, "x", "x"),
        (X.list_shaped, "1. use it\n2. and then", True), (X.list_shaped, "1. use\n2.", False), (X.list_shaped, "1. 9x", False), (X.list_shaped, "", False),
        (X.red_flag_cut, "1\n2\n3\n4\nby default\n6", "1\n2\n3\n4"), (X.red_flag_cut, "by default\n2\n3", "by default\n2\n3"), (X.red_flag_cut, "1\n2\n3\nby default\nif necessary\n6\n7\nother flags", "1\n2\n3\nby default"),
        (X.cap_lines, "a\n" + "b" * 600, "a"), (X.cap_lines, "b" * 600, ""), (X.cap_lines, " a ", "a"),
        (X.map_unicode, "a‐\nb‐c•d—e’f“g”h↔i–j×kšl…", "ab-c - d-e'f\"g\"h<=>i<=>j*ksls"), (X.drop_running_headers, "a\nTitle | 12\n13 | T\nb", "a\nb"), (X.drop_page_numbers, "a\n 12 \nb", "a\n\nb"), (X.drop_figures, "a\nFigure 1-2. X\nb", "a\n\nb"),
        (X.single_spaces, "  a   b\t", "a b"), (X.rstrip_lines, "a  \n b \t\nc", "a\n b\nc"), (X.reflow, "one\ntwo.\n(three\n- x", "one two. (three - x"), (X.reflow, "a;\nb", "a;\nb"),
        (X.drop_chapter_references, "Good. (see Chapter 3 now) As Chapter 4 says, fine", "Good. fine"),
        (X.drop_chapter_references, 'Pods run, as shown in Chapter 3, "Networking". They stop.', "Pods run. They stop."), (X.drop_chapter_references, "It works, see Chapter 12. Next: Chapter 4 has more; done", "It works. Next: done"), (X.drop_chapter_references, "the pods (see Chapter 3) run\nChapter seven\n", "the pods run\nChapter seven\n"),
        (X.paragraphs, "a.\nb", ["a.", "b."]), (X.markdown, "# a\n---\n\n b", "\\# a  \n___  \n  \n b"),
        (X.snippet, "12 Jan — text — more ", "text — more"), (X.first_statement, "x" * 130 + ". y", "x" * 130), (X.first_statement, "a. b", "a. b"),
        (X.strip, None, None), (X.tokens, None, None),
    ],
)
def test_text(spark, fn, value, expected):
    assert one(spark, value, fn) == expected


def test_answer_marks(spark):
    ask = lambda t: one(spark, t, lambda c: X.answer(c, F.lit(3)))
    assert ask("q? rest") == "rest" and ask("q ### Answer: a #End b") == "a" and ask("q ### Answer: a # Command: c") == "c" and ask("#End # Command: x") == ""


def test_answers_of_all_rows_equal_brute_force(spark, tmp_path):
    texts = ["plain", "a0", "b1", "#End", "q 0 # Command: x", "1 ### Answer: y", "# Command: a #End b # Command: c", "", " x\n### Answer:\ny ", "# Command 2"]
    data = [(i * 100 + j, q, r) for i, q in enumerate([*texts, None]) for j, r in enumerate([*texts, None])]
    spark.createDataFrame(data, "entry_id bigint, question string, chain_of_thought string").write.parquet(f"{tmp_path}/entry.parquet")

    def truth(q, r):
        prompt = f"[INST] {q}\n Lets think step by step. [/INST] ### Answer:" if "0" in q else f"[INST] Answer the following question: {q} [/INST]\nAnswer: " if "1" in q else f"[INST] {q} [/INST]"
        said = f"{prompt}\n{r}\n#End of text"
        start = said.index("### Answer:") + 11 if "### Answer:" in said else len(prompt)
        start = said.index("# Command:") + 10 if "# Command:" in said else start
        return said[start : said.index("#End")].strip()

    got = {r.entry_id: r.answer for r in catalogue.queries()["answer_extract_all"](spark, str(tmp_path)).collect()}
    assert got == {i: truth(q, r) for i, q, r in data if q is not None and r is not None}


DOCS = [(1, "get pods a a/b 12"), (2, "get pods"), (3, "12 12 x"), (4, ""), (5, None), (6, "get")]


def plain_scores():
    words = {i: (t or "").split() for i, t in DOCS}
    corpus = Counter(w for ws in words.values() for w in ws)
    total = sum(corpus.values())
    out = {}
    for i, ws in words.items():
        s = 0.0
        for w in set(ws):
            at = [k for k, v in enumerate(ws) if v == w]
            pos = (sum(at) / len(at)) / (len(ws) - 1) if len(ws) > 2 else 0
            f = 1 - 0.8 / (1 + math.exp(-(10 * pos - 5)))
            p = len(at) / len(ws)
            s += f * 0.5 ** w.count("/") * (0.07 ** len(at) if w.isnumeric() else 1) * p * math.log2(p / (corpus[w] / total))
        if ws:
            out[i] = s / len(set(ws))
    return out


def spread(spark):
    return scoring.words(spark.createDataFrame(DOCS, "id bigint, t string"), "id", F.col("t"))


def test_scores(spark):
    got = {r.id: r.score for r in scoring.kl_corrected(spread(spark)).collect()}
    assert got == pytest.approx(plain_scores(), abs=1e-6)
    assert all(r.score >= 0 for r in scoring.kl_average(spread(spark)).collect() if r.id == 1)


def test_entropy(spark):
    r = scoring.entropy(spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "word string, n bigint")).first()
    assert (r.entropy, r.per_word) == (1.5, 0.5)


def test_pdf_and_cdf(spark):
    scored = spark.createDataFrame([(i, float(i % 7)) for i in range(100)], "id bigint, score double")
    cdf = scoring.score_cdf(scoring.score_pdf(scored)).orderBy("rank").collect()
    assert [r["rank"] for r in cdf] == list(range(1, 101)) and cdf[-1].cdf == pytest.approx(1)
    assert all(a.cdf <= b.cdf + 1e-12 and (a.score, -a.id) >= (b.score, -b.id) for a, b in zip(cdf, cdf[1:]))
    same = scoring.score_pdf(spark.createDataFrame([(1, 2.0), (2, 2.0)], "id bigint, score double"))
    assert [r.pdf for r in same.collect()] == [0.5, 0.5]


def test_multiplier_without_division_by_zero(spark):
    r = spark.createDataFrame([("a", 2.0), ("b", 2.0)], "command_name string, ratio double")
    assert {x.multiplier for x in scoring.adaptive_multiplier(r).collect()} == {scoring.MULTIPLIER_CAP}


def test_percentiles_and_histogram(spark):
    ranked = spark.createDataFrame([(i, float(100 - i), i + 1) for i in range(95)], "id bigint, score double, rank bigint")
    got = {round(r.fraction, 1): r.rows for r in scoring.percentile_prefixes(ranked).collect()}
    assert got == {i / 10: math.floor(95 * i / 10) for i in range(11)}
    assert scoring.histogram(ranked, "score", 5).agg(F.sum("n")).first()[0] == 95
    assert scoring.histogram(spark.createDataFrame([(1.0,), (1.0,)], "score double"), "score", 5).collect()[0].n == 2


def test_dedupe(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, None, "b"), (4, "a", "b")], "id bigint, x string, y string")
    assert sorted(r.id for r in dedupe.first_wins(df, ["x", "y"], "id").collect()) == [1, 3, 4]
    assert [r.id for r in dedupe.unseen(df, df.where("id = 1"), ["x", "y"]).orderBy("id").collect()] == [3, 4]
    both = dedupe.insert_if_absent(df.where("id = 1"), df.where("id > 1"), ["x", "y"], "id")
    assert {r.id: r.inserted for r in both.collect()} == {1: False, 3: True, 4: True}
    assert dedupe.first_wins(df.limit(0), ["x"], "id").count() == 0


def test_nearest_pick_equals_brute_force(spark):
    cdf = [(i, (i + 1) ** 2 / 400, i + 1) for i in range(20)]
    samples = [(k, (k + 0.5) / 50) for k in range(50)]
    got = {r.sample_no: r.id for r in sampling.nearest_pick(spark.createDataFrame(cdf, "id bigint, cdf double, rank bigint"), spark.createDataFrame(samples, "sample_no bigint, value double"), cells=8).collect()}
    assert got == {k: min(cdf, key=lambda r: (round(abs(r[1] - v), 12), -r[1]))[0] for k, v in samples}


def test_samples(spark):
    values = [r.value for r in sampling.truncated_normal(spark, 500).collect()]
    assert len(values) == 500 and all(0 < v < 1 for v in values)
    pdf = scoring.score_pdf(spark.createDataFrame([(i, float(i)) for i in range(60)], "id bigint, score double"))
    picked = [r.id for r in sampling.guided_sample(pdf, 20).collect()]
    assert len(picked) == len(set(picked)) == 20
    parts = sampling.hash_split(spark.range(1000), "id").groupBy("part").count().collect()
    assert {r.part: r["count"] for r in parts}["train"] == pytest.approx(900, abs=40)


def test_top_k_equals_brute_force(spark):
    import numpy as np

    x = np.random.default_rng(0).standard_normal((60, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vector array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    sim = u @ u.T
    np.fill_diagonal(sim, -2)
    got = retrieval.top_k(df.where("id % 10 = 0"), df, 3, query_block=4, base_block=16).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.id) for r in got] == [(q, int(i)) for q in range(0, 60, 10) for i in np.argsort(-sim[q])[:3]]
    hits = retrieval.rerank(spark.createDataFrame([(1, 1, 2, 0.5), (1, 2, 3, 0.4)], "query_id bigint, rank int, id bigint, similarity double"), spark.createDataFrame([(1, "a b"), (2, "c"), (3, " a b ")], "id bigint, text string"), keep=2)
    assert [(r.place, r.id, r.score) for r in hits.orderBy("place").collect()] == [(1, 3, 1.0), (2, 2, 0.0)]
    assert retrieval.context(hits).first().context == "a b\n\nc"


def test_upsert_and_index(spark, tmp_path):
    old = spark.createDataFrame([(1, [1.0], 1), (2, [2.0], 1)], "id bigint, embedding array<double>, v int")
    new = spark.createDataFrame([(2, [3.0], 2), (3, [4.0], 0), (1, [9.0], 0)], "id bigint, embedding array<double>, v int")
    index = readers.VectorIndex(spark, str(tmp_path / "index"))
    assert index.create(old) == 2 and index.create(old, replace=False) == 0 and index.upsert(new, "id", F.col("v")) == 3
    assert sorted((r.id, r.embedding[0]) for r in index.read().collect()) == [(1, 1.0), (2, 3.0), (3, 4.0)]
    assert tuple(index.describe().first()) == (3, 1)
    index.drop()
    assert not index.exists()


@pytest.mark.parametrize("bad", ["$ns:x", "a", "a:b:c", "[a:b", ":", "$a#b#c:d"])
def test_rule_errors(bad):
    with pytest.raises(ValueError):
        rules.parse_rule(bad, [{"d-sub": "x", "c-sub": "y"}])


def test_rule_errors_of_values():
    with pytest.raises(ValueError):
        rules.parse_rule("a:b", [{"d-sub": "", "c-sub": "y"}])
    with pytest.raises(ValueError):
        rules.parse_rule("a:b", [{"d-sub": "x", "c-sub": " "}])


def test_rules_expand():
    parsed = rules.parse_rules({r"name\: web:web": [{"d-sub": "name: shop", "c-sub": "shop"}], "[list, pods]:": [{"d-sub": "[show, items]", "c-sub": ""}], "$get#shop|pods:get": [{"d-sub": "things", "c-sub": "describe"}]})
    assert rules.expand(parsed, "list pods name: web", "get web", None, "s") == ("show items name: shop", "get shop")
    assert rules.expand(parsed, "list pods name: web", "get web", "get", "s") == ("list things name: shop", "describe shop")
    assert rules.expand(parsed, "", "", None, "s") == ("", "")
    # what was written is never matched again
    loop = rules.parse_rules({"a:": [{"d-sub": "aa", "c-sub": ""}]})
    assert rules.expand(loop, "a", "", None, "s")[0] == "aa" and rules.expand(loop, "aba", "", None, "s")[0] == "aabaa"


def test_rules_table_equals_the_python_matcher(spark):
    parsed = rules.parse_rules({"x:y": [{"d-sub": "1", "c-sub": "2"}], "[x, z]:": [{"d-sub": "[1, 2]", "c-sub": ""}], "$n#x | z:": [{"d-sub": "q", "c-sub": ""}]})
    df = spark.createDataFrame([(1, "x z", "y", "n"), (2, "x", "y", "m"), (3, "z x", "", "m"), (4, None, "y", None), (5, "x..z", "", "m")], "id bigint, d string, c string, n string")
    got = {r.id: r.ordinal for r in rules.best_rule(df, rules.rules_table(spark, parsed), "id", "d", "c", "n").collect()}
    assert got == {1: 2, 2: 0, 5: 1}


def test_expand_until(spark):
    parsed = rules.parse_rules({"web:web": [{"d-sub": f"n{i}", "c-sub": f"n{i}"} for i in range(9)]})
    df = spark.createDataFrame([(i, f"{i} web", "web", "n") for i in range(3)], "id bigint, d string, c string, n string")
    out = rules.expand_until(df, parsed, 10, ["objective", "command"], id_column="id", description="d", code="c", namespace="n")
    assert out.count() == 10 and out.distinct().count() == 10


@pytest.mark.parametrize(("counts", "expected"), [([], [(0, 0)]), ([600], [(0, 1)]), ([512, 1], [(0, 1), (1, 2)]), ([128] * 5, [(0, 4), (1, 5)]), ([0, 0], [(0, 2)])])
def test_windows(counts, expected):
    assert segment.windows(counts) == expected


def test_blocks_are_masked_and_restored():
    text = "Before\napiVersion: v1\nkind: Pod\nspec:\n  x: 1\n\n$ kubectl get x \\\n  -n web\nAfter"
    masked, blocks = segment.mask_blocks(text)
    assert masked == "Before\n_YAML$0_\n\n_CODE$1_\nAfter" and [b[1] for b in blocks] == ["yaml", "bash"]
    assert "```yaml\napiVersion: v1\nkind: Pod" in segment.unmask(masked, blocks)
    assert segment.mask_blocks(None) == (None, []) and segment.mask_blocks("a: b\n" * 50_000)[1][0][1] == "yaml"


def test_shell_input_goes_on_over_lines():
    text = "$ ls \\\nmore\nkubectl get x\ndocker run \\\n  -v a \\\n  img\nkubectl\\\nnot indented"
    masked, blocks = segment.mask_blocks(text)
    assert masked == "_CODE$0_\nkubectl get x\n_CODE$1_\nkubectl\\\nnot indented"
    assert [b[2] for b in blocks] == ["$ ls \\\nmore", "docker run \\\n  -v a \\\n  img"]


def test_chunker_gives_the_code_back(spark):
    text = "First line\ngoes on here.\n\n$ kubectl get x \\\n  -n web\n\nLast one (see Chapter 3)."
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "id bigint, text string")
    got = {(r.id, r.window_no): (r.n_tokens, r.text) for r in segment.chunk_texts(df, "id", "text").collect()}
    assert got[1, 0][1] == "First line goes on here.\n\n```bash\n$ kubectl get x \\\n  -n web\n```\n\nLast one." and set(got) == {(1, 0), (3, 0)}
    small = [r.text for r in segment.chunk_texts(df, "id", "text", budget=1, stride=1).orderBy("window_no").collect() if r.id == 1]
    assert len(small) == 3 and "```bash" in small[1]


def test_boundaries_of_files_and_searches(spark):
    from granary.operators import prompts, retrieval
    from granary.sources import readers

    files = spark.createDataFrame([("a", bytearray(b"one|two")), ("b", bytearray(b"\xff"))], "path string, content binary")
    assert {r.path: r.pages for r in readers.extract_pages(files, lambda b: b.decode().split("|")).collect()} == {"a": ["one", "two"], "b": None}

    def search(prompt):
        return ["1 May — first", "second"] if prompt == "x" else 1 / 0

    asked = spark.createDataFrame([(1, "x"), (2, "y")], "query_id bigint, prompt string")
    found = retrieval.search_results(readers.search_web(asked, search))
    assert [tuple(r) for r in found.collect()] == [(1, "first  \nsecond")]
    out = {(r.query_id, r.retriever): r for r in prompts.fan_out(asked, {"none": None, "web": found}).collect()}
    assert len(out) == 4 and out[1, "none"].trace == "" and "first  \nsecond </s>" in out[1, "web"].full_prompt and "### Step 3" in out[2, "web"].trace


def test_command_line(spark, tmp_path):
    from granary.__main__ import main

    main(["example_partition", "--data", "/root/testdata/sf0.001", "--out", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 24
    with pytest.raises(SystemExit):
        main(["no_such_query", "--data", "x"])


def test_few_shot_by_join_equals_the_array(spark, monkeypatch):
    entries, examples = spark.range(30), spark.range(9).withColumnRenamed("id", "example_id")
    picked = lambda: sorted(tuple(r) for r in sampling.few_shot(entries, examples, "id", "example_id").collect())
    narrow = picked()
    monkeypatch.setattr(sampling, "FEW", 5)
    assert len(narrow) == 90 and picked() == narrow and sampling.few_shot(entries, examples.limit(0), "id", "example_id").count() == 0


def test_guided_sample_is_never_short(spark):
    pdf = scoring.score_pdf(spark.createDataFrame([(i, float(i)) for i in range(5)], "id bigint, score double"))
    with pytest.raises(ValueError):
        sampling.guided_sample(pdf, 6)


def test_sections(spark):
    df = spark.createDataFrame([(1, "intro\nOne\na\nTwo\nb", ["One", "Two"]), (2, "Two\nOne", ["One", "Two"]), (3, None, None)], "id bigint, t string, titles array<string>")
    got = [tuple(r) for r in segment.split_sections(df, ["id"], "t", "titles").orderBy("id", "section_no").collect()]
    assert got == [(1, 0, None, "intro"), (1, 1, "One", "a"), (1, 2, "Two", "b"), (2, -1, None, "Two\nOne"), (3, 0, None, "")]
    assert one(spark, "x CHAPTER 1\na\nCHAPTER 2\nb", segment.split_chapters) == ["\na\n", "\nb"] and one(spark, "x", segment.split_chapters) == []


def test_flags(spark):
    flags = [("all", None, None, ""), ("output", " o", "", ""), ("watch", "w", "false", ""), ("", None, None, "")]
    df = spark.createDataFrame([("kubectl get --all-namespaces -o wide", flags), ("kubectl", None)], "command string, flags array<struct<option: string, short: string, default_value: string, description: string>>")
    assert [[f["option"] for f in r.k] for r in df.select(prompts.relevant_flags(F.col("command"), F.col("flags")).alias("k")).collect()] == [["all", "output", "watch"], []]
    with pytest.raises(Exception, match="without an option"):
        df.select(prompts.relevant_flags(F.col("command"), F.col("flags"), strict=True)).collect()


def test_instruction_prompts_are_of_both_kinds(spark):
    got = catalogue.queries()["prompt_instruction_by_kind"](spark, "/root/testdata/sf0.001").groupBy("specific").count().collect()
    assert {r.specific for r in got} == {True, False}


def test_routes(spark):
    df = spark.createDataFrame([("0 1",), ("1",), ("x",)], "r string").select(prompts.route(F.col("r")).alias("k"))
    assert [r.k for r in df.collect()] == [0, 1, 2]
    doc = spark.createDataFrame([("q", None), ("q", "d")], "p string, d string").select(prompts.routed_prompt(F.col("p"), F.lit(1), documentation=F.col("d")).alias("t")).collect()
    assert doc[0].t == "[INST] Answer the following question: q [/INST]\nAnswer: " and "Documentation: d </s>" in doc[1].t


def test_metrics(spark):
    m = spark.createDataFrame([("a", "a", 2), ("a", "b", 1), ("b", "b", 1), ("c", "a", 1)], "label string, predicted string, n bigint")
    r = evaluate.macro_metrics(m).first()
    assert tuple(r) == (0.6, round((2 / 3 + 1 / 2) / 3, 6), round((2 / 3 + 1) / 3, 6), round((2 / 3 + 2 / 3) / 3, 6))


def test_rouge(spark):
    df = spark.createDataFrame([(1, "the cat sat", "the cat ran"), (2, "", None), (3, "a a b", "a b")], "id bigint, r string, c string")
    get = lambda t: {x.id: x.rouge for x in t.collect()}
    assert get(evaluate.rouge_n(df, "id", "r", "c", 1)) == {1: 0.666667, 2: 0.0, 3: 0.8}
    assert get(evaluate.rouge_n(df, "id", "r", "c", 2)) == {1: 0.5, 2: 0.0, 3: 0.666667}
    assert get(evaluate.rouge_l(df, "id", "r", "c")) == {1: 0.666667, 2: 0.0, 3: 0.8}


def test_rouge_of_several_lines():
    assert evaluate.rouge_lsum("w1 w2 w3 w4 w5", "w1 w2 w6 w7 w8\nw1 w3 w8 w9 w5") == round(8 / 15, 6)
    assert evaluate.rouge_lsum("b c\na", "a\nb c") == 1.0 and evaluate.rouge_lsum("a a", "a") == round(2 / 3, 6)
    assert evaluate.rouge_lsum(None, "a") == evaluate.rouge_lsum("\n", "") == 0.0


def test_pages(spark):
    page = "<h1>lost</h1><p>x<hr><h1>get</h1><p>Shows <b>it</b> [http://a b]</p><h2 id='usage'>U</h2><code>$ get NAME</code><h2 id=flags>F</h2><table><tr><td>all</td><td></td><td>false</td><td>All &lt;x&gt;</td></tr><tr><td>odd</td></tr></table><h2 id='examples'>E</h2><p>One</p><code>get a</code><p>Two</p><p>Three</p><code>get b</code><h1>none</h1><p>no examples</p>"
    got = html.parse_page(page)
    assert got == [{"command_name": "get", "description": "Shows it", "syntax": "get NAME", "flags": [{"option": "all", "short": None, "default_value": "false", "description": "All <x>"}], "examples": [{"description": "One", "code": "get a"}, {"description": "Two", "code": "get b"}]}]
    assert html.parse_page(None) == [] and html.parse_page("<p>x") == []
    assert one(spark, page, html.titles)[:2] == ["lost", "get"]


def test_boundaries(spark):
    calls = []

    def flaky(x):
        calls.append(x)
        if len(calls) < 3:
            raise OSError
        return x

    assert boundary.with_retries(flaky, (0, 0, 0))("a") == "a" and len(calls) == 3
    with pytest.raises(ZeroDivisionError):
        boundary.with_retries(lambda: 1 / 0, (0,))()
    df = spark.createDataFrame([(1, "p"), (2, "p"), (3, "q")], "id bigint, prompt string")
    cache = spark.createDataFrame([("q",)], "p string").select(F.sha2("p", 256).alias("key"), F.lit("old").alias("reply"))
    replies, new = boundary.call_cached(df, "id", "prompt", cache, lambda p: boundary.echo_generator("s", p))
    got = {r.id: r.reply for r in replies.collect()}
    assert got[1] == got[2] != "old" and got[3] == "old" and new.count() == 1
    assert math.isclose(sum(v * v for v in boundary.hashed_embedder("a b c")), 1, abs_tol=1e-5) and len(boundary.hashed_embedder("")) == 64
    assert one(spark, "a</s>b#End", lambda c: boundary.stop_at(c, ["#End", "</s>"])) == "a"


def test_readers(spark, tmp_path):
    entry = {"objective": "o", "command_name": "get", "command": "c", "description": "", "syntax": "", "flags": [{"option": "a", "short": None, "default_value": "x", "description": ""}]}
    (tmp_path / "e.json").write_text(json.dumps([entry]))
    e = readers.read_entries(spark, str(tmp_path / "e.json"))
    assert e.count() == 1 and e.first().question is None
    readers.write_entries(e, str(tmp_path / "out"))
    assert readers.read_entries(spark, str(tmp_path / "out")).first().flags[0].option == "a"
    (tmp_path / "q.json").write_text(json.dumps({"examples": [{"instruction": "i", "command": "c", "specific": True}]}))
    assert readers.read_few_shot(spark, str(tmp_path / "q.json")).first().specific is True
    (tmp_path / "r.json").write_text(json.dumps({"b:c": [{"d-sub": "1", "c-sub": "2"}], "a:c": []}))
    assert [(r.ordinal, r.rule) for r in readers.read_rule_set(spark, str(tmp_path / "r.json")).collect()] == [(0, "b:c"), (1, "a:c")]
    (tmp_path / "t.json").write_text(json.dumps({"chapter_metadata": [{"title": "A", "parts": [{"title": "p", "parts": ["s"]}]}, {"title": "B", "parts": []}]}))
    assert [(r.chapter, r.part) for r in readers.read_toc(spark, str(tmp_path / "t.json")).orderBy("chapter_no").collect()] == [("A", "p"), ("B", None)]
    assert readers.read_binary(spark, str(tmp_path / "t.json")).first().length > 0
    pages = spark.createDataFrame([(1, ["a", "b", "c"])], "id bigint, pages array<string>")
    assert [(r.page_no, r.page) for r in readers.from_page(pages, "pages", 1).collect()] == [(1, "\nb"), (2, "\nc")]


def test_streams(spark, tmp_path):
    from datetime import datetime

    rows_ = [(1, datetime(2024, 1, 1, 5), "a", 1.0), (1, datetime(2024, 1, 1, 5), "a", 1.0), (2, datetime(2024, 1, 2), "b", 2.0)]
    spark.createDataFrame(rows_, "event_id bigint, ts timestamp_ntz, kind string, value double").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    stream = lambda: events.stream_of(spark, str(tmp_path), "events")
    assert sorted((r.kind, r.n) for r in events.run_to_end(events.tumbling_counts(stream(), "ts", "kind"), "complete").collect()) == [("a", 2), ("b", 1)]
    assert events.run_to_end(events.first_of_key(stream(), "ts", ["event_id"])).count() == 2


def test_intermediate_tables_are_in_a_folder_of_the_application(spark):
    from granary.session import cut, work_dir

    df = cut(spark.range(5), "x")
    assert df.count() == 5 and spark.sparkContext.applicationId in work_dir(spark) and work_dir(spark) in df.inputFiles()[0].replace("file:///", "file:/").replace("file:/", "file:///")
