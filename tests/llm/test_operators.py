"""Operators on small tables, against brute force; nulls, empties, ties, repeats, empty tables and clashing names."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import lookalike, neighbours, overlap, packing, pairs, queries, residue, scanned, splitting, tokenize, truncation

WORDS = [a + b for a in ("ka", "lo", "mi", "ru", "te", "vo", "xi", "za") for b in ("bel", "don", "fir", "gam", "hul", "jor", "pen", "sit")]


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_encode_table(spark):
    df = spark.createDataFrame([(1, "Hello world", "c"), (2, "", "c"), (3, None, None), (4, "Hello world", "c")], "doc_id bigint, text string, ids string")
    got = {r.doc_id: list(r.ids) for r in tokenize.encode_table(df, "doc_id", "text").collect()}
    assert got[2] == got[3] == [] and got[1] == got[4] == [15496, 995]
    assert tokenize.encode_table(df.limit(0), "doc_id", "text").count() == 0


def test_pack_table(spark):
    rng = random.Random(3)
    docs = [(i, [rng.randrange(99) for _ in range(n)]) for i, n in enumerate([0, 5, 20, 45, 7, 100, 20, 20, 13, 1, 19, 20])]
    df = spark.createDataFrame(docs, "doc_id bigint, ids array<int>").withColumn("shard", F.lit("x"))
    got = packing.pack_table(df, "doc_id", capacity=20, shard_rows=6).collect()
    used, tokens, pieces = {}, {}, {}
    for r in got:
        used[r.container] = used.get(r.container, 0) + r.n_tokens
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.n_tokens
        pieces.setdefault(r.doc_id, []).append(r.piece_no)
    assert max(used.values()) <= 20 and tokens == {i: len(t) for i, t in docs}
    assert all(sorted(p) == list(range(len(p))) for p in pieces.values()) and [len(pieces[i]) for i in (0, 1, 2, 3, 5)] == [1, 1, 1, 3, 5]
    assert packing.pack_table(df.limit(0), "doc_id").count() == 0


def test_truncation(spark):
    rng = random.Random(5)
    sentence = lambda: f"The {rng.choice(['agent', 'planner', 'probe'])} watches the {rng.choice(['shared cache', 'oldest snapshot', 'signing certificate'])} while the node drains."
    docs = [(i, " ".join(sentence() for _ in range(6))) for i in range(150)] + [(200 + i, sentence() + "\n\n- Watches the shared cache\n- Drops the oldest snapshot") for i in range(12)] + [(300 + i, sentence() + f"\n\nCheers, {WORDS[i]}") for i in range(12)]
    cut = [(900, sentence() + " The agent watches the"), (901, sentence() + " The probe watches the signing certif"), (902, sentence() + "\n```\nkubectl get x"), (903, sentence() + " The planner watches…"), (904, "| a | b |\n| c |")]
    whole = [(950, None), (951, ""), (952, " \n"), (953, sentence() + "\n```\nkubectl get x\n```"), (954, "| a | b |"), (955, docs[0][1])]
    df = spark.createDataFrame(docs + cut[:4] + whole, "doc_id bigint, text string").withColumn("doc", F.lit(1)).withColumn("source", F.expr("CASE WHEN doc_id >= 900 THEN NULL ELSE 'a' END"))
    found = truncation.cut_documents(df)
    assert [r[0] for r in rows(found, "doc_id")] == [900, 901, 902, 903]
    share = {r.source: (r.documents, r.cut) for r in truncation.cut_share(df, found).collect()}
    assert share == {"a": (174, 0), None: (10, 4)}
    assert truncation.cut_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [150, 1500])
def test_truncation_at_an_ellipsis(spark, n):
    """An ellipsis shows nothing by itself: what is before it decides, alike at both sizes."""
    rng = random.Random(6)
    sentence = lambda: f"The {rng.choice(['agent', 'planner', 'probe'])} {rng.choice(['watches', 'drops', 'copies'])} the {rng.choice(['shared cache', 'oldest snapshot', 'signing certificate'])} while the {rng.choice(['node', 'zone', 'queue'])} drains."
    body = lambda: " ".join(sentence() for _ in range(6))
    docs = [(i, body()) for i in range(n)] + [(10_000 + i, body() + "\n\nAnd so on...") for i in range(n // 10)]
    cut = [(20_000, body() + " The agent watches the…"), (20_001, body() + " The probe drops the signing certif..."), (20_002, body() + " The probe drops [more]"), (20_003, body() + "\n\n```\nkubectl get x...")]
    found = truncation.cut_documents(spark.createDataFrame(docs + cut, "doc_id bigint, text string"))
    assert rows(found, "doc_id", "reason") == [(20_000, "trigram"), (20_001, "word"), (20_002, "mark"), (20_003, "code")]


def test_residue(spark):
    real = ["How do I list pods?", "Which pod returns the 502 bad gateway error reported by kilo?", "Does the page of kilo need JavaScript disabled?", "How do I replace the TODO annotation on kilo?", "What does jsonpath={.items[*].spec} show for kilo?", "How do I print kilo with the template {{.metadata.name}}?", "How do I pass $HOME and <none> filters to kilo?", "Wie bearbeite ich kilo?", "I do not know lorem, could you explain it?"]
    bad = ["How do I list {{ name }}?", "Show <your app here> in web", "How can I copy %s out of pod?", "How do I scale ${RESOURCE}?", "Lorem ipsum dolor sit amet", "blah blah blah", "TODO: write question", "[Insert question here]", "404 Not Found\nReference ab12cd34ef56", "Please enable JavaScript to go on.", "Checking your browser before you go on.", "undefined", "Seite nicht gefunden.\nTrace: 99aa88bb77cc", "java.lang.NullPointerException\n  at Renderer.java:12", "Sorry, we couldn't find that page.", "Text here kilo text here text", "Error 1020: Access denied"]
    shared = [f"How do I list {w}?\nPlease try again later." for w in WORDS[:5]]
    data = [(i, t, "h") for i, t in enumerate(real + [None, "", " "] + shared)] + [(100 + i, t, None if i % 2 else "h") for i, t in enumerate(bad)]
    df = spark.createDataFrame(data, "entry_id bigint, question string, source string").withColumn("text", F.lit(0)).withColumn("kind", F.lit(0))
    found = residue.residue(df, "entry_id", "question", "source")
    assert [r[0] for r in rows(found, "entry_id")] == [100 + i for i in range(len(bad))]
    assert residue.without_residue(df, "entry_id", "question", "source").count() == len(data) - len(bad)
    assert residue.residue(df.limit(0), "entry_id", "question", "source").count() == 0


def test_residue_keeps_recurrent_evidence(spark):
    pages = ["# Access denied\nstatus=1020 Retry after 984 seconds.", "# Access denied\nstatus=1020", "# Access denied\nReference ab12cd34ef56", "# Access denied\nRequest id 99aa88bb77cc.\nTrace: 11aa22bb33cc", "Which page are you looking for?\n# Access denied\nstatus=1020"]
    asked = [f"How do I reach the mirror?\n{x}" for x in ("404 Not Found", "502 Bad Gateway", "Gateway Timeout (504)", "410 Gone")]
    other = [f"How do I list {a} in {b}?" for a in WORDS for b in WORDS[:10]]
    small = [(i, t, "small") for i, t in enumerate(pages + [f"Which page are you looking for?\nHow do I list {w}?" for w in WORDS[:3]])]
    df = spark.createDataFrame(small + [(100 + i, t, "large") for i, t in enumerate(pages[:4] + asked + other)], "entry_id bigint, question string, source string")
    assert [r[0] for r in rows(residue.residue(df, "entry_id", "question", "source"), "entry_id")] == [0, 1, 2, 3, 4, 100, 101, 102, 103]


def test_residue_counts_records_of_one_line(spark):
    data = [(i, t, "h") for i, t in enumerate(["Which page are you looking for?", "Which page are you looking for?\nundefined", "Which page are you looking for?\nHow do I list kilo?"])]
    df = spark.createDataFrame(data, "entry_id bigint, question string, source string")
    assert rows(residue.residue(df, "entry_id", "question", "source"), "entry_id", "kind") == [(1, "template")]


def test_residue_of_one_line_is_subtracted_from_longer_records(spark):
    data = [(0, "Welcome to the mirror page."), (1, "Welcome to the mirror page.\n404 Not Found"), (2, "Welcome to the mirror page. "), (3, "Welcome to the mirror page.\nHow do I list kilo?"), (4, "Welcome to the mirror page.\nHow do I drain kilo?")]
    df = spark.createDataFrame(data, "entry_id bigint, question string").withColumn("source", F.lit("h"))
    assert rows(residue.residue(df, "entry_id", "question", "source"), "entry_id", "kind") == [(1, "error")]


@pytest.mark.parametrize("n", [200, 2000])
def test_residue_is_learned_from_recurrence(spark, n):
    """Wordings that no list has are found by their recurrence under subjects that they don't name, alike at both sizes; a request that recurs isn't."""
    rng = random.Random(8)
    names = ["".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(4)) for _ in range(n)]
    ask = [(i, f"How do I list the {w} pods?", f"kubectl get {w}") for i, w in enumerate(names)]
    often = [(10_000 + i, "How do I list the pods of a zone?", f"kubectl get pods {w}") for i, w in enumerate(names[: n // 20])]
    odd = [(20_000 + i, f"Our hamsters rest just now.\nSession {i}{i}{i}", f"kubectl drain {w}") for i, w in enumerate(names[: n // 20])]
    once = [(30_000, "Our parrots sing.", "kubectl cordon x")]
    df = spark.createDataFrame(ask + often + odd + once, "entry_id bigint, question string, command string").withColumn("source", F.lit(None).cast("string"))
    found = rows(residue.residue(df, "entry_id", "question", "source", ("command",)), "entry_id", "kind")
    assert found == [(20_000 + i, "recurrent") for i in range(n // 20)]
    assert residue.residue(df, "entry_id", "question", "source").count() == 0


def test_lookalike_table(spark):
    plain = [(i, "The scope of the class stays the same.") for i in range(6)]
    odd = [(10, "The ѕсоре of it"), (11, "the сlаѕѕ"), (12, "тест «привет»"), (13, None), (14, ""), (15, "ｗｉｄｅ é")]
    df = spark.createDataFrame(plain + odd, "row_id bigint, body string").withColumn("fault", F.lit(1))
    got = {r.row_id: r.text for r in lookalike.normalised(df, ["row_id"], "body").collect()}
    assert got[10] == "The scope of it" and got[11] == "the class" and got[12] == "тест «привет»" and got[13] is None and got[14] == "" and got[15] == "wide é" and len(got) == 12
    assert rows(lookalike.faulty(df, ["row_id"], "body"), "row_id", "fault") == [(11, "mixed"), (15, "wide")]
    assert lookalike.normalised(df.limit(0), ["row_id"], "body").count() == 0


@pytest.mark.parametrize("n", [10, 400])
def test_lookalike_leaves_genuine_words_at_any_size(spark, n):
    """A foreign word with a Latin twin stays beside words of its script, and where it recurs as often as the twin; a disguised word is replaced."""
    texts = ["the cop of the zone"] * n + ["сор и мусор"] + ["сее"] * n + ["the cee"] * n + ["one ѕсоре here"] + ["the scope of it"] * n
    df = spark.createDataFrame(list(enumerate(texts)), "row_id bigint, body string")
    got = {r.text for r in lookalike.normalised(df, ["row_id"], "body").collect()}
    assert {"сор и мусор", "сее", "one scope here"} <= got and "one ѕсоре here" not in got


def test_split_table(spark):
    long = "One sentence here. " * 200
    df = spark.createDataFrame([(1, long), (2, "short"), (3, None), (4, ""), (5, "x" * 2000)], "row_id bigint, body string").withColumn("piece", F.lit(1))
    got = splitting.split_long(df, ["row_id"], "body").orderBy("piece_no").collect()
    assert {r.row_id for r in got} == {1} and "".join(r.piece[r.shared :] for r in got) == long


def overlap_truth(data):
    sets = {i: (s, set(re.findall("[a-z0-9]+", " ".join(x or "" for x in t).lower()))) for i, s, *t in data}
    return sorted((min(a, b), max(a, b)) for a, (sa, wa) in sets.items() for b, (sb, wb) in sets.items() if sa == "train" and sb in ("validate", "test") and wa and wb and len(wa & wb) >= 0.8 * len(wa | wb))


def test_overlap_equals_brute_force(spark):
    rng = random.Random(11)
    data = []
    for i in range(160):
        words = [rng.choice(WORDS) for _ in range(rng.choice([0, 1, 2, 3, 12, 30]))]
        if data and rng.random() < 0.5:
            words = " ".join(x or "" for x in rng.choice(data)[2:]).split()
            for _ in range(rng.randrange(3)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(WORDS)
        data.append((i, rng.choice(["train", "train", "validate", "test", None]), " ".join(words) or None, None, "X " * rng.randrange(2)))
    df = spark.createDataFrame(data, "entry_id bigint, split_name string, objective string, question string, command string").withColumn("source", F.lit("s")).withColumn("cls", F.lit(1)).withColumn("key", F.lit(1))
    found = overlap.overlaps(df, "entry_id", ["objective", "question", "command"], "split_name")
    truth = overlap_truth(data)
    assert len(truth) > 20 and rows(overlap.row_pairs(*found), "id_a", "id_b") == truth
    assert sum(r.pairs for r in overlap.overlap_report(*found, df, "entry_id", "source").collect()) == len(truth)
    # every key refined twice, and none ever
    for common, levels in ((0, 3), (0, 1)):
        again = overlap.overlaps(df, "entry_id", ["objective", "question", "command"], "split_name", common=common, levels=levels)
        assert rows(overlap.row_pairs(*again), "id_a", "id_b") == truth
    empty = overlap.overlaps(df.limit(0), "entry_id", ["objective"], "split_name")
    assert overlap.row_pairs(*empty).count() == 0


def test_overlap_with_a_hot_group_of_copies(spark):
    data = [(i, "train" if i % 3 else "test", "same words for all rows", None, None) for i in range(300)]
    df = spark.createDataFrame(data, "entry_id bigint, split_name string, objective string, question string, command string")
    pairs_, members = overlap.overlaps(df, "entry_id", ["objective", "question", "command"], "split_name")
    assert pairs_.count() == 1 and members.count() == 300 and overlap.row_pairs(pairs_, members).count() == 200 * 100


def test_pair_defects(spark):
    def row(i, question, response, command, sub="get"):
        return (i, question, response, command, sub, "List it")

    good = [row(i, f"How do I list {w} in web?", f"1. use the get subcommand.\n2. the target is called {w}.\n3. set the namespace to web.", f"kubectl get {w} -n web") for i, w in enumerate(WORDS[:40])]
    refusals = [row(100 + i, f"How do I drop {w} in web?", f"Unfortunately, this request goes against what I may do here. Try {w}.", f"kubectl delete {w} -n web", "delete") for i, w in enumerate(WORDS[:8])]
    other = [
        row(200, "How do I list kilo in web?", "I cannot assist with that.", "kubectl get kilo -n web"), row(201, "How do I list kilo in web?", "1. benutze get als Unterbefehl.\n2. setze den Namensraum auf web.", "kubectl get kilo -n web"),
        row(202, "How do I list kilo in web?", "How do I list kilo in web?", "kubectl get kilo -n web"), row(203, "How do I list kilo in web?", None, "kubectl get kilo -n web"), row(204, None, None, None),
        row(205, "How do I list kilo in web?", "1. use the get subcommand.\n2. the target is called kilo.\n3. set the namesp", "kubectl get kilo -n web"), row(206, "How do I list kilo in web?", "1. use the get subcommand.\n2. sorry states need the name kilo.\n3. set the namespace to web.", "kubectl get kilo -n web"),
        row(207, "{{name}}", "1. use the get subcommand.\n2. set the namespace to web.", "kubectl get kilo -n web"),
    ]
    df = spark.createDataFrame(good + refusals + other, "entry_id bigint, question string, chain_of_thought string, command string, command_name string, objective string").withColumn("kind", F.lit(1)).withColumn("prompt", F.lit(1))
    got = dict(rows(pairs.defects(df), "entry_id", "defect"))
    assert got == {**{100 + i: "refusal" for i in range(8)}, 200: "refusal", 201: "language", 202: "copy", 203: "empty", 205: "truncated"}
    assert pairs.defects(df.limit(0)).count() == 0


def test_steps_cut_short_equal_brute_force(spark):
    rng = random.Random(4)
    whole = [" ".join(rng.choice(WORDS[:12]) for _ in range(rng.randrange(1, 7))) for _ in range(60)]
    steps = {w: rng.choice([1, 2, 9, 40]) for w in whole + [w[: rng.randrange(1, len(w) + 1)].rstrip() for w in whole for _ in range(3)] + [""]}
    df = spark.createDataFrame(list(steps.items()), "step string, n bigint")
    truth = sorted(a for a in steps if a and any(b.startswith(a) and b != a and m >= 8 and m >= 8 * steps[a] for b, m in steps.items()))
    assert len(truth) > 20 and [r[0] for r in rows(pairs.cut_short(df, df.where("n >= 8")), "step")] == truth


def test_minhash_clusters_are_verified(spark):
    a = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    df = spark.createDataFrame([(a,), (a + " more",), ("something else altogether that is not alike at all",), ("no",)], "opening string")
    got = dict(rows(pairs.minhash_clusters(df), "opening", "cluster"))
    assert len(got) == 4 and got[a] == got[a + " more"] and len(set(got.values())) == 3


def test_minhash_links_are_followed_to_their_ends(spark):
    chain = [" ".join(f"w{i:02}" for i in range(k, k + 40)) for k in range(12)]
    got = dict(rows(pairs.minhash_clusters(spark.createDataFrame([(t,) for t in chain], "opening string")), "opening", "cluster"))
    assert got == {t: chain[0] for t in chain}


def test_bucket_links_without_the_least_member():
    sets = {"a": set(range(50, 70)), "b": set(range(20)), "c": set(range(19)), "d": set(range(1, 20)), "e": set(range(90, 99))}
    found = {frozenset(p) for p in pairs.bucket_links(list(sets), list(sets.values()))}
    assert set().union(*found) == {"b", "c", "d"} and len(found) == 2


def vector_truth(ids, x, k):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    sim = np.round(x @ x.T, 7)
    np.fill_diagonal(sim, -2)
    best = np.lexsort((np.broadcast_to(ids, sim.shape), -sim), axis=1)[:, :k]
    return {(min(ids[i], ids[j]), max(ids[i], ids[j])) for i in range(len(ids)) for j in best[i]}


def test_neighbours_reach_the_exact_ones(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((25, 16))
    x = np.concatenate([c + 0.2 * rng.standard_normal((24, 16)) for c in centres])
    data = [(int(i), v.tolist(), "2024-01-02") for i, v in enumerate(x)] + [(0, [1.0] * 16, "2023-01-01"), (9000, None, "2024-01-01"), (9001, [0.0] * 16, "2024-01-01"), (9002, [1.0, 2.0], "2024-01-01"), (9003, [float("nan")] * 16, None)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<float>, d string").withColumn("cls", F.lit(1)).withColumn("vector", F.lit(1))
    found = neighbours.nearest(neighbours.latest_vectors(df, "vec_id", "embedding", F.col("d")), k=5, cell_rows=64)
    got = set(rows(neighbours.neighbour_pairs(found), "vec_id_a", "vec_id_b"))
    truth = vector_truth(np.arange(len(x)), x, 5)
    assert len(got & truth) / len(truth) >= 0.95 and found.count() == 5 * len(x)


def test_neighbours_of_copies_and_few_vectors(spark):
    data = [(i, [1.0, 0.0]) for i in range(30)] + [(100, [0.0, 1.0]), (101, [0.6, 0.8])]
    df = spark.createDataFrame(data, "id bigint, vector array<float>")
    got = {r.id: [] for r in df.collect()}
    for r in neighbours.nearest(df, k=3).orderBy("id", "rank").collect():
        got[r.id].append(r.neighbour)
    assert got[0] == [1, 2, 3] and got[2] == [0, 1, 3] and got[29] == [0, 1, 2] and got[100] == [101, 0, 1] and got[101] == [100, 0, 1]
    assert neighbours.nearest(df.where("id = 100")).count() == 0 and neighbours.nearest(df.limit(0)).count() == 0


def test_neighbours_in_many_cells_read_each_bucket_three_times(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([np.repeat(rng.standard_normal((480, 32)), 12, axis=0) + 0.15 * rng.standard_normal((5760, 32)), rng.standard_normal((240, 32))])
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)[rng.permutation(6000)]
    centres, ids, buckets = x[:200], np.arange(6000), 10
    cells = neighbours.cell_of(x, centres).astype(np.int32)
    groups = np.zeros(6000, dtype=np.int64)
    for c in range(200):
        own = np.flatnonzero(cells == c)
        groups[own] = c * 6000 + neighbours.groups_of(x[own])
    order = np.argsort(groups, kind="stable")
    table = neighbours.Bucket(cells[order], ids[order], x[order], groups[order])
    reads = []

    def read(b):
        reads.append(b)
        mine = table.cells * buckets // 200 == b
        return neighbours.Bucket(*(y[mine] for y in table))

    found = 0
    for own in range(buckets):
        reads.clear()
        mine, who, sim = neighbours.search_bucket(own, buckets, read, centres, neighbours.stable_rank(x), 5, 0.99, near=24)
        assert max(reads.count(b) for b in range(buckets)) == 3  # lone vectors want all buckets; each leaf of 128 read its cells again before
        truth = x[mine] @ x.T
        truth[np.arange(len(mine)), mine] = -2
        found += sum(len(set(a) & set(b)) for a, b in zip(who.tolist(), np.argsort(-truth, axis=1)[:, :5].tolist()))
        assert np.allclose(np.take_along_axis(truth, who, 1), sim, atol=1e-5) and all(len(set(w)) == 5 for w in who.tolist())
    assert found / 30_000 >= 0.99


def test_scanned_table(spark):
    text = "The node agent watches the shared cache while the planner drops the oldest snapshot of the storage class."
    chapter = spark.createDataFrame([(1, "Safe Defaults", [text] * 3), (2, "Empty", None)], "chapter_id bigint, title string, intr array<string>")
    part = spark.createDataFrame([(1, 1, "Quiet Rollbacks", [text + "\nQuiet Rollbacks | 12"])], "part_id bigint, chapter_id bigint, title string, intr array<string>")
    sub = spark.createDataFrame([(i, 1, [text] * 20) for i in range(20)] + [(50, 1, ["The node ag-\nent drops the snapsh0t", None, ""]), (50, 1, ["The node ag-\nent drops the snapsh0t", None, ""]), (51, None, ["The node\n12 | Chapter 1: Safe Defaults\nagent"])], "subpart_id bigint, part_id bigint, content array<string>")
    chunks = scanned.book_chunks(chapter, part, sub)
    got = {(r.table_name, r.row_id, r.chunk_no): (r.text, list(r.noise)) for r in scanned.repaired(chunks, ["table_name", "row_id", "chunk_no"]).collect()}
    assert got["book_part", 1, 0][1] == ["header"] and got["book_subpart", 50, 0] == ("The node agent drops the snapshot", ["hyphen", "ocr"])
    assert got["book_subpart", 50, 1] == (None, []) and got["book_subpart", 50, 2] == ("", []) and got["book_subpart", 51, 0] == ("The node agent", ["header"])
    assert len(got) == 3 + 1 + 400 + 3 + 1
    assert scanned.repaired(scanned.book_chunks(chapter.limit(0), part.limit(0), sub.limit(0)), ["table_name", "row_id", "chunk_no"]).count() == 0


@pytest.mark.parametrize("name", ["p3_found", "p5_found", "p6_found", "p8_ids"])
def test_queries_on_the_smallest_tables(spark, name):
    assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() >= 0
