"""Row functions without Spark: exact round trips and hand-made cases."""

import random
import re
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from granary.llm import lookalike, neighbours, overlap, packing, pairs, scanned, splitting, tokenize

VOCABULARY = f"{tokenize.TOKENIZERS}/{tokenize.VOCABULARY}"


@pytest.fixture(scope="module")
def bpe():
    return tokenize.ByteBpe(VOCABULARY)


@pytest.fixture(scope="module")
def reference():
    import base64

    import tiktoken

    with open(VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=tokenize.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(bpe, texts):
    flat, at = bpe.encode(texts)
    return [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


def test_bpe_equals_the_reference_encoder(bpe, reference):
    texts = ["", None, "Hello world", "a" * 4000, "ab" * 999, " " * 77, "<|endoftext|>", "日本語のログ 🚀 é", "x\r\n\ty", "'s're it's"]
    assert ids(bpe, texts) == [reference.encode_ordinary(t) if t else [] for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_bpe_on_any_text(bpe, reference, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert ids(bpe, texts) == [reference.encode_ordinary(t) if t else [] for t in texts]


def test_bpe_cache_is_bounded(bpe, monkeypatch):
    monkeypatch.setattr(tokenize, "CACHE_WORDS", 10)
    assert ids(bpe, ["one two three four five six seven eight nine ten eleven twelve"]) == ids(bpe, ["one two three four five six seven eight nine ten eleven twelve"])


def test_chunks_cover_everything():
    texts = ["x" * 5, None, "y" * 30, "z"]
    assert list(tokenize.chunks(texts, 10)) == [(0, 2), (2, 3), (3, 4)]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab .,\n\ŕé#", min_size=0, max_size=900))
def test_pieces_give_the_text_again(text):
    pieces = splitting.pieces_of(text, 100, 20)
    assert "".join(p[s:] for _, s, p in pieces) == text
    assert all(len(p) <= 100 for _, _, p in pieces)
    assert all(text[a : a + len(p)] == p for a, _, p in pieces)


def test_pieces_share_the_overlap_and_cut_at_sentences():
    text = " ".join(f"Sentence number {i} says something of its own." for i in range(120))
    pieces = splitting.pieces_of(text)
    assert len(pieces) > 2 and all(160 <= s <= 200 for _, s, _ in pieces[1:])
    assert all(p.rstrip().endswith(".") for _, _, p in pieces)
    assert splitting.pieces_of("x" * 2000) == [(0, 0, "x" * 2000)]
    assert [len(p) for _, _, p in splitting.pieces_of("x" * 5000)][0] <= 2000


def test_weakest_boundaries_are_merged_first():
    text = "a b. c d.\n\ne f. g h."
    assert splitting.segments(text, 12, 0) == [(0, 11), (11, 20)]


def test_lookalikes_come_to_one_form():
    assert lookalike.one_form("ｂａｔｃｈ te​st a b café") == "batch test a b café"
    assert lookalike.one_form("сlаѕѕ Wіwіhі cοntainer") == "class Wiwihi container"
    for kept in ("привет", "λόγος", "naïve façade", "日本語のログ", "“quote” – dash", "👨‍👩‍👧"):
        assert lookalike.one_form(kept) == unicodedata.normalize("NFC", kept)
    assert lookalike.one_form("ѕсоре", {"ѕсоре": "scope"}) == "scope"


def test_faults_are_named():
    assert lookalike.faults("ａ") == ["wide"]
    assert lookalike.faults("café") == ["mark"]
    assert lookalike.faults("a­b c") == ["format", "space"]
    assert lookalike.faults("аlpha") == ["mixed"]
    assert lookalike.faults("тест «é» – “x”\t\n") == []


def test_mix_takes_the_script_that_fits_all_letters():
    assert lookalike.one_form("a\u0436") == "\u0430\u0436"  # no Latin letter looks like the second
    assert lookalike.one_form("b\u0436") == "b\u0436"  # neither script fits


def test_bm25_prefers_shared_rare_tokens():
    docs = [np.array([1, 2, 3]), np.array([1, 2, 9]), np.array([7, 8]), np.array([3, 4]), np.array([5])]
    scores = packing.Bm25(docs).scores(docs[0])
    assert scores[1] > scores[3] > scores[2] == 0


def test_containers_hold_and_lose_nothing():
    rng = random.Random(1)
    docs = [np.array([rng.randrange(50) for _ in range(rng.choice([0, 3, 40, 77, 100]))]) for _ in range(200)]
    where = packing.fill(docs, 100)
    used = np.bincount(where, weights=[d.size for d in docs])
    assert used.max() <= 100 and used.sum() == sum(d.size for d in docs)
    assert len(used) <= np.ceil(used.sum() / 100) * 1.15


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 60), min_size=1, max_size=45), st.sets(st.integers(0, 60), max_size=6), st.sets(st.integers(0, 60), max_size=6), st.booleans())
def test_similar_sets_share_a_segment(base, plus, minus, swap):
    """At the first cut and, within the equal segments, at the second; the folded codes are within the radius."""
    a, b = base, (base | plus) - minus
    if not b or len(a & b) / len(a | b) < 0.8:
        return
    if swap:
        a, b = b, a
    met, codes = [], []
    for words, train in ((a, True), (b, False)):
        hashes, sizes = overlap.mix(np.array(sorted(words), dtype=np.uint64), 99), np.array([len(words)])
        row, end = overlap.side_intervals(sizes, train)
        flat, n, parts = overlap._picked(hashes, sizes, row), sizes[row], overlap.radius(end) + 1
        at, key = overlap.segment_keys(flat, n, parts, end.astype(np.uint64) << np.uint64(32), 0)
        again, second = overlap.segment_keys(overlap._picked(hashes, sizes, np.zeros(at.size, int)), np.full(at.size, len(words)), parts[at], key.view(np.uint64), 1)
        met.append((set(key), set(second)))
        codes.append(int(overlap.folded(hashes, sizes)[0]) & (1 << 64) - 1)
    assert met[0][0] & met[1][0] and met[0][1] & met[1][1]
    assert (codes[0] ^ codes[1]).bit_count() <= len(a ^ b)


def test_chi2_quantile():
    assert neighbours.chi2_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    assert neighbours.chi2_quantile(0.5, 2) == pytest.approx(1.386, abs=1e-3)


@pytest.mark.parametrize(
    ("response", "command", "expected"),
    [
        (None, "kubectl get x", "empty"), (" ", "kubectl get x", "empty"), ("N/A", "kubectl get x", "empty"), ("1. use it", "(no answer)", "empty"),
        ("How do I list pods in web?", "kubectl get x", "copy"), ("Question:  how do i LIST pods in web", "kubectl get x", "copy"), ("1. ok, do it", "How do I list pods in web", "copy"),
    ],
)
def test_plain_defects(response, command, expected):
    assert pairs.read_pair("How do I list pods in web?", response, command, "get", "List pods")["kind"] == expected


@pytest.mark.parametrize(
    ("response", "command", "broken"),
    [
        ("1. use get.\n2. set the namespace to web.", "kubectl get pods -n web", False),
        ("1. use get.\n2. set the namespace to", "kubectl get pods -n web", True),
        ("1. use get.\n2.", "kubectl get pods -n web", True),
        ("1. use get.\n2. set the name", "kubectl get pods -n web", True),
        ("1. use get (see also the secret", "kubectl get pods -n web", True),
        ("1. use get by typing `kubectl get", "kubectl get pods -n web", True),
        ("use get", "kubectl get pods \\", True),
        ("use get", "kubectl patch x -p '{\"a\"", True),
        ("use get", "kubectl get pod kilo -n stag", True),
        ("schränke die Auswahl ein", "kubectl get pods -n web", False),
    ],
)
def test_broken_off(response, command, broken):
    row = pairs.read_pair("How do I list kilo pods in staging or web?", response, command, "get", None)
    assert row.get("kind") is None and row["broken"] is broken


def test_languages():
    assert pairs.language("use the get subcommand to reach the cluster") == "en"
    assert pairs.language("setze den Namensraum auf prod und nenne danach den Namen") == "de"
    assert pairs.language("Melyik parancs kell a térben, miután") == "hu"
    assert pairs.language("Blah blah") is None


def repairer():
    return scanned.Repairer({w: 1000 for w in "the configured storage class read-only read only mount of a node agent workload each volume status memory runs short".split()}, {})


def test_scanned_noise_is_found_and_repaired():
    text = "The configu-\nred st@rage class.\n\n288 | Chapter 1: Safe Defaults\n\nEach node agent\nruns short. mcmory of the voliime.\n- 12 -"
    out, noise = repairer().repair(text.replace("st@rage", "st0rage"), ["Safe Defaults"])
    assert noise == ["header", "hyphen", "ocr", "pageno"]
    assert out == "The configured storage class.\n\nEach node agent runs short. memory of the volume."


def test_scanned_text_that_is_no_noise():
    text = "a read-\nonly mount\n$ kubectl get x -o jsonpath='{.a}'\n11\n- item one\n- item two\nkey: value\n  sub: 12\n\nSafe Habits for Teams\nThe node"
    out, noise = repairer().repair(text, ["Safe Defaults"])
    assert noise == [] and "read-only mount" in out and "\n11\n- item one\n- item two\nkey: value\n  sub: 12\n" in out
    assert repairer().repair("привет мир", []) == ("привет мир", [])


@pytest.mark.parametrize("scale", [1, 100, 10_000])
def test_scanned_misreadings_are_found_at_any_size(scale):
    fixer = scanned.Repairer({w: n * scale for w, n in {"for": 5000, "tor": 35, "replica": 900, "rcplica": 11, "waits": 800, "the": 9000}.items()}, {})
    assert fixer.repair("the rcplica waits tor the", []) == ("the replica waits for the", ["ocr"])


def test_scanned_header_of_any_length():
    title = " ".join(["Very Long Titles of the Node Agents and their Storage"] * 5)
    assert repairer().repair(f"the node\n{title} | 288\nruns", [title])[1] == ["header"]
    assert repairer().repair("the node\n" + "runs short of memory " * 40, ["Safe Defaults"])[1] == []


def test_scanned_words_below_the_vocabulary_are_known():
    """A word of the sketch needs a neighbour that is so many times as frequent as itself; an unknown one doesn't."""
    sketch = np.zeros(1 << 16, dtype=np.uint8)
    sketch[scanned.xxhash.xxh64_intdigest("rcplica", seed=42) % sketch.size] = 7
    counts = {"replica": 120, "the": 9000}
    assert scanned.Repairer(counts, {}, sketch).repair("the rcplica", []) == ("the rcplica", [])
    assert scanned.Repairer(counts, {}).repair("the rcplica", []) == ("the replica", ["ocr"])
    assert scanned.Repairer({**counts, "replica": 140}, {}, sketch).repair("the rcplica", [])[1] == ["ocr"]


def test_scanned_break_across_furniture():
    out, noise = repairer().repair("the work-\n\nxiv\n\nload of a node", [])
    assert out == "the workload of a node" and noise == ["hyphen", "pageno"]


def test_long_text_in_linear_time():
    long = "word " * 200_000
    assert repairer().repair(long, ["T"])[1] == []
    assert re.sub(r"\s+", " ", splitting.pieces_of(long)[0][2])[:5] == "word "
