"""Noise in text from scanned pages (problem 1).

Word counts and skip-gram vectors are learned from all chunks. A word that is rare beside a frequent word which a
plausible glyph edit makes of it is linked to that neighbour, and corrected to the neighbour that its context is most
like. A word broken by a line end is joined if the joined word, or a word that glyph edits make of it, is known, or if its
parts aren't. Lines that hold a title of the chunk's chapter or part, or nothing but a page number, are furniture. What
remains is reflowed: hard line ends within a paragraph become spaces; listings, lists and headings keep their lines.

Cases: null and empty chunks have no noise and come out as they are; CRLF line ends are kept as LF in the repaired text;
equal chunks of a row that was delivered again are one; a row without a part is held against the titles of all; ties
between neighbours go to the more frequent word, then the lesser. Vocabulary and vectors are broadcast: words below one in
a million of all words (or below LEAST occurrences) aren't in it, so it has at most a million words whatever the corpus.
How often rarer words occur, from LEAST on, is kept in a sketch of fixed size: such a word is known, and is corrected only
to neighbours that are RATIO times as frequent; two words in one cell have the count of the more frequent.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.ml.feature import Word2Vec
from pyspark.sql import Column, DataFrame, functions as F

from granary.llm.lookalike import SUSPECT, one_form
from granary.session import cut

#: A word is in the vocabulary from so many occurrences on, and from this share of all words on.
LEAST, SHARE = 5, 1e-6
#: Words without a neighbour that a worker remembers.
PLAIN = 500_000
#: Cells of the sketch of rarer words: a byte each, so its size doesn't grow with the corpus.
CELLS = 1 << 24
#: A word may be an error of another that is so many times as frequent.
RATIO = 20
#: Size and window of the skip-gram vectors; words of context on either side; by how much the cosine with the context may be less for a correction than for a known word.
SIZE, WINDOW, CONTEXT, MARGIN = 16, 4, 4, 0.2
#: Words that one task learns from, about.
WORDS_PER_TASK = 2_000_000
#: Glyphs that are misread as each other have one form, then pairs that are misread as one glyph.
GLYPHS = str.maketrans("cfi1|b6y@05$9q2", "etlllhhvaossggz")
PAIRS = [("el", "d"), ("rl", "n"), ("rn", "m"), ("ll", "u"), ("vv", "w")]
#: Marks with which a word is broken at a line end.
BREAKS = "-‐‑¬­"
_TOKENS = r"[\p{L}@$|0-9]+(?:['’-][\p{L}@0-9]+)*"
_WORD = re.compile(r"[^\W_@$|]*[^\W\d_][\w@$|]*(?:['’-][^\W\d_][\w@]*)*|[@$|\d]+[^\W\d_][\w@$|]*")
#: A character besides ASCII, Latin letters and usual marks: without one a text is in its one form.
_ODD = re.compile(r"[^\x00-\x7fÀ-ɏ‐-‟•…‹›€™]")
_NO_LETTERS = re.compile(r"[\W\d_]+")
_ROMAN = re.compile(r"^(?=[ivx])(x{0,3})(ix|iv|v?i{0,3})$")
_PAGE = re.compile(r"^\W*(?:(?:page|pg\.?|p\.|seite|página|oldal)\s*)?(?:\d{1,4}|(?P<roman>[ivx]{1,7}))(?:\s*(?:/|of|von|de|sur)\s*\d{1,4})?\W*$", re.I)
_PROMPT = re.compile(r"^\s*(\$|#|>|%)\s+\S")
_CODE = re.compile(r"^\s*(\$ |> |[A-Za-z][\w./-]*:(\s|$)|- [\w./-]+(:|\s*$)|kubectl |docker |[{}\[\]])|^\s{2,}\S|^\t")
#: A heading: a short line of capitalised words, small ones between them, without a final mark.
_HEADING = re.compile(r"^\s*[A-ZÀ-Þ][\w’'-]*(?:\s+(?:[A-ZÀ-Þ][\w’'-]*|a|an|and|as|at|by|for|from|in|its|of|on|or|over|the|to|under|with|without|de|la|und|der|et|y)){1,11}\s*$")
_ITEM = re.compile(r"^\s*([-*•+]|\d+[.)])\s+")


def tokens(column: Column) -> Column:
    """Words of a chunk in lower case; words broken by a line end are joined."""
    return F.regexp_extract_all(F.lower(F.regexp_replace(column, rf"(?<=\p{{L}})[{BREAKS}]\s*\n\s*(?=\p{{Ll}})", "")), F.lit(_TOKENS), F.lit(0))


def glyph_key(word: str) -> str:
    """A word in the form that misread glyphs have in common: two words have one key if plausible glyph edits lead from one to the other."""
    word = word.translate(GLYPHS)
    for pair, one in PAIRS:
        word = word.replace(pair, one)
    return word


def glyph_keys(word: str) -> set[str]:
    """The key read from the left and from the right, which differ where pairs overlap."""
    return {glyph_key(word), glyph_key(word.translate(GLYPHS).replace("lll", "lu"))}


_CHAPTER = {glyph_key(w) for w in ("chapter", "kapitel", "chapitre", "capítulo", "fejezet", "part", "page")}


def title_key(text: str) -> str:
    """Key of a title: its words without numbers and a leading `chapter`."""
    words = [glyph_key(w) for w in re.findall(r"[\w@$|]+", unicodedata.normalize("NFKC", text).lower()) if re.search(r"[^\W\d_]", w)]
    return "".join(words[1:] if len(words) > 1 and words[0] in _CHAPTER else words)


def header_key(line: str) -> str | None:
    """The key of a line that may be a running header or footer."""
    return title_key(line.strip()) or None


#: A key has at least half as many letters as its words, besides those of a leading `chapter`: a line with more letters than this for the longest key can't have one of the keys.
def most_letters(keys: set[str]) -> int:
    return 2 * max(map(len, keys), default=0) + 2 * max(map(len, _CHAPTER))


class Repairer:
    """Finds and repairs the noise of chunks, given the vocabulary and its vectors."""

    def __init__(self, counts: dict[str, int], vectors: dict[str, np.ndarray], rarer: np.ndarray | None = None):
        self.counts, self.vectors, self.rarer = counts, vectors, rarer
        self.alike: dict[str, set[str]] = {}
        #: The neighbours of the vocabulary's words that were asked for, at most as many as it has words.
        self.linked: dict[str, list[str]] = {}
        #: Words without a neighbour; emptied when it is full.
        self.plain: set[str] = set()
        for w, n in counts.items():
            if n >= LEAST:
                for key in glyph_keys(w):
                    self.alike.setdefault(key, set()).add(w)

    def count(self, word: str) -> int:
        """Occurrences of a word, 0 for one with fewer than LEAST."""
        n = self.counts.get(word, 0)
        return n if n or self.rarer is None else int(self.rarer[xxhash.xxh64_intdigest(word, seed=42) % len(self.rarer)])

    def neighbours(self, word: str) -> list[str]:
        """Words at glyph edits from a word that are much more frequent, the most frequent first."""
        if (links := self.linked.get(word)) is not None:
            return links
        need = RATIO * max(1, self.count(word))
        found = {z for key in glyph_keys(word) for z in self.alike.get(key, ())}
        links = sorted((z for z in found if z != word and self.counts[z] >= need), key=lambda z: (-self.counts[z], z))
        if word in self.counts:
            self.linked[word] = links
        return links

    def correct(self, word: str, context: list[str]) -> str | None:
        """The word that a misread one stands for, by its context; None if it isn't misread."""
        low = word.lower()
        if len(low) < 3 or not (links := self.neighbours(low)):
            return None
        around = [self.vectors[c] for c in context if c in self.vectors]
        if not around:
            return links[0] if self.counts[links[0]] >= RATIO * LEAST else None
        mean = np.mean(around, axis=0)
        like = lambda w: float(mean @ self.vectors[w] / (np.linalg.norm(mean) * np.linalg.norm(self.vectors[w]) + 1e-9)) if w in self.vectors else -1.0
        best, z = max(((like(z), z) for z in links), key=lambda s: (s[0], self.counts[s[1]], s[1]))
        # a word of the vocabulary may be right: then its context must not be clearly more like it than like the correction
        return z if low not in self.counts or re.search(r"[@$|0-9]", low) or best + MARGIN >= like(low) else None

    def broken(self, left: str, right: str, mark: str) -> bool:
        """A line end broke a word in two, and not at a hyphen of its own."""
        whole, compound = (left + right).lower(), f"{left}-{right}".lower()
        c = self.count
        if mark == "-":
            if c(compound) > c(whole):
                return False
            if "-" in left and c(left.rpartition("-")[2].lower()) and c(right.lower()):
                return False
        if c(whole) or mark != "-" or self.neighbours(whole):
            return True
        return not (c(left.lower()) and c(right.lower()))

    def repair(self, text: str, titles: list[str]) -> tuple[str, list[str]]:
        """The repaired text and the kinds of noise that were in it."""
        text = re.sub(rf"(?<=\w)­(?=[ \t]*\r?\n)", "¬", text).replace("\r\n", "\n").replace("\r", "\n")
        if _ODD.search(text):
            text = one_form(text)
        keys = {k for t in titles if t and (k := title_key(t))}
        letters = most_letters(keys)
        noise: set[str] = set()
        lines: list[str] = []
        output = False
        furniture: list[bool] = []
        for line in text.split("\n"):
            bare = line.strip()
            kind = None
            if bare:
                page = _PAGE.match(bare)
                if page and not (page["roman"] and not (_ROMAN.match(page["roman"]))):
                    if output and re.fullmatch(r"\d+", line):
                        output = False
                    else:
                        kind = "pageno"
                elif keys and (len(bare) <= letters or len(_NO_LETTERS.sub("", bare)) <= letters) and header_key(bare) in keys:
                    kind = "header"
                else:
                    output = bool(_PROMPT.match(line))
            if kind:
                noise.add(kind)
            lines.append("" if kind else line)
            furniture.append(bool(kind))
        # furniture goes with the blank lines that set it off within a paragraph
        kept: list[str] = []
        i = 0
        while i < len(lines):
            if furniture[i]:
                j = i
                while j < len(lines) and (furniture[j] or not lines[j].strip()):
                    j += 1
                while kept and not kept[-1].strip():
                    kept.pop()
                before, after = (kept[-1] if kept else ""), (lines[j] if j < len(lines) else "")
                within = bool(before) and bool(after) and not re.search(r"[.!?:][\"'”’)]*\s*$", before)
                if before and after and not within:
                    kept.append("")
                i = j
                continue
            kept.append(lines[i])
            i += 1
        # words broken by a line end
        i = 0
        while i + 1 < len(kept):
            a = kept[i].rstrip()[-1:] in tuple(BREAKS) and re.search(rf"([^\W_@$|]*[\w@$|'’-]*[\w@$|])([{BREAKS}])[ \t]*$", kept[i])
            b = re.match(r"\s*([^\W\d_][\w@$|]*|[@$|\d]+[^\W\d_][\w@$|]*)", kept[i + 1])
            if a and b and (b[1][0].islower() or not b[1][0].isalpha()) and re.search(r"[^\W\d_]", a[1]):
                if self.broken(a[1].rpartition("-")[2] if a[2] != "-" else a[1], b[1], a[2]):
                    noise.add("hyphen")
                    rest = kept[i + 1].lstrip()
                    word = re.match(r"\S+", rest)[0]
                    kept[i] = kept[i][: a.start(2)] + word
                    tail = rest[len(word) :].lstrip()
                    if tail:
                        kept[i + 1] = tail
                    else:
                        del kept[i + 1]
                elif a[2] == "-":
                    kept[i] = kept[i].rstrip() + "\x00"  # its own hyphen: no space after it when lines are joined
            i += 1
        flowed = self._reflow(kept)
        return self._read(flowed, noise), sorted(noise)

    @staticmethod
    def _reflow(lines: list[str]) -> str:
        out: list[str] = []
        open_ = listing = False
        for n, line in enumerate(lines):
            if not line.strip():
                out.append("")
                open_ = listing = False
                continue
            code = bool(_CODE.match(line)) or (listing and bool(re.fullmatch(r"\s*[\d./ -]+\s*", line)))
            item = bool(_ITEM.match(line)) or bool(_HEADING.match(line) and (n == 0 or not lines[n - 1].strip() or lines[n - 1].rstrip()[-1:] in ".!?:"))
            if open_ and not code and not item and not line.lstrip().startswith(("#", "|", "```")):
                joined = out[-1]
                out[-1] = joined[:-1] + line.strip() if joined.endswith("\x00") else joined.rstrip() + " " + line.strip()
            else:
                out.append(line.rstrip())
            listing = code
            open_ = not code and not _HEADING.match(line) and not line.lstrip().startswith(("#", "|", "```"))
        return "\n".join(out).replace("\x00", "").strip("\n")

    def _read(self, text: str, noise: set[str]) -> str:
        if self.plain.issuperset(_WORD.findall(text.lower())):
            return text
        found = list(_WORD.finditer(text))
        words = [m.group().lower() for m in found]
        out, at = [], 0
        for n, m in enumerate(found):
            if words[n] in self.plain:
                continue
            if len(words[n]) < 3 or not self.neighbours(words[n]):
                if len(self.plain) >= PLAIN:
                    self.plain.clear()
                self.plain.add(words[n])
                continue
            right = self.correct(m.group(), words[max(0, n - CONTEXT) : n] + words[n + 1 : n + 1 + CONTEXT])
            if right:
                noise.add("ocr")
                out += [text[at : m.start()], right.capitalize() if m.group()[0].isupper() else right]
                at = m.end()
        return "".join(out) + text[at:] if out else text


def learn(chunks: DataFrame, text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """(word, n, vector; cell, n): the vocabulary of all chunks with skip-gram vectors (Spark's Word2Vec, over all of them), and the sketch of the words that are too rare for it."""
    said = cut(chunks.select(tokens(F.col(text_column)).alias("words")).where("size(words) > 0"), "p1-words")
    counts = cut(said.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")), "p1-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(LEAST, int(np.ceil(total * SHARE)))
    vocabulary = counts.where(F.col("n") >= least)
    rarer = counts.where(F.col("n").between(LEAST, least - 1)).groupBy(F.pmod(F.xxhash64("word"), F.lit(CELLS)).alias("cell")).agg(F.least(F.max("n"), F.lit(255)).alias("n"))
    if vocabulary.isEmpty():
        return counts.sparkSession.createDataFrame([], "word string, n bigint, vector array<float>"), rarer
    parts = max(1, round(total / WORDS_PER_TASK))
    model = Word2Vec(vectorSize=SIZE, windowSize=WINDOW, minCount=least, maxIter=1, numPartitions=parts, seed=1, inputCol="words", outputCol="v").fit(said)
    from pyspark.ml.functions import vector_to_array

    return vocabulary.join(model.getVectors().select("word", vector_to_array("vector", "float32").alias("vector")), "word", "left"), rarer


def repaired(chunks: DataFrame, keys: list[str], text_column: str = "text", titles_column: str = "titles") -> DataFrame:
    """The keys, text and noise (array of kinds) for each chunk. titles: array of the titles that may run over its pages."""
    spark = chunks.sparkSession
    learned, rarer = (t.toArrow() for t in learn(chunks.select(F.col(text_column).alias("text"))))
    sketch = None
    if rarer.num_rows:
        sketch = np.zeros(CELLS, dtype=np.uint8)
        sketch[rarer["cell"].to_numpy()] = rarer["n"].to_numpy()
    words, n, vec = learned["word"].to_pylist(), learned["n"].to_pylist(), learned["vector"].to_pylist()
    shared = spark.sparkContext.broadcast((dict(zip(words, n)), {w: np.array(v, dtype=np.float32) for w, v in zip(words, vec) if v}, sketch))
    types = dict(chunks.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fixer = Repairer(*shared.value)
        for pdf in batches:
            got = [fixer.repair(t, list(ts) if ts is not None else []) if t else (t, []) for t, ts in zip(pdf.pop("__text"), pdf.pop("__titles"))]
            pdf["text"], pdf["noise"] = [g[0] for g in got], [g[1] for g in got]
            yield pdf

    picked = chunks.select(*keys, F.col(text_column).alias("__text"), F.col(titles_column).alias("__titles"))
    return picked.mapInPandas(run, ", ".join([*(f"`{k}` {types[k]}" for k in keys), "text string, noise array<string>"]))


def book_chunks(chapter: DataFrame, part: DataFrame, subpart: DataFrame) -> DataFrame:
    """table_name, row_id, chunk_no, text, titles of all chunks; rows that were delivered again once."""
    own = chapter.select("chapter_id", F.col("title").alias("chapter_title")).dropDuplicates(["chapter_id"])
    parts = part.select("part_id", F.col("title").alias("part_title"), "chapter_id").dropDuplicates(["part_id"]).join(own, "chapter_id", "left")
    c = chapter.select(F.lit("book_chapter").alias("table_name"), F.col("chapter_id").alias("row_id"), F.posexplode("intr").alias("chunk_no", "text"), F.array("title").alias("titles"))
    p = part.join(own, "chapter_id", "left").select(F.lit("book_part").alias("table_name"), F.col("part_id").alias("row_id"), F.posexplode("intr").alias("chunk_no", "text"), F.array("title", "chapter_title").alias("titles"))
    s = subpart.join(parts.drop("chapter_id"), "part_id", "left").select(F.lit("book_subpart").alias("table_name"), F.col("subpart_id").alias("row_id"), F.posexplode("content").alias("chunk_no", "text"), F.array("part_title", "chapter_title").alias("titles"))
    every = c.unionByName(p).unionByName(s).withColumn("titles", F.array_compact("titles")).dropDuplicates(["table_name", "row_id", "chunk_no", "text"])
    # chunks without a title: their lines against all titles, by a join on the key
    alone = every.where((F.size("titles") == 0) & F.col("text").isNotNull())
    lines = with_key(alone.select("table_name", "row_id", "chunk_no", F.explode(F.split("text", r"\r\n|\n|\r")).alias("line")), "line")
    titles = with_key(chapter.select("title").unionByName(part.select("title")).where("title IS NOT NULL").distinct(), "title").dropDuplicates(["key"])
    matched = lines.join(titles, "key").groupBy("table_name", "row_id", "chunk_no").agg(F.array_sort(F.collect_set("title")).alias("others"))
    return every.join(matched, ["table_name", "row_id", "chunk_no"], "left").withColumn("titles", F.coalesce("others", "titles")).drop("others")


def with_key(df: DataFrame, column: str) -> DataFrame:
    """The rows whose text in the column has a title's key of two letters or more, with it, in Arrow batches."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["key"] = [header_key(t) for t in pdf[column]]
            yield pdf[pdf["key"].str.len() > 1]

    return df.mapInPandas(run, ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + ", key string")
