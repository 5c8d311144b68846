"""Splitting of oversized items at natural boundaries by agglomerative merging (problem 5).

A text above the limit is cut into atoms: paragraphs, lines and sentences, and words or runs of characters where one of
these is itself too long. Every boundary between neighbouring atoms has a strength. A heap holds the adjacent pairs; the
weakest boundary is merged first, among equals the pair of least combined size, while the combined size plus the overlap
fits. Each piece but the first begins with the last characters of the piece before it: `overlap` of them, or a few less
where a word begins nearby.

Cases: null and empty texts and texts up to the limit give no pieces from `split_long` and themselves from `pieces_of`;
a text without any boundary is cut by length, never before a combining mark, a joiner or between CR and LF; the pieces
without their overlaps give the text again. Equal rows of a table give equal pieces, once.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

LIMIT, OVERLAP = 2000, 200
#: An overlap may be shorter by so many characters to begin at a word.
SLACK = 40
#: Strengths of boundaries, weakest first: within a run of characters, between words, clauses, sentences, lines, paragraphs, before a heading.
HARD, WORD, CLAUSE, SENTENCE, LINE, PARAGRAPH, HEADING = range(7)
_BREAK = re.compile(r"(?:\r?\n[ \t]*){2,}|\r?\n|(?<=[.!?。！？…])[\"'”’»)\]]*[ \t]+|(?<=[。！？])")
_CLAUSE = re.compile(r"(?<=[,;:])[ \t]+|[ \t]+")


def _strength(sep: str, after: str) -> int:
    lines = sep.count("\n")
    if lines and after.lstrip().startswith("#"):
        return HEADING
    return PARAGRAPH if lines > 1 else LINE if lines else SENTENCE


def _hard(text: str, a: int, b: int, size: int) -> list[tuple[int, int]]:
    """Runs of about `size` characters of text[a:b], as cuts with their strength."""
    cuts, at = [], a + size
    while at < b:
        while at > a + 1 and (unicodedata.combining(text[at]) or text[at] in "‍️\n" or text[at - 1] == "‍") and at - a > size // 2:
            at -= 1
        cuts.append((at, HARD))
        a, at = at, at + size
    return cuts


def atoms(text: str, most: int) -> list[tuple[int, int]]:
    """Cuts of the text in order: position and strength."""
    cuts = [(m.end(), _strength(m.group(), text[m.end() : m.end() + 8])) for m in _BREAK.finditer(text) if 0 < m.end() < len(text)]
    fine: list[tuple[int, int]] = []
    for (a, _), (b, s) in zip([(0, 0), *cuts], [*cuts, (len(text), 0)]):
        if b - a > most:
            words = [(a + m.end(), CLAUSE if text[a + m.start() - 1] in ",;:" else WORD) for m in _CLAUSE.finditer(text[a:b]) if 0 < a + m.end() < b]
            for (x, _), (y, t) in zip([(a, 0), *words], [*words, (b, -1)]):
                if y - x > most:
                    fine += _hard(text, x, y, max(1, most // 4))
                if t >= 0:
                    fine.append((y, t))
        if b < len(text):
            fine.append((b, s))
    return fine


def segments(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """Disjoint ranges that cover the text, each of at most limit - overlap characters."""
    most = limit - overlap
    cuts = atoms(text, most)
    bounds = [0, *(p for p, _ in cuts), len(text)]
    n = len(bounds) - 1
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    start, end, alive = bounds[:-1], bounds[1:], [True] * n
    heap = [(s, bounds[i + 2] - bounds[i], i, bounds[i + 1], bounds[i + 2]) for i, (_, s) in enumerate(cuts)]
    strength = [s for _, s in cuts]
    heapq.heapify(heap)
    while heap:
        s, size, i, mid, stop = heapq.heappop(heap)
        j = right[i] if alive[i] else -1
        if j < 0 or end[i] != mid or end[j] != stop or end[j] - start[i] != size or size > most:
            continue  # the pair has changed since, or it never fits again
        end[i], alive[j], right[i] = end[j], False, right[j]
        strength[i] = strength[j] if j < n - 1 else -1
        if right[i] >= 0:
            left[right[i]] = i
            heapq.heappush(heap, (strength[i], end[right[i]] - start[i], i, end[i], end[right[i]]))
        if left[i] >= 0:
            k = left[i]
            heapq.heappush(heap, (strength[k], end[i] - start[k], k, end[k], end[i]))
    return [(start[i], end[i]) for i in range(n) if alive[i]]


def pieces_of(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, str]]:
    """(start, shared, piece): shared is the number of characters that the piece has in common with the one before."""
    if len(text) <= limit:
        return [(0, 0, text)]
    out, before = [], 0
    for a, b in segments(text, limit, overlap):
        begin = max(before + 1 if out else 0, a - overlap) if a else 0
        if a and 0 < begin < a and not text[begin - 1].isspace():
            word = re.compile(r"\s\S").search(text, begin, min(a, begin + SLACK))
            if word:
                begin = word.start() + 1
        out.append((begin, a - begin, text[begin:b]))
        before = begin
    return out


def split_long(df: DataFrame, keys: list[str], text_column: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """The keys, piece_no, start, shared, piece for each text above the limit. Only these texts leave the JVM; nothing is shuffled."""
    types = dict(df.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "piece_no int, start int, shared int, piece string"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(*row[:-1], i, *piece) for row in pdf.itertuples(index=False, name=None) for i, piece in enumerate(pieces_of(row[-1], limit, overlap))]
            yield pd.DataFrame(rows, columns=[*keys, "piece_no", "start", "shared", "piece"])

    long = df.where(F.char_length(F.col(f"`{text_column}`")) > limit)
    return long.select(*(F.col(f"`{k}`") for k in keys), F.col(f"`{text_column}`").alias("__text")).mapInPandas(run, schema)
