"""One form for text that looks the same (problem 7).

Full-width forms become ASCII, other spaces become the ordinary one, invisible format characters go, combining marks are
composed. In each token the resolved script sets of its letters are intersected; an empty intersection shows a mixed
token, and the spelling in the one script that has look-alikes for all letters of the others is taken. A token wholly of
another script is replaced only if all its letters have Latin look-alikes, its Latin spelling is a word of the corpus that
is many times as frequent as the token itself, and its text has no other word of that script that can't be spelt in Latin
letters: so genuine foreign words stay, which stand among their like and recur as they are.

Cases: null stays null and empty stays empty; joiners stay in scripts and emoji that need them; a mixed token without a
consistent spelling is left as it is. Rows that can't have a fault never leave the JVM.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F

#: Letters of other scripts that look like Latin letters.
LATIN_LOOKALIKES = {
    "Cyrillic": dict(zip("аеорсухѕіјһԁԛԝѵӏкүАВЕКМНОРСТХУЅІЈԚԜѴӀҮ", "aeopcyxsijhdqwvlkyABEKMHOPCTXYSIJQWVIY")),
    "Greek": dict(zip("οανρυικτχγηϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹ", "oavpuiktxyncjABEZHIKMNOPTYXC")),
    "Armenian": dict(zip("օոսհցզյ", "onuhgqj")),
}
#: Scripts that are told apart.
SCRIPTS = ("Latin", "Cyrillic", "Greek", "Armenian", "Han", "Hiragana", "Katakana", "Hangul", "Hebrew", "Arabic", "Devanagari", "Thai", "Georgian", "Cherokee")
#: Scripts that are written together resolve to a common set.
TOGETHER = {"Han": {"Han", "Jpan", "Kore"}, "Hiragana": {"Hiragana", "Jpan"}, "Katakana": {"Katakana", "Jpan"}, "Hangul": {"Hangul", "Kore"}}
_SCRIPT = {s: regex.compile(rf"\p{{Script={s}}}") for s in SCRIPTS}
_TOKEN = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_WIDE = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)}
_FORMAT = regex.compile(r"\p{Cf}")
_SPACE = regex.compile(r"[\p{Zs}--[ ]]", regex.V1)
_MARK = regex.compile(r"\p{M}")
_NEEDS_JOINER = regex.compile(r"[\p{Script=Arabic}\p{Script=Devanagari}\p{Script=Bengali}\p{Script=Tamil}\p{Script=Malayalam}\p{So}\p{Sk}️]")
#: A text without any of these characters has no fault: neither ASCII nor plain Latin letters and usual marks.
SUSPECT = r"[！-～\p{M}\p{Cf}]|[\p{Zs}&&[^ ]]|[\p{L}&&[^\p{IsLatin}]]"
#: A Latin word replaces a look-alike token that it is so many times as frequent as, counted by texts.
RATIO = 5


@lru_cache(maxsize=65536)
def scripts(ch: str) -> frozenset[str] | None:
    """The resolved script set of a character; None for one that all scripts share."""
    for name, pattern in _SCRIPT.items():
        if pattern.match(ch):
            return frozenset(TOGETHER.get(name, {name}))
    return frozenset({"other"}) if ch.isalpha() and ord(ch) > 127 and not unicodedata.name(ch, "").startswith(("MICRO", "MASCULINE", "FEMININE", "MODIFIER")) else None


def resolved(token: str) -> frozenset[str] | None:
    """Intersection of the script sets of a token's characters; None if none of them has a script, empty if it is mixed."""
    out: frozenset[str] | None = None
    for ch in token:
        s = scripts(ch)
        if s is not None:
            out = s if out is None else out & s
    return out


@lru_cache(maxsize=65536)
def one_script(token: str) -> str:
    """The spelling of a mixed token in the script that fits all its letters; the token itself if there is none or several scripts disagree."""
    sets = {s for ch in token if (s := scripts(ch)) is not None}
    names = {n for s in sets for n in s}
    fits = {}
    if "Latin" in names:
        latin = [ch if scripts(ch) in (None, frozenset({"Latin"})) else next((t[ch] for t in LATIN_LOOKALIKES.values() if ch in t), None) for ch in token]
        if None not in latin:
            fits["Latin"] = "".join(latin)
        for other, table in LATIN_LOOKALIKES.items():
            if other in names:
                back = {v: k for k, v in reversed(table.items())}
                spelt = [ch if scripts(ch) in (None, frozenset({other})) else back.get(ch) for ch in token]
                if None not in spelt:
                    fits[other] = "".join(spelt)
    return fits.get("Latin") or (next(iter(fits.values())) if len(fits) == 1 else token)


def whole_script(token: str) -> str | None:
    """The Latin spelling of a token wholly of another script, if all its letters have look-alikes."""
    for table in LATIN_LOOKALIKES.values():
        if token[0] in table and all(ch in table for ch in token):
            return "".join(table[ch] for ch in token)
    return None


def disguised(text: str) -> list[tuple[str, str]]:
    """The tokens wholly of another script with their Latin spellings; none of a script of which the text has a word that can't be spelt so."""
    tokens = {w for w in _TOKEN.findall(_FORMAT.sub("", text)) if not w.isascii()}
    genuine = {s for w in tokens if not whole_script(w) for s in LATIN_LOOKALIKES if resolved(w) == frozenset({s})}
    return [(w, spelt) for w in sorted(tokens) if (spelt := whole_script(w)) and not genuine & (resolved(w) or frozenset())]


def faults(text: str) -> list[str]:
    """The kinds of fault in a text: wide, mark, format, space, mixed."""
    out = []
    if any(0xFF01 <= ord(c) <= 0xFF5E for c in text):
        out.append("wide")
    for name, pattern in (("mark", _MARK), ("format", _FORMAT), ("space", _SPACE)):
        if pattern.search(text):
            out.append(name)
    bare = _FORMAT.sub("", text).translate(_WIDE)
    if any(resolved(t) == frozenset() and any(scripts(c) == frozenset({"Latin"}) for c in t) for t in _TOKEN.findall(bare)):
        out.append("mixed")
    return out


def one_form(text: str, latin: dict[str, str] | None = None) -> str:
    """The text in its one form. latin: tokens wholly of another script, with the Latin words that replace them."""
    def joiner(m: regex.Match) -> str:
        near = text[max(0, m.start() - 1) : m.start()] + text[m.end() : m.end() + 1]
        return m.group() if m.group() in "‌‍" and _NEEDS_JOINER.search(near) else ""

    text = _FORMAT.sub(joiner, text)
    text = _SPACE.sub(" ", text).translate(_WIDE)
    text = unicodedata.normalize("NFC", text)
    return _TOKEN.sub(lambda m: (latin or {}).get(t, t) if (t := m.group()).isascii() is False and resolved(t) != frozenset() else one_script(t) if not t.isascii() else t, text)


def suspect(column: Column) -> Column:
    return column.rlike(SUSPECT)


def _map(df: DataFrame, keys: list[str], text_column: str, fn, fields: str) -> DataFrame:
    types = dict(df.dtypes)
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(*row[:-1], *out) for row in pdf.itertuples(index=False, name=None) for out in fn(row[-1])], columns=[*keys, *names])

    return df.select(*(F.col(f"`{k}`") for k in keys), F.col(f"`{text_column}`").alias("__text")).mapInPandas(run, ", ".join([*(f"`{k}` {types[k]}" for k in keys), fields]))


def faulty(df: DataFrame, keys: list[str], text_column: str) -> DataFrame:
    """The keys and fault: one row for each text and kind of fault in it."""
    return _map(df.where(suspect(F.col(f"`{text_column}`"))), keys, text_column, lambda t: [(f,) for f in faults(t)], "fault string")


def normalised(df: DataFrame, keys: list[str], text_column: str) -> DataFrame:
    """The keys and text in its one form, for all rows. The keys must be unique."""
    text = F.col(f"`{text_column}`")
    base = df.select(*(F.col(f"`{k}`") for k in keys), text.alias("__text"))
    odd = base.where(suspect(F.col("__text")))
    # tokens wholly of another script, each with its Latin spelling, where that is a far more frequent word of the corpus
    tokens = _map(odd, keys, "__text", disguised, "token string, spelling string")
    words = base.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("__text"), F.lit("[a-z]+"), F.lit(0)))).alias("word"))
    wanted = words.join(tokens.select(F.lower("spelling").alias("word")).distinct(), "word", "left_semi").groupBy("word").agg(F.count("*").alias("latin_n"))
    own = tokens.groupBy("token", F.lower("spelling").alias("word")).agg(F.count("*").alias("own_n"))
    taken = own.join(wanted, "word").where(F.col("latin_n") >= RATIO * F.col("own_n")).select("token")
    accepted = tokens.join(taken, "token", "left_semi").groupBy(*keys).agg(F.map_from_entries(F.collect_set(F.struct("token", "spelling"))).alias("latin"))
    fixed = odd.join(accepted, keys, "left")
    types = dict(base.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["text"] = [one_form(t, dict(m) if m else None) for t, m in zip(pdf.pop("__text"), pdf.pop("latin"))]
            yield pdf

    done = fixed.select(*keys, "__text", "latin").mapInPandas(run, ", ".join([*(f"`{k}` {types[k]}" for k in keys), "text string"]))
    plain = base.where(F.col("__text").isNull() | ~suspect(F.col("__text"))).withColumnRenamed("__text", "text")
    return plain.unionByName(done)
