"""Template residue, filler, error pages and script notices in place of questions (problem 6).

The lines and sentences of all texts are normalised (lower case, digits and ids as 0; in their masked form also words
that stand in next to no record as *) and counted by host, here the source that delivered the record. Two things are read
from these counts:

- A line that stands in a share of its host's different records is recurrent boilerplate and is subtracted, unless it is
  evidence; if nothing else is left, the whole record counts as its residual.
- A masked line is residue itself if it recurs under different subjects and shares no word with them. Real requests name what
  they are about; how seldom they don't is known from the host's records, and a line is taken if its recurrence without
  a shared word would be chance with a probability below CHANCE, over all lines of the host. So it needs more sights in
  a larger corpus, and no list.

A record is excluded if its residual has a line of residue, or if its residual or its whole text has evidence of a
placeholder, of template text, of filler, of an error page or of a notice that scripts, cookies or a browser check are
required; this decides what is too rare to recur. Words about such things inside a real request are no evidence, but an
unfilled placeholder is one anywhere. A request in no known form beside a line of evidence is excluded, however often that
line recurs.

Cases: null and blank texts are no residue and stay; a null source is a host of its own; repeated records count once and
are judged alike; without subject columns no line is learned; an empty table gives no rows. Texts aren't shuffled for the
counts, only hashes of their lines.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from operator import or_

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from granary.session import cut, spread

#: A word stays in a normalised line if it stands in this share of the records: so there are at most as many such words as the mean number of words of a record divided by it.
KNOWN_SHARE = 1e-4
#: Probability that a line is taken for residue by chance, over all lines of a host; share of its subjects that it must not name.
CHANCE, UNNAMED = 0.01, 0.9
#: A line is boilerplate if it stands in so many different records of its host, and in this share of them.
RECURRENT, RECURRENT_SHARE = 3, 0.01
#: The share of filler words from which a text is filler.
FILLER_SHARE = 0.5

#: How a request begins, in the languages of the corpus.
REQUEST = (
    r"(^|[,:;.!?\-–—]\s*|\b(hi|hello|hey|please|and|so|quick one)\s+)(¿\s*)?"
    r"(how (do|can|would|should|could|to|does|is|are|did)\b|what (is|are|should|does|do|was|happens|would|command)\b|which \w+|who |when (do|does|should|is)|where (do|does|is|can)|is there|are there|could (you|i|one)\b|can (you|i|one)\b|would you|"
    r"i (need|want|have|would like|wish) to|we (have|need|want|would like) to|help me|does \w+|do (i|we|you)\b|why (does|do|is|are|did)\b|show me|tell me|explain |"
    r"welche[rns]? |wie (\w+ )?(ich|man|kann|wir)|wie \w+ |warum |womit |was |kann ich|"
    r"quel(le)?s? |comment |pourquoi |est-ce |peut-on |puis-je |"
    r"qué |cómo |cuál|por qué|puedo |"
    r"melyik |hogyan |miért |hogy |mivel |lehet)"
)
#: Words that leave a place to fill.
_SLOT = r"(insert|your|enter|fill|add|type|put|todo|tbd|fixme|placeholder|name|resource|namespace|object|target|value|variable|question|answer|command|objective|title|text|topic|app|host|user|here|description|subject|item)"
#: Environment variables that are written in real commands.
_ENV = r"(home|path|user|pwd|shell|hostname|kubeconfig|tmpdir|lang|editor|ifs|random|ps1|uid|oldpwd)"
#: Forms of unfilled placeholders, on the text as it is. Expressions of command-line templates (with a leading dot or $) aren't among them.
PLACEHOLDER = [
    r"\{\{\s*[#/&^>!]?\s*(?![.$])[\p{L}_][\p{L}\p{N}_ .-]*\}\}",
    r"(?<![\p{L}\p{N}=$'\x22{%\\])\{\s*(\d{1,2}|[\p{L}_][\p{L}\p{N}_ ]*)\s*\}(?!\})",
    rf"\$\{{(?!(?i:{_ENV})\}})[\p{{L}}_][\p{{L}}\p{{N}}_ ]*\}}",
    r"<%=?[^%]*%>|\{%[^%]*%\}|#\{[^}]*\}|@@\w+@@|%%\w+%%|\[\[\s*\w+\s*\]\]",
    r"(?<![\w%+'\x22-])%\(?[sd]\b|%\(\w+\)[sd]|(?<!\w)%[A-Z][A-Z_]{2,}%",
    rf"<\s*(?!none|unknown|pending|nil|html|head|title|body|/)(?i:[\w -]*\b{_SLOT}\b[\w -]*|[A-Z]+(?:[_ -]?[A-Z]+)*_[A-Z_]+)\s*>",
    rf"<\w*(?i:_{_SLOT}|{_SLOT}_)\w*>",
    rf"\$\(\s*(?i:(\w+[_ ])*{_SLOT}([_ ]\w+)*)\s*\)",
    rf"\[\s*(?i:(\w+ )*{_SLOT}( \w+)*)\s*\]|\[[A-Z]+(?:[ _][A-Z]+)+\]",
    r"(?<![\w])__[A-Z][A-Z_]*__(?![\w])|(?<![\w])X{3,}(?![\w])|(?<![\w])_{3,}(?![\w])|\[object \w+\]",
]
#: Template text and stand-ins in place of a request, on the residual in lower case.
TEMPLATE = [
    r"^\W*(todo|fixme|tbd|tba|xxx)\b",
    r"^\W*(your|insert|enter|sample|example|dummy|test|default|add|type|write|put|my|new)\W+(\w+\W+){0,2}(question|text|prompt|title|content|value|name|query|description|message)(\W+(here|goes here|\d+))?\W*$",
    r"\b(question|text|prompt|content|title|answer|description|query) (goes|comes) here\b",
    r"^\W*(question|text|prompt|title|content|placeholder|sample|example|template|untitled|undefined|null|nan|none|nil|n/?a|not available|empty|default|string|object|missing|unknown|new question|no question|no content|no title)\W*\d*\W*$",
    r"^\W*(write|add|enter|insert|type) (text|wording|question|content|your|the|a)\b.{0,40}$",
]
#: Filler words.
FILLER = (
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum nunc viverra vitae vestibulum mauris pellentesque "
    "blah bla yada foo bar baz qux quux corge asdf qwer zxcv asdfasdf qwerty qwertz hjkl abc def xyz ghi jkl aaa test testing"
).split()
#: Of these a text needs words that no request has, so that short real words alone are no filler.
_PLAIN = {"do", "in", "id", "non", "et", "est", "sed", "ad", "ex", "test", "testing", "bar", "enim", "sit", "ut", "qui", "eu", "esse", "sunt"}
#: Phrases of error pages.
_STATUS = r"(bad request|unauthori[sz]ed|payment required|forbidden|access (is )?denied|permission denied|(page |file )?not found|method not allowed|request time-?out|conflict|gone|payload too large|too many requests|internal (server )?error|server error|not implemented|bad gateway|service (temporarily )?unavailable|gateway time-?out|moved permanently|length required|precondition failed)"
ERROR = [
    rf"^\W*(http\W?[\d./]*\W*)?(error|status|code)?\W*(\d{{3,4}})?\W*{_STATUS}\b",
    rf"\b([45]\d\d|1\d{{3}})\b\W*{_STATUS}|{_STATUS}\W*\(?(status\W*)?([45]\d\d|1\d{{3}})\b",
    r"^\W*(http\W?[\d./]*\W+|error\W+|status\W+)([45]\d\d)\b",
    r"<html>|<head>|<title>|<!doctype|<body",
    r"whitelabel error|application error|fatal error|unexpected error|an error (has )?occurred|traceback \(most recent call last\)|stack ?trace|\bat \w+(\.\w+)*\(?:?\w+\.java|nullpointerexception|\b\w+(\.\w+)+(exception|error)\b|^\W*\w+(error|exception):|segmentation fault|core dumped",
    r"(can'?t|cannot|could ?n[o']t|couldn.t) (be )?(reached|find (that|the|this) page|connect|load|open (this|the) page)|connection (was )?(timed out|refused|reset|closed)|something went wrong|went wrong on our|empty (reply|response)|upstream connect error|reset before headers|no healthy upstream|name or service not known|dns (error|lookup)",
    r"(request|access|ip|account|connection) (has been|was|is) (blocked|denied|rejected)|you (do ?n[o']t|don.t) have (permission|access)|not authori[sz]ed to|session (has )?(expired|timed out)|log in again|sign in to continue|rate limit|quota exceeded|slow down|maintenance (in progress|mode)|under maintenance|back (soon|in \d+ (minutes|hours|\w+))|temporarily (unavailable|down)|try again later|page (does not|doesn.t) exist|page (has )?(moved|been removed)|no longer available",
    r"page (introuvable|non trouvée)|accès (refusé|interdit)|erreur (interne|\d{3}|du serveur)|seite (wurde )?nicht gefunden|zugriff verweigert|interner serverfehler|página no encontrada|acceso denegado|error (interno|del servidor)|oldal nem található|hozzáférés megtagadva|belső (szerver)?hiba",
]
_TECH = r"(java ?script|scripts?|scripting|cookies?|web ?assembly)"
#: Phrases of notices that scripts, cookies or a check of the browser are required.
SCRIPTS = [
    r"^\W*<?noscript\b",
    rf"\b(enable|enabling|activate|allow|turn(ed)? on|switch on|unblock|accept|requires?|needs?|support)\b.{{0,40}}\b{_TECH}\b",
    rf"\b{_TECH}\b.{{0,60}}\b(required|disabled|blocked|off|enabled|needed|necessary|activated?|not supported|turned on|turn on|enable|allow)\b",
    r"\b(checking|verifying|validating)\b.{0,20}\b(browser|connection|human|visit)|verify (that )?you are (a )?human|are you (a )?(human|robot)|captcha|just a moment|ddos protection|unusual traffic|browser (check|does not support|is not supported|is out of date)|unsupported browser",
    rf"\b(aktivier\w*|erlaub\w*|zulassen|einschalten|benötigt)\b.{{0,30}}\b{_TECH}|\b(activer|autoris\w+|activez|nécessite)\b.{{0,30}}\b{_TECH}|\b(activ[ae]r?|habilit[ae]r?|permit[ae]r?|necesita)\b.{{0,30}}\b{_TECH}|\b(engedélyez\w*|kapcsolja be|szükséges)\b.{{0,30}}\b{_TECH}|\b{_TECH}\b.{{0,30}}\b(aktivieren|erlauben|erforderlich|requis|requerido|necesario|szükséges|engedélyez\w*)",
]


def any_of(column: Column, patterns: list[str], flags: str = "") -> Column:
    return reduce(or_, [column.rlike(flags + p) for p in patterns])


def squeezed(column: Column) -> Column:
    return F.trim(F.regexp_replace(column, r"[\s ]+", " "))


_UNIT = re.compile(r"\s*[\r\n]+\s*|(?<=[.!?])\s+")
_HEX = re.compile(r"\b(?=\w*\d)[0-9a-f]{8,}\b")
_DIGITS = re.compile(r"\d+")
_LETTERS = re.compile(r"[^\W\d_]+")


def without_numbers(text: str) -> str:
    return _DIGITS.sub("0", _HEX.sub("0", " ".join(text.lower().split())))


def masked_line(line: str, known: frozenset[str]) -> str:
    """A line with * for all but the known words; empty for one without a known word of three letters."""
    line = _LETTERS.sub(lambda m: m.group() if m.group() in known else "*", without_numbers(line))
    return line if any(len(w) > 2 for w in _LETTERS.findall(line)) else ""


def _subject(text: str | None) -> set[str]:
    return {w for w in re.findall(r"[^\W_]+", (text or "").lower()) if len(w) > 2}


def filler(text: Column) -> Column:
    """At least half of the words are filler, one of them a word that is nothing else."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")
    hits = F.size(F.filter(words, lambda w: w.isin(FILLER)))
    sure = F.size(F.filter(words, lambda w: w.isin([w for w in FILLER if w not in _PLAIN])))
    tests = F.lower(text).rlike(r"^\W*(test\W+)+(test\W*)+$|text (\w+ )?here\W+(text|\w+ text)\W+here|^\W*(\w+ )?text here\W+text here")
    return (hits > 0) & (hits >= F.size(words) * FILLER_SHARE) & (sure > 0) | tests


def evidence(residual: Column) -> Column:
    """placeholder, template, filler, script or error; null if the residual has no evidence."""
    text = squeezed(residual)
    low = F.lower(text)
    free = ~low.rlike(REQUEST)
    return (
        F.when(any_of(text, PLACEHOLDER), "placeholder")
        .when(free & any_of(low, TEMPLATE), "template")
        .when(free & filler(low), "filler")
        .when(free & any_of(low, SCRIPTS), "script")
        .when(free & any_of(low, ERROR), "error")
    )


def read_lines(rows: DataFrame) -> DataFrame:
    """id, host, subject and record (hashes), related, units, plain, masked of rows with id, host, text, about: the lines and sentences of each text and the hashes of their forms. Records that differ in digits or ids alone are one."""
    spark = rows.sparkSession
    words = rows.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))).alias("w")).groupBy("w").count()
    known = words.crossJoin(rows.agg(F.count("*").alias("all"))).where(F.col("count") >= F.greatest(F.lit(2), F.col("all") * KNOWN_SHARE)).select("w").toArrow()["w"].to_pylist()
    shared = spark.sparkContext.broadcast(frozenset(known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, about = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            units = [[u for u in _UNIT.split(t.strip()) if u] for t in texts]
            norms = [[xxhash.xxh64_intdigest(n) - (1 << 63) if (n := masked_line(u, shared.value)) else None for u in us] for us in units]
            plain = [[xxhash.xxh64_intdigest(without_numbers(u)) - (1 << 63) for u in us] for us in units]
            subject = [xxhash.xxh64_intdigest(a) - (1 << 63) if a else 0 for a in about]
            record = [xxhash.xxh64_intdigest(without_numbers(t)) - (1 << 63) for t in texts]
            related = [bool(_subject(t) & _subject(a)) if a else None for t, a in zip(texts, about)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(subject, pa.int64()), pa.array(record, pa.int64()), pa.array(related, pa.bool_()), pa.array(units, pa.list_(pa.string())), pa.array(plain, pa.list_(pa.int64())), pa.array(norms, pa.list_(pa.int64()))], names=["id", "host", "subject", "record", "related", "units", "plain", "masked"])

    return spread(rows.select("id", "host", "text", "about")).mapInArrow(run, f"id {dict(rows.dtypes)['id']}, host string, subject bigint, record bigint, related boolean, units array<string>, plain array<bigint>, masked array<bigint>")


def recurrent(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(boilerplate: host, plain; learned: masked) by the counts of lines by host."""
    subjects = lines.groupBy("host", "record", "subject").agg(F.bool_or("related").alias("related"), F.any_value("plain").alias("plain"), F.any_value("masked").alias("masked"))
    records = cut(subjects.groupBy("host", "record").agg(F.count("*").alias("subjects"), F.count_if(~F.col("related")).alias("unnamed"), F.any_value("plain").alias("plain"), F.any_value("masked").alias("masked")), "p6-records")
    forms = F.array(F.struct(F.lit(False).alias("mask"), F.array_distinct("plain").alias("norms")), F.struct(F.lit(True).alias("mask"), F.array_distinct("masked").alias("norms")))
    counts = records.select("host", "subjects", "unnamed", F.inline(forms)).select("host", "subjects", "unnamed", "mask", F.explode("norms").alias("norm")).where("norm IS NOT NULL").groupBy("host", "mask", "norm").agg(F.count("*").alias("n"), F.sum("subjects").alias("subjects"), F.sum("unnamed").alias("unnamed"))
    counts = cut(counts, "p6-counts")
    hosts = records.groupBy("host").agg(F.count("*").alias("total"), (F.sum("unnamed") / F.sum("subjects")).alias("rate"))
    hosts = hosts.join(counts.where("mask").groupBy("host").agg(F.count("*").alias("different")), "host")
    held = counts.join(hosts, "host")
    chance = F.col("unnamed") * F.ln("rate") + F.ln("different")
    learned = held.where(F.col("mask") & (F.col("rate") > 0) & (F.col("unnamed") >= UNNAMED * F.col("subjects")) & (chance < F.ln(F.lit(CHANCE)))).select(F.col("norm").alias("masked")).distinct()
    return held.where(~F.col("mask") & (F.col("n") >= RECURRENT) & (F.col("n") >= RECURRENT_SHARE * F.col("total"))).select("host", F.col("norm").alias("plain")), learned


def residue(df: DataFrame, id_column: str, text_column: str, host_column: str, about: tuple[str, ...] = ()) -> DataFrame:
    """`id_column`, kind: one row for each record that is to be excluded. about: columns that say what the record is about; kind is `recurrent` where only the counts show it."""
    subject = F.concat_ws(" ", *(F.col(f"`{c}`") for c in about)) if about else F.lit(None).cast("string")
    rows = df.select(F.col(f"`{id_column}`").alias("id"), F.coalesce(F.col(f"`{host_column}`"), F.lit("")).alias("host"), F.col(f"`{text_column}`").alias("text"), subject.alias("about")).where(F.col("text").rlike(r"\S"))
    lines = cut(read_lines(rows), "p6-lines")
    boilerplate, learned = recurrent(lines)
    boilerplate, learned = cut(boilerplate.withColumn("often", F.lit(True)), "p6-often"), cut(learned.withColumn("learned", F.lit(True)), "p6-learned")
    # only records with a recurrent line are taken apart
    at = lines.select("id", "host", F.posexplode(F.arrays_zip("plain", "masked")).alias("pos", "form")).select("id", "host", "pos", "form.*")
    marked = at.join(boilerplate, ["host", "plain"], "left").join(learned, "masked", "left").where("often OR learned").groupBy("id").agg(F.array_agg(F.when(F.col("learned"), F.col("pos"))).alias("learned"), F.array_agg(F.when(F.col("often") & F.col("learned").isNull(), F.col("pos"))).alias("often"))
    whole = lines.select("id", "units").join(marked, "id", "left")
    text = F.array_join("units", " ")
    parts = whole.where(F.size("often") > 0).select("id", "often", F.posexplode("units").alias("pos", "unit"))
    kept = parts.where(~F.array_contains("often", F.col("pos")) | evidence(F.col("unit")).isNotNull()).groupBy("id").agg(F.array_join(F.array_sort(F.array_agg(F.struct("pos", "unit")))["unit"], " ").alias("residual"))
    both = whole.join(kept, "id", "left").select("id", text.alias("text"), "residual", (F.size("learned") > 0).alias("learned"))
    kind = F.coalesce(evidence(F.col("text")), F.when(F.col("residual").isNotNull(), evidence(F.col("residual"))), F.when(F.col("learned"), "recurrent"))
    return both.select(F.col("id").alias(id_column), kind.alias("kind")).where("kind IS NOT NULL")


def without_residue(df: DataFrame, id_column: str, text_column: str, host_column: str, about: tuple[str, ...] = ()) -> DataFrame:
    """The remaining records, all their columns. The ids must be unique."""
    bad = residue(df, id_column, text_column, host_column, about).select(F.col(f"`{id_column}`").alias("__bad"))
    return df.join(bad, F.col(f"`{id_column}`") == F.col("__bad"), "left_anti")
