"""Text cut off by field limits (problem 10), in Spark SQL.

Word trigrams are counted over all distinct texts, apart for prose, lists and headings: how often the text goes on after
the trigram (inside), and how often a line ends with it without any final mark (at ends). The final trigram of each text
is joined to these counts, its own occurrence left out. A text is cut if its last trigram is frequent inside but almost
never at an end. A trigram that was seen too seldom is judged by what begins like it (its last word is a proper beginning
of a word seen in the same place), then by shorter grams with a wildcard. An ellipsis at the end is taken off and shows
nothing by itself: the end before it is judged (`And so on...` ends many texts). Named marks of omission, an open code
fence, an open table row or a final comma show the cut directly; a final full stop, closing bracket or fence shows the end.

The texts are read once for their counts; the different ends are judged once each, however many texts share one, by one
join with the counts of all grams.

Cases: null and blank texts are no cases; repeated texts count once in the statistics and are all reported; an empty
table gives no rows. Other columns are ignored. Texts are told apart by SHA-256.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from granary.session import cut

#: A gram decides if it was seen so often at least besides the text itself (three sights without an end: at one standard error its share of ends is below a quarter), and shows a cut if at most this share of it is at ends.
LEAST_SEEN, MOST_AT_END = 3, 0.1
#: A last word is a beginning of another that is so many times as frequent in its place, and so many times as frequent as text goes on after the last word.
FAR_MORE, RARELY_ON = 5, 50

#: Named marks of omission at the end of a text, and the bare ones.
NAMED = r"(\\uFFFD|\\[\\s*(more|\\.\\.\\.|…|truncated|cut|snip)\\s*\\]|\\(\\s*(more|truncated|continued|cont\\.?)\\s*\\)|<\\s*(more|truncated)\\s*>|read more|\\[\\+?\\d+ (chars|characters)\\])$"
BARE = r"(…|\\.\\.\\.)$"
#: Characters at the end of a text among which a mark is looked for: more than any of them has.
MARK_CHARS = 64
#: Marks that end a sentence, with closing quotes and brackets after them.
FINAL = r"[.!?。！？।]([\\x22\\x27”’»)\\]*_\\x60]|\\s)*$"
#: White space of Java's regular expressions.
_BLANK = " \t\n\r\f\x0b"
#: A mark at the end of a word that isn't part of it.
_STOP = r"[\\p{{P}}&&[^`#@/_-]]+$"

# Marks of omission are left out, so that a cut word before one counts as an end; so are fenced code and blank lines.
# Line ends are LF from here on. Between fences every other part of a text is code.
_SHAPES = rf"""
SELECT doc, lines, try_element_at(lines, -1) AS tail,
       CASE WHEN named THEN 'mark'
            WHEN fenced AND size(filter(split(bare, '\\n'), x -> ltrim(x) LIKE '```%')) % 2 = 1 THEN 'code'
            WHEN endswith(bare, '```') THEN 'whole'
            WHEN last RLIKE '^\\s*\\|' THEN CASE WHEN endswith(last, '|') THEN 'whole' ELSE 'table' END
            WHEN right(last, 1) IN (',', ';', ':') THEN 'comma'
            WHEN last RLIKE '{FINAL}' AND NOT lower(last) RLIKE '(version|v|step|revision) [0-9]+\\.$' THEN 'whole' END AS shape
FROM (SELECT *, filter(CASE WHEN fenced THEN split(array_join(filter(split(concat('\n', bare), '\\n[ \\t]*```[^\\n]*'), (x, i) -> i % 2 = 0), '\n'), '\\n') ELSE split(bare, '\\n') END, x -> length(trim(x)) > 0) AS lines
      FROM (SELECT doc, named, bare, substring_index(bare, '\n', -1) AS last, contains(bare, '```') AS fenced
            FROM (SELECT doc, named, CASE WHEN named OR endswith(end, '…') OR endswith(end, '...') THEN rtrim('{_BLANK}', concat(left(text, greatest(0, length(text) - {MARK_CHARS})), regexp_replace(end, '(?i)\\s*({NAMED}|{BARE})', ''))) ELSE text END AS bare
                  FROM (SELECT doc, text, end, lower(end) RLIKE '{NAMED}' AS named
                        FROM (SELECT doc, text, right(text, {MARK_CHARS}) AS end FROM (SELECT doc, CASE WHEN contains(text, '\r') THEN replace(replace(text, '\r\n', '\n'), '\r', '\n') ELSE text END AS text FROM {{texts}}))))))
"""

# Words: lower case, digits as 0. A line's kind shows by its first character.
_KIND = r"""
CASE WHEN NOT substr(ltrim({line}), 1, 1) RLIKE '[-*•+0-9|#]' THEN 'prose'
     WHEN {line} RLIKE '^\\s*([-*•+]|[0-9]+[.)])\\s' THEN 'list'
     WHEN {line} RLIKE '^\\s*\\|' THEN 'table'
     WHEN {line} RLIKE '^\\s*#+ ' THEN 'heading' ELSE 'prose' END"""
_WORDS = r"filter(split(translate(lower({line}), '123456789\t\u000b\u000c', '000000000   '), ' '), x -> x <> '')"
_PLAIN = "(substr({w}, -1) BETWEEN 'a' AND 'z' OR substr({w}, -1) = '0')"

# A position is inside if the line goes on after the bare word, by a mark or by a word.
# The words are zipped with themselves, shifted, so that no row carries a whole line.
_COUNTS = rf"""
SELECT kind, w1, w2, w3, count_if(inside) AS ins, count_if(NOT inside) AS fin
FROM (SELECT kind, w1, w2, CASE WHEN {_PLAIN.format(w="w")} THEN w ELSE regexp_replace(w, '{_STOP}', '') END AS w3,
             next IS NOT NULL OR NOT {_PLAIN.format(w="w")} AND w RLIKE '{_STOP}' AS inside
      FROM (SELECT kind, inline(arrays_zip(concat(array('^', '^'), w), concat(array('^'), w), w, slice(w, 2, size(w)))) AS (w1, w2, w, next)
            FROM (SELECT {_KIND.format(line="line")} AS kind, {_WORDS.format(line="line")} AS w FROM (SELECT explode(lines) AS line FROM {{shapes}})))
      WHERE w IS NOT NULL)
WHERE w3 <> '' GROUP BY kind, w1, w2, w3
"""
_ENDS = rf"""
SELECT doc, kind, coalesce(get(w, size(w) - 3), '^') AS w1, coalesce(get(w, size(w) - 2), '^') AS w2, regexp_replace(get(w, size(w) - 1), '{_STOP}', '') AS w3, get(w, size(w) - 1) RLIKE '{_STOP}' AS inside
FROM (SELECT doc, {_KIND.format(line="tail")} AS kind, {_WORDS.format(line="tail")} AS w FROM {{shapes}} WHERE shape IS NULL AND tail IS NOT NULL)
"""

# Sorts of gram, each with the columns of its key. Those that begin with p hold the beginnings of words.
_GRAMS = {"w123": ("kind", "w1", "w2", "w3"), "w23": ("kind", "''", "w2", "w3"), "w12": ("kind", "w1", "w2", "''"), "w13": ("kind", "w1", "''", "w3"), "w3": ("''", "''", "''", "w3"), "o23": ("''", "''", "w2", "w3")}
_STARTS = {"p123": ("''", "w1", "w2", "w3"), "p23": ("''", "''", "w2", "w3"), "p3": ("''", "''", "''", "w3")}


def _keys(grams: dict[str, tuple[str, ...]]) -> str:
    return "inline(array({}))".format(", ".join("named_struct('g', '{}', 'k', {}, 'a', {}, 'b', {}, 'c', {})".format(g, *key) for g, key in grams.items()))


# Counts of the grams, of those with wildcards, and of what begins like a word.
_FACTS = f"""
SELECT g, k, a, b, c, sum(ins) AS ins, sum(fin) AS fin FROM (SELECT ins, fin, {_keys(_GRAMS)} AS (g, k, a, b, c) FROM {{counts}}) GROUP BY g, k, a, b, c
"""
_BEGUN = f"""
SELECT g, '' AS k, a, b, begin AS c, max(n) AS ins, CAST(0 AS BIGINT) AS fin
FROM (SELECT g, a, b, n, explode(transform(sequence(1, length(w) - 1), i -> substr(w, 1, i))) AS begin
      FROM (SELECT 'p123' AS g, w1 AS a, w2 AS b, w3 AS w, ins + fin AS n FROM {{counts}}
            UNION ALL SELECT replace(replace(g, 'o23', 'p23'), 'w3', 'p3'), a, b, c, ins + fin FROM {{facts}} WHERE g IN ('o23', 'w3'))
      WHERE n >= {FAR_MORE} AND length(w) > 1)
GROUP BY g, a, b, begin
"""
# Each different end asks for all of its grams at once.
_ASKED = f"""
SELECT e.*, {_keys(_GRAMS | _STARTS)} AS (g, k, a, b, c) FROM (SELECT DISTINCT kind, w1, w2, w3, inside FROM {{ends}}) e
"""


def _judged(g: str) -> str:
    return f"CASE WHEN {g}.ins + {g}.fin < {LEAST_SEEN} THEN NULL ELSE {g}.fin <= {MOST_AT_END} * ({g}.ins + {g}.fin) END"


# The end's own occurrence is left out of its grams. The reason is null for an end that isn't a cut.
_VERDICTS = f"""
SELECT kind, w1, w2, w3, inside,
       CASE WHEN {_judged("t")} THEN 'trigram'
            WHEN w2 <> '^' AND (p.p123 >= greatest({FAR_MORE} * greatest(1, t.fin), {RARELY_ON} * t.ins) OR p.p23 >= greatest({FAR_MORE} * (o.ins + o.fin), {RARELY_ON} * o.ins)) THEN 'word'
            WHEN NOT {_judged("t")} THEN NULL
            WHEN {" OR ".join(f"{g}.ins + {g}.fin >= {LEAST_SEEN} AND {g}.fin * 2 >= {g}.ins + {g}.fin" for g in ("x", "y", "z"))} THEN NULL
            WHEN v.ins = 0 AND p.p3 >= {FAR_MORE} * (v.ins + v.fin) THEN 'word'
            WHEN {_judged("x")} THEN 'bigram'
            WHEN {_judged("y")} OR {_judged("z")} THEN 'context' END AS reason
FROM (SELECT kind, w1, w2, w3, inside, {{own}} named_struct('p123', max(CASE WHEN g = 'p123' THEN ins END), 'p23', max(CASE WHEN g = 'p23' THEN ins END), 'p3', max(CASE WHEN g = 'p3' THEN ins END)) AS p
      FROM (SELECT q.*, f.ins, f.fin FROM {{asked}} q LEFT JOIN {{all}} f ON q.g = f.g AND q.k = f.k AND q.a = f.a AND q.b = f.b AND q.c = f.c)
      GROUP BY kind, w1, w2, w3, inside)
"""


def _own() -> str:
    """The counts of each sort of gram as a struct; of the trigram and its wildcards without the end itself. A line of one word has no wildcards."""
    out = ""
    for name, g in (("t", "w123"), ("x", "w23"), ("y", "w12"), ("z", "w13"), ("v", "w3"), ("o", "o23")):
        several = " AND w2 <> '^'" if name in "xyz" else ""
        less = ("inside", "NOT inside") if name in "txyz" else ("false", "false")
        out += "named_struct({}) AS {}, ".format(", ".join(f"'{c}', coalesce(max(CASE WHEN g = '{g}'{several} THEN {c} END), 0) - CASE WHEN {own} THEN 1 ELSE 0 END" for c, own in zip(("ins", "fin"), less)), name)
    return out


def cut_documents(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`id_column`, reason: one row for each text that was cut off. reason: mark, code, table, comma, trigram, word, bigram, context."""
    spark = df.sparkSession
    text = F.trim(F.col(f"`{text_column}`"), F.lit(_BLANK))
    docs = df.select(F.col(f"`{id_column}`").alias("id"), text.alias("text")).where("length(text) > 0").withColumn("doc", F.sha2("text", 256))
    sql = lambda q, **views: spark.sql(q, **views)
    shapes = cut(sql(_SHAPES, texts=docs.select("doc", "text").distinct()), "p10-shapes")
    ends = cut(sql(_ENDS, shapes=shapes), "p10-ends")
    counts = cut(sql(_COUNTS, shapes=shapes), "p10-counts")
    facts = sql(_FACTS, counts=counts)
    every = facts.unionByName(sql(_BEGUN, counts=counts, facts=facts))
    verdicts = sql(_VERDICTS.replace("{own}", _own()), asked=sql(_ASKED, ends=ends), all=every).where("reason IS NOT NULL")
    by_gram = ends.join(verdicts, ["kind", "w1", "w2", "w3", "inside"]).select("doc", "reason")
    found = shapes.where("shape IN ('mark', 'code', 'table', 'comma')").select("doc", F.col("shape").alias("reason")).unionByName(by_gram)
    return docs.select("id", "doc").join(found, "doc").select(F.col("id").alias(id_column), "reason")


def cut_share(df: DataFrame, cuts: DataFrame, id_column: str = "doc_id", source_column: str = "source") -> DataFrame:
    """source, documents, cut, share: how often each source truncates. Null and blank texts count as documents."""
    marked = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{source_column}`").alias("source")).join(cuts.select(F.col(f"`{id_column}`").alias("id"), F.lit(1).alias("hit")), "id", "left")
    return marked.groupBy("source").agg(F.count("*").alias("documents"), F.count("hit").alias("cut"), F.round(F.count("hit") / F.count("*"), 6).alias("share"))
