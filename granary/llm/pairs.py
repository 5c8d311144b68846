"""Broken prompt and response pairs (problem 4).

The opening of each response, its first sentence, is brought to a template: introductions are dropped and the words of
the row's own command are masked. Distinct openings are clustered by verified MinHash (five-word shingles, similarity 0.8
or more). A cluster that recurs under unrelated prompts, and whose responses never name the command that was asked for,
holds refusals; a phrase of refusal settles the clusters that are too rare to recur. Copy, language and termination
checks label the other defects: what a response ends with is compared with the templates of whole steps, and what a
command ends with with the options and values of all commands.

Cases: rows with a null question are no cases; a null, blank or stand-in response is `empty`; each row has one type, the
first of empty, copy, refusal, language, truncated; a language is compared only where both texts show theirs and the
prompt isn't residue itself (problem 6); repeated rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from granary.llm.residue import evidence
from granary.session import cut, spread

SHINGLE, SIMILAR = 5, 0.8
BANDS, ROWS = 12, 3
#: A template reveals refusals if it recurs under so many prompts, and if at most this share of its responses names the command.
RECURS, NAMED = 5, 0.05
#: Of a step's template, so many more rows than of what it begins with show that the shorter one broke off.
MORE = 8
#: An option that only ever ends a command is one that broke off if at most this share of the commands has it.
SELDOM = 0.0005

#: Stand-ins for a missing value.
STAND_INS = ["", "n/a", "na", "none", "null", "nil", "nan", "tbd", "tba", "todo", "empty", "(empty)", "<empty>", "[empty]", "no answer", "(no answer)", "unknown", "undefined", "missing", "(missing)", "not available", "not applicable", "pending", "(none)", "(null)", "<null>", "[]", "{}", "x", "xxx", "no response", "(no response)", "placeholder", "answer", "response", "see above", "same", "(blank)", "blank"]
#: Function words by which a language shows.
WORDS = {
    "en": "the to use with is that of which set for name add so this in and it does start pass by as limit select narrow check how do what should could you show me way there have need help command lets would one can run enough call an when".split(),
    "de": "der die das den dem und als für mit auf ein eine einen diese danach zum um nach von im ich mir wie welcher befehl hilft bei benutze gib nenne setze wähle schränke prüfe ist nicht zu".split(),
    "fr": "le la les des du pour avec dans un une et comme ensuite nom par sur que ne l’espace l’équipe quelle commande utiliser comment traiter commence choisis limite place enfin est projet indique donne".split(),
    "es": "el la los las del con para un una y como después nombre usa elige escribe qué cómo comando uso trato espacio equipo proyecto empieza limita sitúa final que no se este".split(),
    "hu": "a az és hogy egy meg erre utána nevet melyik hogyan parancs kell miután helyére kezelhetem használd kezdd add állítsd válaszd szűkítsd írd nézd miatt csapat térben névteret".split(),
}
#: Introductions before an answer.
LEAD = r"^\W*(?:(?:step\s*)?\d+\s*[.:)]\s*|note\s*:\s*|hm+\W+|well\W+|ok(ay)?\W+|answer\s*:\s*|(i'?m|i am|we are|we're) (very |so |really )?sorry\W*(but\s+)?|sorry\s*[,\-–—:]\s*(but\s+)?|unfortunately\W+|regrettably\W+|(my |our )?apologies\W+|i (deeply )?regret (that|to say that)\s+|i'?m afraid( that)?\s+|please note that\s+)*\W*"
#: Phrases of refusal, in the opening of a response.
REFUSES = (
    r"\b(i|we)( am|'m|'re| are)? (do |must |have to |would |will |can |could )?(not |n't )?(can'?t|cannot|won'?t|unable|decline|refuse|rather not|not (able|comfortable|allowed|permitted|willing|going|supposed|feel|in a position)|have been told not|have no (permission|means|access)|lack the)"
    r"|\b(can'?t|cannot|could not|won'?t|unable to|not able to|not allowed to|not permitted to) (be )?(assist|help|answer|provide|comply|fulfil|respond|give|do|comment|share|discuss|support|continue|complete|fulfilled|answered|given|provided)"
    r"|not (be )?appropriate for me|inappropriate|no (answer|help|response|command|steps) (can|may|will) be|policy (keeps|prevents|forbids|prohibits|does not)|against (my|our|the) (policy|guidelines|rules)|not supported here|outside (of )?what i|lack the means|something i (have to|must|need to) (refuse|decline)|\bas an? (ai|assistant|automated|language model)"
    r"|must (decline|refuse)|rather not (comment|say|answer)|keeps me from|not comfortable|told not to"
    r"|ich kann (dabei |ihnen |dir )?(leider )?nicht|leider|je ne peux pas|désolé|no puedo|lo siento|nem (tudok|segíthetek)|sajnálom"
)
#: Words that a whole sentence doesn't end with.
DANGLING = r"\b(a|an|the|of|to|with|for|and|or|in|on|from|by|at|as|that|which|which is|so|but|if|when|der|die|das|den|dem|des|eine|einen|und|oder|für|le|la|les|un|une|du|et|ou|dans|avec|pour|el|los|las|una|y|del|con|para|az|és|egy)$|(^|\s)then [\w-]+( at| up)?$"


_STANDS, _LEAD = set(STAND_INS), re.compile(LEAD, re.I)
_WORDS = {name: frozenset(own) for name, own in WORDS.items()}
_ALL_WORDS = frozenset(w for own in WORDS.values() for w in own)
_DANGLING = re.compile(DANGLING)
_UNIT = re.compile(r"\s*\n\s*|(?<=[.!?])\s+(?=[A-ZÀ-Þ¿ŐŰ])")
_NUMBER = re.compile(r"^\s*(?:(?:[Ss]tep\s*)?\d+\s*[.:)]\s*|[-*•]\s+)")
_END = re.compile(r"(?:^|\s)(?:(?:[Ss]tep\s*)?\d+\s*[.:)]?|[-*•]|[Ss]tep|[,;:(\[{]|…|\.\.\.)$")
_WHOLE = re.compile(r"\w\W+\w.*[.!?]$", re.S)
_OPEN = re.compile(r"[,;:(\[{…]$|\.\.\.$|\([^)]*$")
_COMMAND_END = re.compile(r"(?:\\|=|,|:|\||&&|\(|\{|\[|\s-{1,2}|…|\.\.\.)$")
_INTRO = frozenset("step q question prompt user asked you the is your a answer".split())


def is_empty(text: str | None) -> bool:
    if text is None:
        return True
    low = text.strip().lower()
    return low.rstrip(". ") in _STANDS or not any(c.isalnum() for c in low)


def is_copy(response: str, question: str) -> bool:
    """Nothing is left of the response without the question but an introduction."""
    q, r = " ".join(bare(question)), " ".join(bare(response))
    if not q:
        return False
    if q in r and all(w in _INTRO or w.isdigit() for w in r.replace(q, " ").split()):
        return True
    b = r.split()
    while b and (b[0] in _INTRO or b[0].isdigit()) and not q.startswith(b[0]):
        b = b[1:]
    a = q.split()
    return len(b) >= 6 and abs(len(a) - len(b)) <= 1 and len(set(a) - set(b)) <= 1 and len(set(b) - set(a)) <= 1


def bare(text: str) -> list[str]:
    """Words of letters and digits in lower case."""
    return re.findall(r"[^\W_]+", text.lower())


def language(text: str) -> str | None:
    """The language whose function words prevail; None if none does."""
    low = text.lower()
    words = set(re.findall(r"[^\W\d_]+(?:[’'][^\W\d_]+)?", low))
    score = sorted(((len(own & words), name) for name, own in _WORDS.items()), reverse=True)
    return score[0][1] if score[0][0] >= 2 and score[0][0] > score[1][0] else None


def masked(text: str, names: set[str]) -> str:
    """The text in lower case without final marks; the words of the command as *."""
    out = []
    for w in text.lower().rstrip(".!?").split():
        stem = w.rstrip(".,;:!?)]}'\"”’»")
        out.append("*" + w[len(stem) :] if stem in names else w)
    return " ".join(out)


def _begins(word: str, known: set[str]) -> bool:
    """A word breaks off: it is a proper beginning of a known one and no known one itself."""
    return bool(word) and word not in known and any(w.startswith(word) for w in known)


def read_pair(question: str, response: str | None, command: str | None, sub: str | None, objective: str | None) -> dict:
    """What the row shows by itself: kind, or the templates and signs that are judged with those of all rows."""
    if is_empty(response) or is_empty(command):
        return {"kind": "empty"}
    if is_copy(response, question) or is_copy(command, question):
        return {"kind": "copy"}
    cmd, text = command.strip(), response.strip()
    names = {t.lstrip("-") for t in re.findall(r"[\w-]+", cmd.lower())}
    said = set(re.findall(r"[\w-]+", f"{question} {objective or ''}".lower()))
    units = [_NUMBER.sub("", u) for u in _UNIT.split(text)] or [""]
    last = units[-1]
    tails = re.findall(r"[\w-]+", last.lower())
    tail = tails[-1] if tails else ""
    words = set(re.findall(r"[\w-]+", text.lower()))
    broken = (
        not last.strip()
        or bool(_END.search(text)) and not _WHOLE.search(last)
        or bool(_OPEN.search(last))
        or bool(_DANGLING.search(last.lower()))
        or text.count("`") % 2 == 1
        or len(units) > 1 and units[-2][-1:] in tuple(".!?") and not re.search(r"[.!?]\W*$", last)
        or tail not in _ALL_WORDS and _begins(tail, names | said)
    )
    parts = cmd.split()
    token = parts[-1]
    value = re.split(r"[=:/,]", token)[-1].lower()
    broken = broken or bool(_COMMAND_END.search(cmd)) or cmd.count("'") % 2 == 1 or cmd.count('"') % 2 == 1 or cmd.count("{") > cmd.count("}") or not value.startswith("-") and _begins(value, said)
    first = next((x for u in units if (x := _LEAD.sub("", u.lower()))), "")
    ql = language(question)
    rl = language(text)
    return {
        "opening": masked(first, names), "steps": [masked(u, names) for u in units], "asked": any(w in words for w in (sub or "").lower().split()), "broken": broken, "foreign": bool(ql and rl and ql != rl),
        "option": re.match(r"-+[^=]*", token)[0] if token.startswith("-") and "=" not in token else None, "options": [p.split("=")[0] for p in parts if p.startswith("-")],
    }


def bucket_links(names: list[str], sets: list[set]) -> Iterator[tuple[str, str]]:
    """Verified links that connect the members of a bucket as all its similar pairs would: each member is compared with those that nothing reached yet."""
    left = set(range(len(names)))
    reached: list[int] = []
    while left or reached:
        at = reached.pop() if reached else left.pop()
        near = [i for i in left if len(sets[at] & sets[i]) >= SIMILAR * len(sets[at] | sets[i])]
        left.difference_update(near)
        reached += near
        yield from ((names[at], names[i]) for i in near)


def components(links: DataFrame) -> DataFrame:
    """node, cluster: the nodes of links (a, b) with the least node that a path leads to."""
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "p4-links")
    label = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("cluster")), "p4-label")
    while True:
        near = both.join(label, F.col("b") == F.col("node")).groupBy("a").agg(F.min("cluster").alias("near"))
        step = label.join(near, F.col("node") == F.col("a")).select("node", F.col("cluster").alias("was"), F.least("cluster", "near").alias("cluster"))
        # the cluster of the cluster, so that long chains take few rounds
        step = cut(step.join(label.select(F.col("node").alias("cluster"), F.col("cluster").alias("top")), "cluster").select("node", "was", F.col("top").alias("cluster")), "p4-label")
        label = step.select("node", "cluster")
        if step.where("was <> cluster").isEmpty():
            return label


def minhash_clusters(openings: DataFrame, column: str = "opening") -> DataFrame:
    """`column`, cluster: distinct openings with the least opening that verified links lead to.

    The members of each band's bucket are linked as far as they are alike, whichever of them that is; the links of all
    buckets are followed to their ends. A bucket of members that are all alike takes one comparison for each member.
    """
    words = F.split(column, " ")
    shingles = F.when(F.size(words) < SHINGLE, F.array(F.xxhash64(F.col(column)))).otherwise(F.expr(f"transform(sequence(1, size(split({column}, ' ')) - {SHINGLE - 1}), i -> xxhash64(array_join(slice(split({column}, ' '), i, {SHINGLE}), ' ')))"))
    base = openings.select(column, F.array_distinct(shingles).alias("sh"))
    least = lambda k: F.array_min(F.transform("sh", lambda s: F.xxhash64(s, F.lit(k))))  # noqa: E731 - a second parameter of the inner one would be the position
    bands = F.array(*(F.xxhash64(F.lit(b), *(least(b * ROWS + r) for r in range(ROWS))) for b in range(BANDS)))
    spread = base.select(column, "sh", F.explode(bands).alias("bucket"))
    buckets = spread.groupBy("bucket").agg(F.collect_list(F.struct(F.col(column).alias("name"), "sh")).alias("members")).where(F.size("members") > 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members in batch.column(0):
                found = list(bucket_links([m["name"].as_py() for m in members], [set(m["sh"].as_py()) for m in members]))
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.string()) for i in (0, 1)], names=["a", "b"])

    linked = components(buckets.select("members").mapInArrow(run, "a string, b string"))
    return openings.select(column).join(linked, F.col(column) == F.col("node"), "left").select(column, F.coalesce("cluster", column).alias("cluster"))


def cut_short(short: DataFrame, long: DataFrame, more: int = MORE) -> DataFrame:
    """step: those of `short` that are a proper beginning of a step of `long` which is so many times as frequent. Both: step, n.

    A beginning has all words of the longer step but the last one, of which it has a part: the key is the words before,
    with the first letter of the word. So a step gives as many keys as it has words, and each key with its next word once.
    """
    w, at = F.split("step", " "), F.posexplode("w").alias("k", "word")
    key = F.struct(F.col("k"), F.xxhash64(F.array_join(F.slice("w", F.lit(1), F.col("k")), " ")).alias("h"), F.substring("word", 1, 1).alias("c"))
    begun = long.select("n", w.alias("w")).select("n", "w", at).select(key.alias("key"), "word", "n").groupBy("key", "word").agg(F.max("n").alias("longer"))
    ends = short.where("step <> ''").select("step", "n", w.alias("w")).withColumn("k", F.size("w") - 1).withColumn("word", F.element_at("w", -1)).select("step", "n", key.alias("key"), F.col("word").alias("part"))
    return ends.join(begun, "key").where(F.startswith("word", F.col("part")) & (F.col("longer") >= more * F.col("n"))).select("step").distinct()


def defects(df: DataFrame, id_column: str = "entry_id", question: str = "question", response: str = "chain_of_thought", command: str = "command", command_name: str = "command_name", objective: str = "objective") -> DataFrame:
    """`id_column`, defect: one row for each defective pair."""
    c = lambda name: F.col(f"`{name}`")
    rows = df.select(c(id_column).alias("id"), c(question).alias("q"), c(response).alias("r"), c(command).alias("cmd"), c(command_name).alias("sub"), c(objective).alias("o")).where("q IS NOT NULL")
    fields = ["kind", "opening", "steps", "asked", "broken", "foreign", "option", "options"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = [read_pair(*row) for row in zip(*(batch.column(i).to_pylist() for i in range(1, 6)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r.get(f) for r in read], t) for f, t in zip(fields, (pa.string(), pa.string(), pa.list_(pa.string()), pa.bool_(), pa.bool_(), pa.bool_(), pa.string(), pa.list_(pa.string())))), batch.column(6), pa.array([q if r.get("foreign") else None for q, r in zip(batch.column(1).to_pylist(), read)], pa.string())], names=["id", *fields, "prompt", "q"])

    base = spread(rows.select("*", F.xxhash64("q").alias("prompt"))).mapInArrow(run, f"id {dict(df.dtypes)[id_column]}, kind string, opening string, steps array<string>, asked boolean, broken boolean, foreign boolean, option string, options array<string>, prompt bigint, q string")
    base = cut(base.withColumn("residue", F.when(F.col("q").isNotNull(), evidence(F.col("q")))).drop("q"), "p4-base")
    rest = base.where("kind IS NULL")
    # refusals: templates that recur under unrelated prompts and never name what was asked for
    seen = rest.where("opening <> ''").groupBy("opening").agg(F.count_distinct("prompt").alias("prompts"), F.sum(F.col("asked").cast("int")).alias("asked"), F.count("*").alias("n"), F.sum(F.col("broken").cast("int")).alias("broken"), F.sum(F.coalesce(F.col("foreign"), F.lit(False)).cast("int")).alias("foreign"))
    seen = cut(seen, "p4-openings")
    clustered = cut(minhash_clusters(seen), "p4-clusters")
    clusters = seen.join(clustered, "opening").groupBy("cluster").agg(F.sum("prompts").alias("prompts"), F.sum("asked").alias("asked"), F.sum("n").alias("n"), F.sum("broken").alias("broken"), F.sum("foreign").alias("foreign"), F.max(F.col("opening").rlike(REFUSES)).alias("refuses"))
    unnamed = F.col("asked") <= NAMED * F.col("n")
    recurs = (F.col("prompts") >= RECURS) & (F.col("broken") * 2 <= F.col("n")) & (F.col("foreign") * 2 <= F.col("n")) & (F.size(F.split("cluster", " ")) >= SHINGLE)
    refusals = clusters.where(F.col("refuses") & (F.col("asked") * 2 <= F.col("n")) | unnamed & recurs).select("cluster").join(clustered, "cluster").select("opening", F.lit(True).alias("refusal"))
    # steps that broke off: a proper beginning of a template that is far more frequent
    steps = rest.select("prompt", F.posexplode("steps").alias("i", "step"), F.size("steps").alias("of")).groupBy("step").agg(F.count("*").alias("n"), F.count_if(F.expr("i < of - 1")).alias("inner"))
    steps = cut(steps, "p4-steps")
    lasting = cut_short(steps.where("inner * 20 < n"), steps.where(F.col("n") >= MORE)).withColumn("short", F.lit(True))
    # options that never end a command, beginnings of frequent options, and rare ones that stand nowhere but at an end
    use = rest.select(F.explode("options").alias("opt"), F.lit(0).alias("end")).unionByName(rest.where("option IS NOT NULL").select(F.col("option").alias("opt"), F.lit(1).alias("end"))).groupBy("opt").agg((F.count("*") - F.sum("end")).alias("n"), F.sum("end").alias("ends"))
    longer = use.where(F.col("n") >= MORE).select(F.col("opt").alias("whole"), F.col("n").alias("more"), F.explode(F.expr("transform(sequence(1, length(opt) - 1), i -> substr(opt, 1, i))")).alias("begin")).groupBy("begin").agg(F.max("more").alias("more"))
    total = rest.agg(F.count("*").alias("total"))
    bad = use.crossJoin(F.broadcast(total)).join(longer, F.col("opt") == F.col("begin"), "left").where((F.col("ends") > 0) & ((F.col("ends") * 20 < F.col("n")) & (F.col("n") >= MORE) | (F.col("more") >= MORE * F.col("n")) | (F.col("ends") == F.col("n")) & (F.col("n") < F.greatest(F.lit(MORE), F.col("total") * SELDOM)))).select(F.col("opt").alias("option"), F.lit(True).alias("hanging"))
    judged = rest.withColumn("step", F.element_at("steps", -1)).join(refusals, "opening", "left").join(lasting, "step", "left").join(bad, "option", "left")
    label = F.when(F.col("refusal"), "refusal").when(F.col("foreign") & F.col("residue").isNull(), "language").when(F.col("broken") | F.coalesce("short", F.lit(False)) | F.coalesce("hanging", F.lit(False)), "truncated")
    found = base.where("kind IS NOT NULL").select("id", F.col("kind").alias("defect")).unionByName(judged.select("id", label.alias("defect")).where("defect IS NOT NULL"))
    return found.withColumnRenamed("id", id_column)
