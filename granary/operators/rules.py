"""Substitution rules: grammar, best match in SQL terms, expansion to a fixpoint.

    rule    := ["$" namespace "#"] pattern ":" pattern        for description and code; a literal colon is \\:
    pattern := "" (anything) | "[a, b]" (in this order) | text | alternatives separated by "|"

The match of highest priority wins, of equal ones the earlier rule. What a substitution wrote is never matched again.
A list pattern also matches at the first character, and its parts don't overlap.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: Priorities of the kinds of pattern, and of a rule for one namespace.
ANY, EXACT, LIST, NAMED = 0, 3, 4, 16


@dataclass(frozen=True)
class Pattern:
    kind: str
    parts: tuple[str, ...]

    @property
    def priority(self) -> int:
        return {"any": ANY, "exact": EXACT, "list": LIST}[self.kind]


@dataclass(frozen=True)
class Rule:
    source: str
    ordinal: int
    namespace: str | None
    description: tuple[Pattern, ...]
    code: tuple[Pattern, ...]
    values: tuple[tuple[str, str], ...]


def parse_pattern(text: str) -> tuple[Pattern, ...]:
    text = text.strip()
    if "|" in text:
        return tuple(p for alternative in text.split("|") for p in parse_pattern(alternative))
    if text.startswith("[") != text.endswith("]"):
        raise ValueError(f"unbalanced brackets in {text!r}")
    if text.startswith("["):
        return (Pattern("list", tuple(x.strip() for x in text[1:-1].split(","))),)
    return (Pattern("exact", (text,)) if text else Pattern("any", ()),)


def parse_rule(source: str, values: list[dict], ordinal: int = 0) -> Rule:
    body, namespace = source.strip(), None
    if body.startswith("$"):
        head, mark, rest = body[1:].partition("#")
        if not mark or "#" in rest:
            raise ValueError(f"a namespace needs one # in {source!r}")
        namespace, body = head.strip(), rest
    sides = [x.replace("\x00", ":").strip() for x in body.replace("\\:", "\x00").split(":")]
    if len(sides) != 2:
        raise ValueError(f"{'no separator' if len(sides) < 2 else 'too many separators'} in {source!r}")
    description, code = map(parse_pattern, sides)
    pairs = tuple((v["d-sub"], v["c-sub"]) for v in values)
    free = [any(p.kind == "any" for p in side) for side in (description, code)]
    for i, (side, name) in enumerate(((description, "description"), (code, "code"))):
        if not (len(side) == 1 and side[0].kind == "any") and any(not p[i].strip() for p in pairs):
            raise ValueError(f"empty {name} substitution in {source!r}")
    if all(free):
        raise ValueError(f"both sides of {source!r} match anything")
    return Rule(source, ordinal, namespace, description, code, pairs)


def parse_rules(rule_set: dict[str, list[dict]]) -> list[Rule]:
    return [parse_rule(source, values, i) for i, (source, values) in enumerate(rule_set.items())]


def rules_table(spark, rules: list[Rule]) -> DataFrame:
    """One row for each rule and pair of alternatives, with its priority."""
    rows = [(r.ordinal, r.source, r.namespace, d.kind, list(d.parts), c.kind, list(c.parts), d.priority + c.priority + (NAMED if r.namespace is not None else 0)) for r in rules for d in r.description for c in r.code]
    return spark.createDataFrame(rows, "ordinal int, source string, namespace string, d_kind string, d_parts array<string>, c_kind string, c_parts array<string>, priority int")


def _found(text: str, parts: str):
    """Whether a text has the parts in this order, without overlap. Exact patterns have one part, patterns for anything none."""
    return F.expr(f"aggregate({parts}, 1, (at, p) -> CASE WHEN at > 0 AND locate(p, {text}, at) > 0 THEN locate(p, {text}, at) + length(p) ELSE 0 END) > 0")


def best_rule(df: DataFrame, rules: DataFrame, id_column: str, description: str, code: str, namespace: str) -> DataFrame:
    """id, ordinal, source, priority: the best matching rule of each row. The rules are parsed on the driver: a bounded list, broadcast."""
    rows = df.select(F.col(id_column).alias("id"), F.col(description).alias("__d"), F.col(code).alias("__c"), F.col(namespace).alias("__n"))
    on = (F.col("namespace").isNull() | (F.col("namespace") == F.col("__n"))) & _found("__d", "d_parts") & _found("__c", "c_parts")
    matched = rows.join(F.broadcast(rules), on)
    best = F.max_by(F.struct("ordinal", "source", "priority"), F.struct(F.col("priority"), -F.col("ordinal")))
    return matched.groupBy("id").agg(best.alias("x")).select("id", "x.*")


class Masked:
    """A text whose written segments can't be matched: a list of (text, written)."""

    def __init__(self, text: str):
        self.parts: list[tuple[str, bool]] = [(text, False)]

    def find(self, pattern: Pattern) -> list[tuple[int, int, int]] | None:
        """Place of each part of a pattern: segment, start, length; None if it doesn't match."""
        places, seg, at = [], 0, 0
        for part in pattern.parts:
            while seg < len(self.parts):
                text, written = self.parts[seg]
                hit = -1 if written else text.find(part, at)
                if hit >= 0:
                    places.append((seg, hit, len(part)))
                    at = hit + len(part)
                    break
                seg, at = seg + 1, 0
            else:
                return None
        return places

    def write(self, places: list[tuple[int, int, int]], values: list[str]) -> None:
        for (seg, at, n), value in reversed(list(zip(places, values))):
            text, _ = self.parts[seg]
            self.parts[seg : seg + 1] = [x for x in ((text[:at], False), (value, True), (text[at + n :], False)) if x[0] or x[1]]

    def __str__(self) -> str:
        return "".join(t for t, _ in self.parts)


def expand(rules: list[Rule], description: str, code: str, namespace: str | None, seed: str) -> tuple[str, str]:
    """Both texts after all substitutions. The choice among a rule's values is made by a hash of the seed and the step."""
    d, c, step = Masked(description), Masked(code), 0
    live = [r for r in rules if r.namespace is None or r.namespace == namespace]
    while True:
        matches = []
        for r in live:
            sides = [max(((p.priority, p, f) for p in side if (f := text.find(p)) is not None), key=lambda m: m[0], default=None) for side, text in ((r.description, d), (r.code, c))]
            if all(sides) and r.values:
                matches.append((sides[0][0] + sides[1][0] + (NAMED if r.namespace is not None else 0), r, sides))
        if not matches:
            return str(d), str(c)
        live = [m[1] for m in matches]
        _, rule, sides = max(matches, key=lambda m: m[0])
        step += 1
        pick = int(hashlib.md5(f"{seed}|{step}".encode()).hexdigest()[:8], 16) % len(rule.values)
        for (_, pattern, places), text, value in zip(sides, (d, c), rule.values[pick]):
            if pattern.kind == "list":
                text.write(places, [v.strip() for v in value.strip()[1:-1].split(",")])
            elif pattern.kind == "exact":
                text.write(places, [value])


def expand_table(df: DataFrame, rules: list[Rule], id_column: str, description: str, code: str, namespace: str, copies: int = 1) -> DataFrame:
    """id, copy, objective, command: each row expanded `copies` times with choices of its own."""
    rows = df.select(F.col(id_column).alias("id"), F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy"), F.col(description).alias("d"), F.col(code).alias("c"), F.col(namespace).alias("n"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = [expand(rules, r.d or "", r.c or "", r.n, f"{r.id}|{r.copy}") for r in pdf.itertuples(index=False)]
            yield pd.DataFrame({"id": pdf["id"], "copy": pdf["copy"], "objective": [x[0] for x in done], "command": [x[1] for x in done]})

    return rows.mapInPandas(run, f"id {dict(df.dtypes)[id_column]}, copy int, objective string, command string")


def expand_until(df: DataFrame, rules: list[Rule], size: int, key: list[str], rounds: int = 6, **columns: str) -> DataFrame:
    """Distinct expansions, of doubling numbers of copies, until there are `size` or `rounds` are over; at most `size` rows remain."""
    from granary.operators.dedupe import first_wins

    copies = 4
    for _ in range(rounds):
        out = first_wins(expand_table(df, rules, copies=copies, **columns).withColumn("order", F.struct("copy", "id")), key, "order")
        if out.count() >= size:
            break
        copies *= 2
    return out.orderBy("order").limit(size).drop("order")
