"""Extraction from documentation pages: commands with description, syntax, flag table and examples, on the standard HTML parser."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from granary.session import spread

_LINK = re.compile(r"\[http.*\]")
_KEEP = {"h1", "p", "code", "td", "tr", "table", "hr", "pre", "blockquote"}


class _Blocks(HTMLParser):
    """Linear list of (tag, id, text) of the blocks that matter; h2 counts as h1."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[list] = []
        self.open: list[list] = []

    def handle_starttag(self, tag, attrs):
        tag = "h1" if tag == "h2" else tag
        if tag in _KEEP:
            block = [tag, dict(attrs).get("id"), ""]
            self.blocks.append(block)
            if tag != "hr":
                self.open.append(block)

    def handle_endtag(self, tag):
        tag = "h1" if tag == "h2" else tag
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        for block in self.open:
            block[2] += data


def parse_page(html: str | None) -> list[dict]:
    """A dictionary for each h1 section with examples: command_name, description, syntax, flags, examples. What precedes the first rule is dropped, if there is one."""
    parser = _Blocks()
    parser.feed(html or "")
    blocks = parser.blocks
    first = next((i for i, b in enumerate(blocks) if b[0] == "hr"), -1)
    out: list[dict] = []
    section: dict | None = None
    part = ""
    texts: list[str] = []
    for tag, ident, text in blocks[first + 1 :]:
        text = text.strip()
        if tag == "h1" and ident in ("usage", "flags", "examples"):
            part, texts = ident, []
        elif tag == "h1":
            section = {"command_name": text, "description": [], "syntax": None, "flags": [], "examples": []}
            out.append(section)
            part, texts, cells = "", [], []
        elif section is None:
            continue
        elif tag == "p" and part == "":
            section["description"].append(_LINK.sub("", text).strip())
        elif tag == "p" and part == "examples":
            texts.append(text)
        elif tag == "code" and part == "usage":
            section["syntax"] = text[2:] if text.startswith("$ ") else text
        elif tag == "code" and part == "examples":
            if texts:
                section["examples"].append({"description": texts.pop(0), "code": text})
        elif tag == "tr" and part == "flags":
            cells = []
            section["flags"].append(cells)
        elif tag == "td" and part == "flags":
            cells.append(_LINK.sub("", text).strip())
    for s in out:
        s["description"] = "\n".join(s["description"])
        s["flags"] = [dict(zip(("option", "short", "default_value", "description"), (c[0], c[1] or None, c[2] or None, c[3]))) for c in s["flags"] if len(c) == 4]
    return [s for s in out if s["examples"]]


def parse_pages(df: DataFrame, id_column: str, html: str) -> DataFrame:
    """id, command_name, description, syntax, flags, objective, command: one row for each example."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(r.id, s["command_name"], s["description"], s["syntax"], s["flags"], e["description"], e["code"]) for r in pdf.itertuples(index=False) for s in parse_page(r.html) for e in s["examples"]]
            yield pd.DataFrame(rows, columns=["id", "command_name", "description", "syntax", "flags", "objective", "command"])

    return spread(df.select(F.col(id_column).alias("id"), F.col(html).alias("html"))).mapInPandas(run, f"id {dict(df.dtypes)[id_column]}, command_name string, description string, syntax string, flags array<struct<option: string, short: string, default_value: string, description: string>>, objective string, command string")


def escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def entry_page(objective: Column, command_name: Column, command: Column, description: Column, syntax: Column, flags: Column) -> Column:
    """A documentation page of an entry, the inverse of parse_pages."""
    text = lambda c: escape(F.coalesce(c, F.lit("")))
    rows = F.array_join(F.transform(F.coalesce(flags, F.array().cast("array<struct<option: string, short: string, default_value: string, description: string>>")), lambda f: F.concat(F.lit("<tr><td>"), text(f["option"]), F.lit("</td><td>"), text(f["short"]), F.lit("</td><td>"), text(f["default_value"]), F.lit("</td><td>"), text(f["description"]), F.lit("</td></tr>"))), "")
    return F.concat(F.lit("<p>Top</p><hr><h1>"), text(command_name), F.lit("</h1><p>"), text(description), F.lit("</p><h2 id='usage'>Usage</h2><pre><code>$ "), text(syntax), F.lit("</code></pre><h2 id='flags'>Flags</h2><table>"), rows, F.lit("</table><h2 id='examples'>Examples</h2><p>"), text(objective), F.lit("</p><pre><code>"), text(command), F.lit("</code></pre>"))


def titles(c: Column) -> Column:
    """Texts of h1 and h2 elements without nested tags."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"(?is)<h[12][^>]*>(.*?)</h[12]>"), F.lit(1)), lambda x: F.trim(F.regexp_replace(x, "<[^>]+>", "")))
