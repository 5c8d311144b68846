"""Column -> Column text functions. All stay in the JVM. `(?mdU)` gives lines, spaces and digits their Unicode meaning with \\n as the only line end."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Phrases at which reasoning turns to asides.
RED_FLAGS = ["by default", "default value", "do not use", "does not specify", "if necessary", "command doesn't specify", "default is", "defaults for", "the default", "default behavior", "other possible", "optional flags", "command does not", "other flags"]
#: Character replacements of book text, in order. The en dash and the ellipsis have the replacements that existing data was built with.
UNICODE_MAP = [("‐\n", ""), ("‐", "-"), ("•", " - "), ("—", "-"), ("’", "'"), ("“", '"'), ("”", '"'), ("↔", "<=>"), ("–", "<=>"), ("×", "*"), ("š", "s"), ("…", "s")]


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def tokens(c: Column) -> Column:
    """Words of a command line: split at commas, equal signs and white space; no empty ones."""
    return F.filter(F.split(c, r"\s*[,=]\s*|\s+"), lambda w: w != "")


def context(c: Column) -> Column:
    return F.regexp_replace(c, "^kubectl ", "")


def first_statement(c: Column, limit: int = 128) -> Column:
    """Texts of `limit` characters or more end at their first `. ` or line end."""
    dot, nl = F.locate(". ", c), F.locate("\n", c)
    n = F.length(c) + 1
    cut = F.least(F.when(dot > 0, dot).otherwise(n), F.when(nl > 0, nl).otherwise(n))
    return F.when(F.length(c) < limit, c).otherwise(c.substr(F.lit(1), cut - 1))


def lines(c: Column) -> Column:
    return F.split(c, "\n")


def let(value: Column, fn) -> Column:
    """fn of a value that is computed once: a lambda's variable isn't inlined as a column is."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def first_paragraph(c: Column) -> Column:
    """Stripped lines up to the first blank one, leading blank ones skipped. A text of blanks gives an empty text."""
    stripped = F.regexp_replace(F.regexp_replace(c, r"(?md)^[^\S\n]+|[^\S\n]+$", ""), r"^\n+|\n+\z", "")
    return F.substring_index(stripped, "\n\n", 1)


def list_shaped(c: Column) -> Column:
    """The second word of every line begins with a letter; lines of fewer words don't pass."""
    return F.forall(lines(c), lambda x: strip(x).rlike(r"^\S+\s+\p{L}"))


def red_flag_cut(c: Column) -> Column:
    """Whole lines before the first red flag after line 3; a second or third flag before line 6 moves the cut there."""
    flags = F.array(*map(F.lit, RED_FLAGS))

    def cut(text: Column, marks: Column) -> Column:
        second, third = F.get(marks, F.lit(1)), F.get(marks, F.lit(2))
        at = F.when(third["line"] < 6, third["p"]).when(second["line"] < 6, second["p"]).otherwise(F.get(marks, F.lit(0))["p"])
        return F.when(F.size(marks) == 0, text).otherwise(whole_lines(text.substr(F.lit(1), at - 1)))

    def marked(text: Column) -> Column:
        places = let(F.lower(text), lambda low: F.filter(F.transform(flags, lambda f: F.position(f, low)), lambda p: p > 0))
        lined = F.transform(places, lambda p: F.struct(p.alias("p"), (F.size(F.split(text.substr(F.lit(1), p - 1), "\n"))).alias("line")))
        return let(F.array_sort(F.filter(lined, lambda m: m["line"] > 3)), lambda marks: cut(text, marks))

    return let(c, marked)


def whole_lines(c: Column) -> Column:
    """All lines but the last, stripped."""
    return strip(F.regexp_replace(c, r"(^|\n)[^\n]*\z", ""))


def cap_lines(c: Column, limit: int = 500) -> Column:
    """Whole lines within the first `limit` characters."""
    return F.when(F.length(c) > limit, whole_lines(c.substr(1, limit))).otherwise(strip(c))


def map_unicode(c: Column) -> Column:
    for a, b in UNICODE_MAP:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def drop_running_headers(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"(?md)^.* \| [0-9]+$\n", ""), r"(?md)^[0-9]+ \| .*$\n", "")


def drop_figures(c: Column) -> Column:
    return F.regexp_replace(c, r"(?md)^Figure [0-9]+-[0-9]+\..*$", "")


def drop_page_numbers(c: Column) -> Column:
    return F.regexp_replace(c, r"(?md)^\s*[0-9]+\s*$", "")


def single_spaces(c: Column) -> Column:
    return F.regexp_replace(strip(c), " +", " ")


def rstrip_lines(c: Column) -> Column:
    return F.regexp_replace(c, r"(?md)[^\S\n]+$", "")


def reflow(c: Column) -> Column:
    """A line end between a word or closing mark and a word or opening mark becomes a space. One pass suffices: a space is neither."""
    return F.regexp_replace(strip(c), r"(?<=[\p{L}\p{N}.,?!):])\n(?=[\p{L}\p{N}.,?!(-])", " ")


def repair_hyphen_items(c: Column) -> Column:
    """An isolated hyphen at a line end becomes a space together with the line end."""
    return F.regexp_replace(c, r" -(?:\n.?\n|\n|(.)\n)", "  $1")


#: Pieces of a text: an aside in brackets, a clause with its quoted title and the marks that end it, or any other character.
_PIECE = r'\([^()\n]*\)|[^.:;?!,\n("]*"[^"\n]*"[.:;?!,]*|[^.:;?!,\n("]+[.:;?!,]*|[\s\S]'


def drop_chapter_references(c: Column) -> Column:
    """The text without the clauses and asides that point to a numbered chapter.

    The pieces are read in order. A piece with a reference goes, and a quoted title right after it; if it followed a comma,
    that comma gives way to the mark that ended the piece; blanks before it go too.
    """
    def read(state: Column, piece: Column) -> Column:
        text, gone = state["text"], state["gone"]
        body = F.regexp_replace(piece, "[.:;?!,]+$", "")
        points = piece.rlike(r"Chapter\s+[0-9]") | (gone & F.trim(body).rlike('^"[^"]*"$'))
        ends = F.substring(piece, F.length(body) + 1, 8)
        closed = F.when(F.endswith(text, F.lit(",")) & ~F.startswith(piece, F.lit("(")), F.concat(F.substring(text, F.lit(1), F.length(text) - 1), ends)).otherwise(F.rtrim(text))
        return F.struct(F.when(points, closed).otherwise(F.concat(text, piece)).alias("text"), points.alias("gone"))

    start = F.struct(F.lit("").alias("text"), F.lit(False).alias("gone"))
    return F.when(~c.rlike(r"Chapter\s+[0-9]"), c).otherwise(F.aggregate(F.regexp_extract_all(c, F.lit(_PIECE), F.lit(0)), start, read, lambda state: state["text"]))


def paragraphs(c: Column) -> Column:
    """Pieces between `.\\n`, each with its full stop again."""
    return F.transform(F.split(c, r"\.\n"), lambda x: F.concat(x, F.lit(".")))


def markdown(c: Column) -> Column:
    """Leading # escaped, lines of hyphens as underscores, lines joined with hard breaks."""
    fixed = F.transform(lines(c), lambda x: F.when(x.rlike("^-*$"), F.regexp_replace(x, "-", "_")).otherwise(F.regexp_replace(x, "^( *)#", "$1\\\\#")))
    return F.array_join(fixed, "  \n")


def answer(c: Column, prompt_length: Column, start: str = "### Answer:", command: str = "# Command:", end: str = "#End") -> Column:
    """The text after the command mark, else the answer mark, else the prompt, up to the end mark."""
    after = lambda mark: F.when(F.instr(c, mark) > 0, F.instr(c, mark) + len(mark))
    begin = F.coalesce(after(command), after(start), prompt_length + 1)
    stop = F.when(F.instr(c, end) > 0, F.instr(c, end)).otherwise(F.length(c) + 1)
    return strip(c.substr(begin, F.greatest(stop - begin, F.lit(0))))


def snippet(c: Column) -> Column:
    """A search result without what precedes its first em dash."""
    return strip(F.regexp_replace(c, r"^[\s\S]*?—\s*", ""))
