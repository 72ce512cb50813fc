"""Text functions: sections and code of model output, signatures, scores, prompts, clean-up for reports."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Titles of sections and what they are kept as.
TITLES = {"Problem": "Problem Statement", "Problem Statement": "Problem Statement", "Problem Description": "Problem Description", "Answer Requirements": "Answer Requirements", "Solution": "Solution", "Answer": "Answer", "Code": "Code"}
#: Sections of the older form, by letter.
LETTERED = {"A": "Problem", "B": r"Answer\s*Requirements", "C": "Solution", "D": "Answer", "E": "Code"}
#: Characters that stand raised or lowered, by their decomposition.
SUPERS, SUBS = ("".join(chr(c) for c in (*range(0xB2, 0xBA), *range(0x2070, 0x20A0)) if unicodedata.decomposition(chr(c)).startswith(kind)) for kind in ("<super>", "<sub>"))
FENCE = r"(?s)```python\s*\n(.*?)```"
PYTHON_ENV = r"(?s)\\begin\{python\}(.*?)\\end\{python\}"


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def modern(raw: Column) -> Column:
    """Headings of the older form, "A) Problem" with or without marks around, as ``\\section{Problem}``; only in text without sections."""
    known = "|".join(TITLES)
    out = raw
    for letter, title in LETTERED.items():
        heading = rf"(?md)^[#*\s]*(?:\\section\{{)?{letter}\)\s*(?:\\textbf\{{)?\s*{title}[}}*\s]*:?[ \t]*$"
        out = F.regexp_replace(out, heading, "\\\\section{" + title.replace(r"\s*", " ") + "}")
    return F.when(raw.rlike(rf"\\section\*?\{{\s*(?:{known})\s*\}}"), raw).otherwise(out)


def sections(raw: Column) -> Column:
    """map<title, content> of text in ``\\section{Title}`` form, or the older lettered one; the last of equal titles wins.

    Only known titles begin a section; other headings at the end of a line and fence lines are
    left out of the content. Text without a section is the problem statement; a null gives a null.
    """
    titles = "|".join(TITLES)
    parts = F.slice(F.split(modern(raw), rf"\\section\*?\{{(?=\s*(?:{titles})\s*\}})"), 2, 100000)
    name = F.create_map(*(F.lit(x) for pair in TITLES.items() for x in pair))

    def content(p: Column) -> Column:
        body = F.regexp_replace(p, r"(?s)^[^}]*\}[^\n]*\n?", "")
        return strip(F.regexp_replace(F.regexp_replace(body, r"(?md)\\section\{[^}]+\}\s*$", ""), r"(?md)^```\w*\s*$", ""))

    pairs = F.transform(parts, lambda p: F.struct(F.element_at(name, F.trim(F.substring_index(p, "}", 1))).alias("title"), content(p).alias("content")))
    last = F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, p: F.map_concat(F.map_filter(m, lambda k, v: k != p["title"]), F.create_map(p["title"], p["content"])))
    whole = F.create_map(F.lit("Problem Statement"), strip(raw))
    return F.when(raw.isNull(), None).when(F.size(parts) > 0, last).otherwise(whole)


def first_subsection(code: Column) -> Column:
    """Code up to the second ``\\subsection{...}``, without the first's heading; all of it without any."""
    parts = F.split(code, r"\\subsection\{[^}]+\}")
    return F.when(F.size(parts) > 1, strip(F.element_at(parts, 2))).otherwise(code)


def first_code(text: Column) -> Column:
    """Code of the first python environment, else of the first fence, '' without either."""
    env = first_env(text)
    return F.when(env != "", env).otherwise(first_fence(text))


def first_fence(text: Column) -> Column:
    """Code of the first python fence, '' without one."""
    return F.regexp_replace(F.regexp_extract(text, FENCE, 1), r"^\n+", "")


def first_env(text: Column) -> Column:
    """Code of the first python environment, without lines that are only a LaTeX command."""
    lines = F.split(F.regexp_extract(text, PYTHON_ENV, 1), "\n")
    return strip(F.array_join(F.filter(lines, lambda x: ~x.rlike(r"^\s*\\[A-Za-z]+(\{[^}]*\})*\s*$")), "\n"))


def last_code(text: Column) -> Column:
    """The last fence if there is any, else the last environment; null without either."""
    fences, envs = F.regexp_extract_all(text, F.lit(FENCE), F.lit(1)), F.regexp_extract_all(text, F.lit(PYTHON_ENV), F.lit(1))
    return F.coalesce(F.try_element_at(fences, F.lit(-1)), F.try_element_at(envs, F.lit(-1)))


def wrap_code(code: Column) -> Column:
    """Code without its fences in a python environment."""
    bare = F.regexp_replace(F.regexp_replace(code, r"```python\s*", ""), r"(?m)```\s*$", "")
    return F.concat(F.lit("\\begin{python}\n"), strip(bare), F.lit("\n\\end{python}"))


def signature(code: Column) -> Column:
    """struct(name, args array<struct(name, type)>, returns) of the first def; untyped arguments are left out; null without a def."""
    head = r"def\s+(\w+)\s*\(([^)]*)\)\s*(?:->\s*([\w.\[\], ]+?))?\s*:"
    args = F.regexp_extract(code, head, 2)
    arg = r"(\w+)\s*:\s*(?:Optional\[)?(\w+)"
    names, types = F.regexp_extract_all(args, F.lit(arg), F.lit(1)), F.regexp_extract_all(args, F.lit(arg), F.lit(2))
    returns = F.regexp_extract(code, head, 3)
    made = F.struct(
        F.regexp_extract(code, head, 1).alias("name"),
        F.zip_with(names, types, lambda n, t: F.struct(n.alias("name"), t.alias("type"))).alias("args"),
        F.when(returns == "", "None").otherwise(returns).alias("returns"),
    )
    return F.when(F.regexp_extract(code, head, 1) != "", made)


def docstring(code: Column) -> Column:
    """The first string in three double quotes, else in three single ones, '' without."""
    a, b = F.regexp_extract(code, r'(?s)"""(.*?)"""', 1), F.regexp_extract(code, r"(?s)'''(.*?)'''", 1)
    return F.when(a != "", a).otherwise(b)


#: How a docstring states the size of a tuple, of the argument's own first.
TUPLE_FORMS = (r"{name}[^.]*?(\d+)[-\s]*element[^\s]*\s*tuple", r"{name}[^.]*?tuple[^.]*?(\d+)[-\s]*element", r"tuple[^.]*?(\d+)[-\s]*element", r"(\d+)[-\s]*element[^\s]*\s*tuple")


def tuple_size(doc: Column, arg: str) -> Column:
    """The size a docstring gives for a tuple argument, null if it gives none."""
    found = [F.regexp_extract(doc, "(?i)" + p.format(name=re.escape(arg)), 1) for p in TUPLE_FORMS]
    return F.coalesce(*(F.when(x != "", x.try_cast("int")) for x in found))


def first_object(text: str | None) -> str | None:
    """The first balanced {...} of a text; braces inside JSON strings don't count."""
    if not text:
        return None
    start = text.find("{")
    while start >= 0:
        depth, quoted, skip = 0, False, False
        for at in range(start, len(text)):
            c = text[at]
            if skip:
                skip = False
            elif quoted:
                skip, quoted = c == "\\", c != '"'
            elif c == '"':
                quoted = True
            elif c == "{":
                depth += 1
            elif c == "}":
                depth -= 1
                if depth == 0:
                    return text[start : at + 1]
        start = text.find("{", start + 1)
    return None


@F.pandas_udf(StringType())
def object_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """first_object as a column function."""
    for batch in batches:
        yield batch.map(first_object)


def repaired(text: str | None) -> str | None:
    """JSON text cut after its first complete value, what is not finite in it as null; null if there is none."""
    if not text:
        return None
    odd: list[str] = []
    try:
        value, end = json.JSONDecoder(parse_constant=odd.append).raw_decode(text.lstrip())
    except (ValueError, RecursionError):
        return None
    # the constants are None in ``value`` already: append returns nothing
    return json.dumps(value, ensure_ascii=False) if odd else text.lstrip()[:end]


@F.pandas_udf(StringType())
def repaired_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.map(repaired)


def pair_hash(source: Column, problem: Column) -> Column:
    """md5 of "id:problem"; the solution takes no part. A null counts as empty."""
    return F.md5(F.concat_ws(":", F.coalesce(source, F.lit("")), F.coalesce(problem, F.lit(""))))


def numbered_list(values: Column) -> Column:
    """"1. a\n2. b" of an array."""
    return F.array_join(F.transform(values, lambda v, i: F.concat((i + 1).cast("string"), F.lit(". "), v)), "\n")


def task_instructions(low: int, high: int, dependent: bool) -> str:
    """How many tasks a problem should have, as a sentence."""
    if low == high == 1:
        return "Ask for exactly one task."
    amount = f"exactly {low}" if low == high else f"between {low} and {high}"
    return f"Ask for {amount} tasks that {'build on one another' if dependent else 'can be solved independently'}."


def prompt(template: str, **fields: Column) -> Column:
    """A template with {{NAME}} replaced by columns; null fields are empty, unknown names stay."""
    out = F.lit(template)
    for name, value in fields.items():
        out = F.replace(out, F.lit("{{" + name + "}}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def shortened(text: Column, most: int = 2000) -> Column:
    """At most ``most`` characters, with dots where something is left out (a prompt's context, never data)."""
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most)), F.lit("..."))).otherwise(text)


#: Applied in order by ``report_text``.
REPORT_RULES: Sequence[tuple[str, str]] = (
    (r"(?s)<think>.*?</think>\s*", ""), (r"\\(?:documentclass|usepackage)(?:\[[^\]]*\])?\{[^}]*\}", ""), (r"\\(?:begin|end)\{document\}", ""), (r"\*\*([^*\n]+)\*\*", r"\\textbf{$1}"), (r"(?m)^#{1,6}\s+(.*)$", r"\\paragraph{$1}"), (r"\\\(\s*(.*?)\s*\\\)", r"\$$1\$"),
)


def report_text(text: Column, thoughts: bool = False) -> Column:
    """Model text for a LaTeX report: document commands dropped, bold, headings and inline maths converted; thoughts dropped, or kept without their tags."""
    if thoughts:
        text = F.regexp_replace(text, r"</?think>", "")
    for pattern, new in REPORT_RULES:
        text = F.regexp_replace(text, pattern, new)
    return text


def raised(text: str) -> str:
    """Superscript and subscript characters as LaTeX: runs of them as one group."""

    def group(m: re.Match) -> str:
        kind = "^" if unicodedata.decomposition(m.group()[0]).startswith("<super>") else "_"
        return f"${kind}{{{''.join(unicodedata.normalize('NFKD', c) for c in m.group())}}}$"

    return re.sub("[" + SUPERS + "]+|[" + SUBS + "]+", group, text)


def escaped(text: str | None) -> str | None:
    """&, %, # and _ escaped outside formulas, commands' arguments and code; arrows as formulas."""
    if text is None:
        return None
    out = []
    for piece in re.split(r"(\$\$.*?\$\$|\$[^$\n]*\$|\\\[.*?\\\]|```.*?```|\\[A-Za-z]+(?:\{[^}]*\})*|\\.)", text, flags=re.DOTALL):
        if piece[:1] in ("$", "\\"):
            out.append(piece)
        elif piece.startswith("```"):
            out.append("\\begin{verbatim}\n" + re.sub(r"^```\w*\n|```$", "", piece) + "\\end{verbatim}")
        else:
            out.append(raised(re.sub(r"([&%#_])", r"\\\1", piece)).replace("→", r"$\to$").replace("≤", r"$\le$").replace("≥", r"$\ge$"))
    return "".join(out)


def wrapped(text: str | None, width: int = 85) -> str | None:
    """Every line in pieces of at most ``width`` characters."""
    if text is None:
        return None
    return "\n".join(line[k : k + width] for line in text.split("\n") for k in range(0, max(1, len(line)), width))


@F.pandas_udf(StringType())
def wrapped_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """``wrapped`` as a column function."""
    for batch in batches:
        yield batch.map(wrapped)


@F.pandas_udf(StringType())
def escaped_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.map(escaped)


def iso_time(text: Column) -> Column:
    """A timestamp of ISO text with Z, an offset or neither (then UTC); null for anything else."""
    return F.try_to_timestamp(F.regexp_replace(text, r"([+-]\d{2}):?(\d{2})$", "$1:$2"))
