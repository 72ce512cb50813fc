"""Texts cut off by a length limit or in transfer.

Intact values of the table are cut artificially to make positives; a hashed logistic
regression on closing characters, punctuation, the last line's form, open delimiters and
the distance to the source's limit is fitted to tell them from the values as they are, later
rounds without the values that the round before takes for cut. Every record is scored.
One scan learns (lengths, word counts, a bounded sample), one scores.
"""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.llm.linear import Features, Linear, Places, Sparse, fit, reach, spot
from sievework.session import cut

#: Buckets of each corpus count: a fixed size, whatever the corpus.
WORD_BUCKETS = 1 << 17
#: A length is a limit of a source if at least so many texts have just it, and no more are longer.
LIMIT_TEXTS = 4
SHORTEST_CUT = 12
LETTERS = r"[^\W\d_]"
CODE = re.compile(r"```.*?```|\\begin\{python\}.*?\\end\{python\}|<(pre|syntaxhighlight|code)\b[^>]*>.*?</\1>", re.DOTALL | re.IGNORECASE)
CODE_OPENS = re.compile(r"```|\\begin\{python\}|<(?:pre|syntaxhighlight)\b", re.IGNORECASE)
FORMULA = re.compile(r"\$\$.*?\$\$|\\\[.*?\\\]|\\begin\{(equation|align|gather)\*?\}.*?\\end\{\1\*?\}|<math>.*?</math>", re.DOTALL)
FORMULA_OPENS = re.compile(r"\$\$|\\\[|\\begin\{(?:equation|align|gather)|<math>")
INLINE = re.compile(r"\$[^$\n]*\$")
BARE = (
    re.compile(r"<!--.*?-->|<ref>.*?</ref>|\{\{citation[^{}]*\}\}|\[https?://[^\]\s]+ [^\]]*\]|!\[[^\]]*\]\([^)]*\)|</?\w+(?:\s[^<>]*)?/?>"),
    re.compile(r"\\(?:noindent|newline)\s*|\\(?:begin|end)\{\w+\}|\\[hv]space\{[^}]*\}|\\footnote\{[^{}]*\}|~?\\(?:cite|ref|label)\{[^{}]*\}|\{\\\w+\s*"),
)
LABEL = re.compile(rf"({LETTERS}+(?: {LETTERS}+)?)\s?[:：]")
CLOSED = re.compile(r"[.!?。！？∎)\]:][\"'”’»*_]*$")
NOTE = re.compile(r"(?:[\[(<][^\])>]{0,24}[\])>]?|--+)$")
END_WORD = re.compile(rf"(?:{LETTERS}|[\u0300-\u036f])+$")
WORDS = re.compile(rf"(?:{LETTERS}|[\u0300-\u036f'’-])+|\d[\d.,]*|[F$]")
NUMBER = re.compile(r"\d+(?:[.,]\d+)*")
#: Rows of the counts: words anywhere, last words of labelled last lines, whole last lines.
ANYWHERE, LABELLED, LINES = 0, 1, 2


def shape(text: str) -> str:
    """The form of a few characters: letters a/A/字, digits 0, blanks and marks as they are, runs of a and 0 as one."""
    out = ""
    for c in text:
        c = "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "字" if c.isalpha() else c
        if not (out and c == out[-1] and c in "a0字"):
            out += c
    return out


def open_parts(text: str, inline: bool = True) -> tuple[bool, bool, str]:
    """(inside a formula, inside fenced code, text with formulas as F and code as C)."""
    plain, in_code, in_formula = text, False, False
    if "```" in plain or "<" in plain or "\\begin{python}" in plain:
        plain = CODE.sub(" C ", plain)
        opened = CODE_OPENS.search(plain)
        if opened:
            in_code = True
            plain = plain[: opened.start()] + " O"
    if "$$" in plain or "\\[" in plain or "\\begin{" in plain or "<math>" in plain:
        plain = FORMULA.sub("F", plain)
        in_formula = FORMULA_OPENS.search(plain) is not None
    last = plain.rsplit("\n", 1)[-1]
    in_formula = in_formula or last.count("$") % 2 == 1
    return in_formula, in_code, INLINE.sub("F", plain) if inline and "$" in plain else plain


def bare(line: str) -> str:
    """A line without the markup that may stand around it: tags, notes, emphasis, braces."""
    if "<" in line or "[" in line or "{" in line or "\\" in line:
        for pattern in BARE:
            line = pattern.sub("", line)
    if "&" in line:
        line = html.unescape(line)
    return line.lstrip(" \t\r*_'>#|").rstrip(" \t\r*_'|}\\")


def last_line(plain: str) -> tuple[str, str, str | None]:
    """(last line with content as it is, without markup, its label if it has one); formulas as F."""
    raw = last = ""
    end = len(plain)
    while end >= 0 and not last:
        start = plain.rfind("\n", 0, end) + 1
        raw = plain[start:end]
        last = bare(INLINE.sub("F", raw) if "$" in raw else raw)
        end = start - 1
    label = LABEL.match(last)
    return raw, last, label.group(1).lower() if label else None


def line_key(last: str) -> str:
    return NUMBER.sub("0", last.lower())


def features(text: str, limits: tuple[int | None, int | None], counts: np.ndarray) -> Features:
    """Features of one non-empty text; ``limits`` are its source's in characters and in words."""
    stripped = text.rstrip()
    in_formula, in_code, plain = open_parts(stripped, False)
    raw, last, label = last_line(plain)
    closed = int(CLOSED.search(last) is not None and not last.endswith(("...", "…")))
    note = NOTE.search(last)
    kind = "label" if label else "prose"
    ends = "F" if last.endswith("F") else "C" if last.endswith("C") else "item" if raw.lstrip().startswith("- ") else "text"
    out: Features = {
        "end1=" + stripped[-1:]: 1.0,
        "bare1=" + last[-1:]: 1.0,
        "bare4=" + shape(last[-8:])[-4:]: 1.0,
        "note=" + (re.sub(r"\d+", "0", note.group().lower()) if note else ""): 1.0,
        f"label={label}": 1.0,
        f"{kind}/{closed}/{ends}": 1.0,
    }
    for name, holds in (("formula", in_formula), ("code", in_code), ("closed", closed), ("ends_blank", text[-1:].isspace()), ("dots", last.endswith(("...", "…", "\ufffd"))), ("note", note)):
        if holds:
            out[name] = 1.0
    body = last[len(label) + 1 :].strip() if label else last
    words = WORDS.findall(body)
    if len(words) <= 1:
        out["few_words"] = 1.0
    for k, word in enumerate(reversed(words[-2:])):
        out[f"{kind}{closed}w{k}=" + (shape(word) if word[:1].isdigit() else word.lower())] = 1.0
    end_word = END_WORD.search(last[-80:])
    if end_word:
        word = end_word.group().lower()
        out[f"{kind}/seen=" + grade(counts[ANYWHERE, bucket(word)])] = 1.0
        if len(word) <= 2:
            out["short_last"] = 1.0
        if label:
            out["label/ended=" + grade(counts[LABELLED, bucket(label + " " + word)])] = 1.0
    out[f"same_line={closed}" + grade(counts[LINES, bucket(line_key(last))] - 1)] = 1.0
    if (limits[0] and len(text) >= limits[0]) or (limits[1] and len(text.split()) >= limits[1]):
        out["at_limit"] = 2.0
        out[f"at_limit/{kind}/{closed}/{ends}"] = 2.0
    return out


def grade(n: float) -> str:
    """0, 1, 2, 4, 8, ... as small steps."""
    return str(min(8, int(max(n, 0) + 1).bit_length() - 1))


def bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) & (WORD_BUCKETS - 1)


def slices(sizes: np.ndarray, rows: int = 2000, most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of at most so many rows and characters (a longer text comes alone): what is worked on at once stays small."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        full = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, "right"))
        stop = min(max(full, start + 1), start + rows)
        yield start, stop
        start = stop


def count_batch(texts: pa.Array, total: np.ndarray) -> None:
    """Adds a batch of texts to ``total`` (3 x WORD_BUCKETS). A text's last word is not counted: it may be cut."""
    strings = [t for t in texts.to_pylist() if t and t.strip()]
    if not strings:
        return
    body = pa.array([t.rstrip()[: -len(m.group())] if (m := END_WORD.search(t.rstrip()[-80:])) else t for t in strings], pa.large_string())
    split = pc.split_pattern_regex(pc.utf8_lower(body), r"[^\p{L}\p{M}]+")
    for pair in pc.value_counts(pc.list_flatten(split)).to_pylist():
        if pair["values"]:
            total[ANYWHERE, bucket(pair["values"])] += pair["counts"]
    for text in strings:
        _, last, label = last_line(open_parts(text.rstrip(), False)[2])
        total[LINES, bucket(line_key(last))] += 1
        end = END_WORD.search(last[-80:])
        if label and end:
            total[LABELLED, bucket(label + " " + end.group().lower())] += 1


@dataclass
class Learned:
    """What one scan of a table gives: a bounded sample, limits by source, word counts of fixed size."""

    rows: list[tuple[str, str, str | None]]
    limits: dict[str, tuple[int | None, int | None]]
    counts: np.ndarray


COUNT, LENGTH, SAMPLED = 0, 1, 2


def learn(texts: DataFrame, sample_rows: int) -> Learned:
    """From (id, source, text, more), rows with text only: (source, text, more) of at most ``sample_rows`` rows, limits and counts of all.

    A task sends 3 x WORD_BUCKETS numbers at most, its (source, length) counts and its part of the sample.
    """
    least = reach(texts, sample_rows)

    def run(batches):
        total, lengths = np.zeros((3, WORD_BUCKETS), np.int64), {}
        for batch in batches:
            for a, b in slices(pc.utf8_length(batch.column("text")).to_numpy(zero_copy_only=False), batch.num_rows):
                count_batch(batch.column("text").slice(a, b - a), total)
            kept = []
            for k, (source, text, place) in enumerate(zip(batch.column("source").to_pylist(), batch.column("text").to_pylist(), batch.column("spot").to_pylist())):
                for unit, size in ((0, len(text)), (1, len(text.split()))):
                    lengths[source, unit, size] = lengths.get((source, unit, size), 0) + 1
                if place < least:
                    kept.append(k)
            if kept:
                some = batch.take(pa.array(kept))
                yield rows(SAMPLED, some.column("spot"), some.column("source"), some.column("id"), pa.array([1] * len(kept)), some.column("text"), some.column("more"))
        flat = total.reshape(-1)
        there = np.flatnonzero(flat)
        none = pa.nulls(len(there), pa.string())
        yield rows(COUNT, pa.array(there), none, pa.nulls(len(there), pa.int64()), pa.array(flat[there]), none, none)
        none = pa.nulls(len(lengths), pa.string())
        yield rows(LENGTH, pa.array([k[2] for k in lengths], pa.int64()), pa.array([k[0] for k in lengths], pa.string()), pa.array([k[1] for k in lengths], pa.int64()), pa.array(list(lengths.values()), pa.int64()), none, none)

    def rows(kind, key, source, unit, n, text, more):
        return pa.RecordBatch.from_arrays([pa.array([kind] * len(key), pa.int8()), key.cast(pa.int64()), source.cast(pa.string()), unit.cast(pa.int64()), n.cast(pa.int64()), text.cast(pa.string()), more.cast(pa.string())], names=["kind", "key", "source", "unit", "n", "text", "more"])

    scanned = texts.withColumn("spot", spot("id")).mapInArrow(run, "kind tinyint, key bigint, source string, unit bigint, n bigint, text string, more string")
    held = cut(scanned.groupBy("kind", "key", "source", "unit", "text", "more").agg(F.sum("n").alias("n")))
    sums = held.where(F.col("kind") == COUNT).select("key", "n").toArrow()
    counts = np.zeros(3 * WORD_BUCKETS, np.int64)
    counts[sums.column("key").to_numpy()] = sums.column("n").to_numpy()
    chosen = sorted(((r["key"], r["unit"], r["source"], r["text"], r["more"]) for r in held.where(F.col("kind") == SAMPLED).collect()), key=lambda r: r[:2])
    return Learned([r[2:] for r in chosen[:sample_rows]], limits_of(held.where(F.col("kind") == LENGTH)), counts.reshape(3, WORD_BUCKETS))


def limits_of(lengths: DataFrame) -> dict[str, tuple[int | None, int | None]]:
    """source -> (limit in characters, limit in words), from counts of all lengths; a row per source and unit comes to the driver.

    A limit is the greatest length that LIMIT_TEXTS texts have and no more texts exceed:
    lengths that no limit shapes are spread out, and single longer texts hide none.
    """
    longer = F.coalesce(F.sum("n").over(Window.partitionBy("source", "unit").orderBy(F.desc("key")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    good = lengths.withColumn("longer", longer).where((F.col("n") >= LIMIT_TEXTS) & (F.col("longer") <= F.col("n")))
    out: dict[str, list[int | None]] = {}
    for row in good.groupBy("source", "unit").agg(F.max("key").alias("size")).collect():
        out.setdefault(row["source"], [None, None])[row["unit"]] = row["size"]
    return {s: (a, b) for s, (a, b) in out.items()}


def cut_sign(draw: random.Random) -> str:
    """What may follow a cut: nothing, dots, a broken character, dashes, or a bracketed note, whole or cut itself."""
    kind = draw.random()
    if kind < 0.3:
        return ""
    if kind < 0.65:
        return draw.choice(("", " ")) + draw.choice(("…", "...", "\ufffd", "--", "—"))
    words = draw.choice(("", "", "text ", "output ", "response ", "message ")) + draw.choice(("cut", "cut off", "truncated", "continued", "cont", "cont.", "incomplete", "end", "eos", "eot", "limit reached", "more"))
    opens, closes = draw.choice(("[]", "()", "<>", "[]", "()"))
    return draw.choice((" ", " ", "", "\n")) + opens + draw.choice((words, words.capitalize(), words.upper())) + draw.choice((closes, closes, "", "..." + closes))


def cut_somewhere(text: str, limits: tuple[int | None, int | None], draw: random.Random) -> str | None:
    """An intact text, cut inside a word, sentence or formula, perhaps with a sign; None if too short."""
    at_limit = limits[0] or limits[1]
    if len(text) < 2 * SHORTEST_CUT:
        return None
    for _ in range(12):
        if limits[1] and draw.random() < 0.5:
            words = list(re.finditer(r"\S+", text))
            part = text[: words[draw.randrange(len(words) // 3, len(words))].end()]
        else:
            low = SHORTEST_CUT if draw.random() < 0.3 else len(text) // 3
            if draw.random() < 0.3:
                low = max(low, len(text) - 60)
            part = text[: draw.randrange(min(low, len(text) - 2), len(text) - 1)]
        rest = text[len(part) :]
        inside, in_code, _ = open_parts(part)
        if not rest.strip() or (not inside and not in_code and re.search(r"[.!?。:∎)]\s*$|\n\s*$|F$", part)) or re.match(r"\s*\n", rest):
            continue
        if re.fullmatch(r"(?:[\s*_'}|\\]|</?\w+>|<!--.*?-->|[.。)])*", rest):
            continue
        sign = cut_sign(draw)
        if sign == "…" or sign.startswith(" ") or not at_limit:
            part = part.rstrip() if draw.random() < 0.5 else part
        return part + sign
    return None


def train(rows: list[tuple[str, str]], limits: dict, counts: np.ndarray, seed: int = 3) -> Linear:
    """Three rounds on (source, text), features made once.

    At first all values below their source's limits count as intact; each later round
    leaves out those, with what was made of them, that the round before takes for cut.
    """
    draw, places = random.Random(seed), Places()
    limit = lambda source: limits.get(source, (None, None))
    below = [(s, t) for s, t in rows if not (limit(s)[0] and len(t) >= limit(s)[0] or limit(s)[1] and len(t.split()) >= limit(s)[1])]
    made: list[Features] = []
    truth: list[float] = []
    owner: list[int] = []
    for k, (source, text) in enumerate(below):
        own = limit(source)
        as_limit = lambda t: (len(t) if own[0] and draw.random() < 0.5 else own[0], len(t.split()) if own[1] and draw.random() < 0.5 else own[1])  # noqa: E731,B023
        parts = [p for p in (cut_somewhere(text, own, draw) for _ in range(2)) if p]
        # where the source has a limit, half of the cuts count as made by it
        made += [features(text, own if draw.random() < 0.97 else as_limit(text), counts), *(features(p, as_limit(p), counts) for p in parts)]
        truth += [0.0, *(1.0 for _ in parts)]
        owner += [k] * (1 + len(parts))
    packed, truth_, owner_ = Sparse.of(made, places), np.array(truth), np.array(owner)
    whole = packed.take(np.flatnonzero(truth_ == 0))
    kept = np.ones(len(below), bool)
    for last in (False, False, True):
        some = np.flatnonzero(kept[owner_])
        model = fit(packed.take(some), truth_[some], epochs=6 if last else 3, seed=seed)
        sound = model.scores(whole) < 0.4
        kept = sound if sound.any() else np.ones(len(below), bool)
    return model


def score(df: DataFrame, id_col: str, text_col: str, source_col: str, sample_rows: int = 2500) -> DataFrame:
    """(id, source, p_cut, cut) of every row.

    Null, empty and blank texts score 0 and are not cut; a null source has limits of its
    own group; repeated rows score alike; with no text at all nothing is cut. The
    classifier is fitted on at most ``sample_rows`` rows; limits and word counts cover all.
    """
    texts = df.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), F.col(text_col).cast("string").alias("text"))
    filled = texts.where("text is not null and trim(text) <> ''")
    learned = learn(filled.withColumn("more", F.lit(None).cast("string")), sample_rows)
    rows = [(s, t) for s, t, _ in learned.rows if t.strip()]
    model = train(rows, learned.limits, learned.counts) if len(rows) >= 20 else None
    sent = df.sparkSession.sparkContext.broadcast((model and model.parts(), learned.limits, learned.counts.astype(np.int32)))

    def run(frames):
        parts, limit, seen = sent.value
        fitted, places = Linear(*parts) if parts else None, Places()
        for frame in frames:
            p = np.zeros(len(frame))
            if fitted is not None:
                there = [k for k, t in enumerate(frame["text"]) if t and t.strip()]
                names = [features(t, limit.get(s, (None, None)), seen) for t, s in zip(frame["text"].iloc[there], frame["source"].iloc[there])]
                p[there] = fitted.scores(Sparse.of(names, places))
            least = fitted.threshold if fitted is not None else 2.0
            yield pd.DataFrame({"id": frame["id"], "source": frame["source"], "p_cut": p, "cut": p >= least})

    return texts.mapInPandas(run, "id bigint, source string, p_cut double, cut boolean").withColumnRenamed("id", id_col).withColumnRenamed("source", source_col)


def rates(scored: DataFrame, source_col: str) -> DataFrame:
    """(source, records, cut_records, cut_rate) per source."""
    by = scored.groupBy(source_col).agg(F.count(F.lit(1)).alias("records"), F.sum(F.col("cut").cast("bigint")).alias("cut_records"))
    return by.withColumn("cut_rate", F.col("cut_records") / F.col("records"))
