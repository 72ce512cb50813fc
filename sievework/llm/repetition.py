"""Repetition inside one document: a rule ledger of bits and measurements.

Every rule is measured once for every text; the ledger keeps the measurements and a
bitmask of the rules that fail. Policies are versioned sets of rules: applying one, or
asking what each rule alone would remove (ablation), is bitwise work on the ledger.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.session import scratch

#: (rule, least share of repeated content that fails it); the bit of a rule is its place.
RULES = (
    ("word_run_8", 0.30),
    ("line", 0.30),
    ("paragraph", 0.30),
    ("sentence", 0.30),
    ("word_run_5", 0.45),
    ("top_bigram", 0.20),
    ("top_trigram", 0.18),
    ("same_word_in_a_row", 0.10),
)
#: Version of a policy -> rules of which one failing is enough.
POLICIES = {
    "v1": ("word_run_8",),
    "v2": ("word_run_8", "line", "paragraph", "sentence"),
    "v3": tuple(name for name, _ in RULES),
}
SCHEMA = "id bigint, n_words bigint, " + ", ".join(f"{name} double" for name, _ in RULES) + ", failed bigint"


def mask_of(policy: str) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(name) for name in POLICIES[policy])


def runs(words: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """An id for the run of ``size`` words that begins at each word; -1 past the text's end."""
    n = len(words)
    ids, out, have = words, None, 0
    at, width, level = 0, 1, words
    left = size
    while left:
        if left & 1:
            part = np.full(n, -1, np.int64)
            shifted = level[at:] if at else level
            part[: len(shifted)] = shifted
            if out is None:
                out = part
            else:
                ok = (out >= 0) & (part >= 0)
                _, codes = np.unique(np.where(ok, out << 32 | np.maximum(part, 0), -1), return_inverse=True)
                out = np.where(ok, codes, -1)
            at += width
        left >>= 1
        if left:
            nxt = np.full(n, -1, np.int64)
            if n > width:
                ok = (level[:-width] >= 0) & (level[width:] >= 0) & (doc[:-width] == doc[width:])
                _, codes = np.unique(np.where(ok, level[:-width] << 32 | np.maximum(level[width:], 0), -1), return_inverse=True)
                nxt[:-width] = np.where(ok, codes, -1)
            level, width = nxt, width * 2
    ends_inside = np.zeros(n, bool)
    if n >= size:
        ends_inside[: n - size + 1] = doc[: n - size + 1] == doc[size - 1 :]
    return np.where(ends_inside, out, -1)


def repeated_share(words: np.ndarray, doc: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Share of the words of each text that lie in a run which began earlier in it too."""
    n = len(words)
    if not n:
        return np.zeros(len(counts))
    run = runs(words, doc, size)
    key = np.where(run >= 0, run * np.int64(len(counts)) + doc, -1)
    _, first = np.unique(key, return_index=True)
    again = run >= 0
    again[first] = False
    cover = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(again)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + size, -1)
    inside = np.cumsum(cover[:-1]) > 0
    return np.bincount(doc[inside], minlength=len(counts)) / np.maximum(counts, 1)


def top_share(words: np.ndarray, doc: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Share of the words of each text that its most frequent run of ``size`` words accounts for."""
    run = runs(words, doc, size) if len(words) else words
    ok = run >= 0
    share = np.zeros(len(counts))
    if ok.any():
        key, n = np.unique(run[ok] * np.int64(len(counts)) + doc[ok], return_counts=True)
        np.maximum.at(share, key % len(counts), np.where(n > 1, n, 0) * float(size))
    return np.minimum(share / np.maximum(counts, 1), 1.0)


def unit_share(parts: list[str]) -> float:
    """Share of characters in units (lines, ...) that occurred before; units under 3 words don't count."""
    seen: Counter[str] = Counter()
    whole = again = 0
    for part in parts:
        unit = " ".join(part.lower().split())
        if unit.count(" ") < 2:
            continue
        whole += len(unit)
        again += len(unit) if seen[unit] else 0
        seen[unit] += 1
    return again / whole if whole else 0.0


def measure(texts: list[str | None]) -> dict[str, np.ndarray]:
    """All rules over a batch; null and empty texts have no words and repeat nothing."""
    letters, sentence = regex.compile(r"\p{L}+"), regex.compile(r"(?<=[.!?。])\s*")
    codes: dict[str, int] = {}
    flat, counts = [], []
    lines, paragraphs, sentences = [], [], []
    for text in texts:
        text = text or ""
        found = letters.findall(text.lower())
        counts.append(len(found))
        flat.extend([codes.setdefault(w, len(codes)) for w in found])
        lines.append(unit_share(text.split("\n")))
        paragraphs.append(unit_share(text.split("\n\n")))
        sentences.append(unit_share(sentence.split(text)))
    words, size = np.array(flat, np.int64), np.array(counts, np.int64)
    doc = np.repeat(np.arange(len(texts)), size)
    stutter = np.zeros(len(texts))
    if len(words) > 1:
        stutter = np.bincount(doc[1:][(words[1:] == words[:-1]) & (doc[1:] == doc[:-1])], minlength=len(texts)) / np.maximum(size, 1)
    return {
        "n_words": size,
        "word_run_8": repeated_share(words, doc, size, 8),
        "line": np.array(lines),
        "paragraph": np.array(paragraphs),
        "sentence": np.array(sentences),
        "word_run_5": repeated_share(words, doc, size, 5),
        "top_bigram": top_share(words, doc, size, 2),
        "top_trigram": top_share(words, doc, size, 3),
        "same_word_in_a_row": stutter,
    }


def ledger(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n_words, a share per rule, and ``failed``: bit k is set if rule k fails.

    One narrow pass. Null, empty and wordless texts measure 0 and fail nothing;
    repeated rows give repeated ledger rows; an empty table gives an empty ledger.
    Words are runs of letters, case ignored.
    """

    def run(frames):
        for frame in frames:
            texts = frame["text"].tolist()
            start = 0
            while start < len(texts):
                stop, chars = start, 0
                while stop < len(texts) and (stop == start or chars + len(texts[stop] or "") <= 2_000_000):
                    chars += len(texts[stop] or "")
                    stop += 1
                found = measure(texts[start:stop])
                failed = np.zeros(stop - start, np.int64)
                for bit, (name, least) in enumerate(RULES):
                    failed |= (found[name] >= least - 1e-12).astype(np.int64) << bit
                yield pd.DataFrame({"id": frame["id"].iloc[start:stop].values, **found, "failed": failed})
                start = stop

    source = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInPandas(run, SCHEMA).withColumnRenamed("id", id_col)


def stored(book: DataFrame) -> DataFrame:
    """The ledger written once to the shared folder: policies and ablations read the copy, no text again."""
    path = scratch(book.sparkSession, "ledger")
    book.write.parquet(path)
    return book.sparkSession.read.parquet(path)


def policies(book: DataFrame) -> DataFrame:
    """(policy, texts, rejected) of every version of the policy over one ledger."""
    counts = book.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    each = F.explode(F.array(*(F.struct(F.lit(p).alias("policy"), F.lit(mask_of(p)).cast("bigint").alias("mask")) for p in POLICIES)))
    spread = counts.select("failed", "n", each.alias("w")).select("failed", "n", "w.*")
    hit = F.col("failed").bitwiseAND(F.col("mask")) != 0
    return spread.groupBy("policy").agg(F.sum("n").alias("texts"), F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("rejected"))


def apply_policy(book: DataFrame, policy: str) -> DataFrame:
    """Rows of the ledger that the policy rejects."""
    return book.where(F.col("failed").bitwiseAND(F.lit(mask_of(policy))) != 0)


def ablation(book: DataFrame) -> DataFrame:
    """Per policy and rule: texts the policy rejects, texts the rule fails, texts only it rejects.

    The ledger is counted by bitmask first (at most 2^rules rows), everything else is
    arithmetic on those counts.
    """
    counts = book.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    names = [name for name, _ in RULES]
    wanted = [(policy, rule, mask_of(policy), 1 << names.index(rule)) for policy in POLICIES for rule in POLICIES[policy]]
    each = F.explode(F.array(*(F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(m).cast("bigint").alias("mask"), F.lit(b).cast("bigint").alias("bit")) for p, r, m, b in wanted)))
    spread = counts.select("failed", "n", each.alias("w")).select("failed", "n", "w.*")
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    return spread.groupBy("policy", "rule").agg(
        F.coalesce(F.sum(F.when(hit != 0, F.col("n"))), F.lit(0)).alias("rejected"),
        F.coalesce(F.sum(F.when(F.col("failed").bitwiseAND(F.col("bit")) != 0, F.col("n"))), F.lit(0)).alias("failing"),
        F.coalesce(F.sum(F.when(hit == F.col("bit"), F.col("n"))), F.lit(0)).alias("only_this_rule"),
    )
