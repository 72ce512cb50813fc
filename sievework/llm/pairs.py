"""Defective problem-solution pairs.

A linear classifier per defect on hashed n-grams of the solution and features of the pair
(what the solution takes over from the problem, both languages, how it ends). They are
fitted on pairs of the table and on defects made from them - emptied, cut, copied, swapped
across languages, refused by a small grammar - with thresholds calibrated on held-out rows. A
pair gets the defect of greatest margin over its threshold, if any. Features are made for a
batch at once; one scan learns, one scores.
"""

from __future__ import annotations

import random
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm import truncation
from sievework.llm.linear import DIMENSIONS_LOG2, Features, Linear, Places, Sparse, fit
from sievework.llm.truncation import open_parts

LABELS = ("empty", "truncated", "refusal", "copy", "language")
LANGUAGES = ("en", "de", "fr", "es", "ru", "zh")

# Frequent words of the languages at hand.
COMMON = {
    "en": "the of and is that with for by to in a an this as which when at be it from on we are then thus hence if how one must where not".split(),
    "de": "der die das und ist nicht von mit für auf dem den des ein eine wir zu im als bei aus sich wird wenn damit falls dass nur noch somit am bis".split(),
    "fr": "le la les des du est une un dans pour que qui et au aux en par sur avec ne pas donc ce il on lorsque si à où dès".split(),
    "es": "el la los las que de es una un con para por en y se al del lo como si cuando su entonces tanto donde".split(),
}
#: What a missing solution may be written as, and labels that may stand alone.
NOTHING = ("n/a", "n/a", "n.a.", "n / a", "na", "not applicable", "none", "null", "nil", "nan", "todo", "tbd", "tba", "pending", "missing", "empty", "blank", "unknown", "placeholder", "not available", "no answer", "no solution", "see above", "to be added", "to do")
AROUND = ("{}", "{}", "[{}]", "({})", "<{}>", "{}.", "*{}*")
MARKS = ("-", "--", "—", "?", "??", ".", "...", "…", "/", "_", "*", "x", "xxx", "0")
BARE_LABELS = ("Answer", "Solution", "Result", "Final answer", "Proof", "Response", "Output", "Antwort", "Lösung", "Respuesta", "Solución", "Réponse", "Ответ", "Решение", "答案", "解")

#: A small grammar of refusals; {a|b} is a choice, {x} a word of the problem.
REFUSALS = (
    "{SORRY}{CANNOT} {HELP} {THIS}{WHY}. {END}", "{SORRY}{CANNOT} {HELP} {THIS}{WHY}. {END}", "{SORRY}{CANNOT} {HELP} {THIS}{WHY}. {END}",
    "{This|That|The|Your} {request|question|task|topic|prompt|exercise} {was|is|has been|must be|had to be} {declined|refused|rejected|blocked|denied|not supported|not allowed|out of scope}{WHY}. {END}",
    "{Request|Question|Task} {declined|refused|denied|rejected}{WHY}. {END}",
    "{This|That|The topic|The subject} {is|lies|falls} {outside|beyond|out of} {what I can do|what I may discuss|my scope|the scope of my abilities}. {END}",
    "No {answer|solution|help|derivation|response|result} {can|will|may} be {given|provided|offered|shared}{ here|}{WHY}. {END}",
    "{An answer|A solution|A derivation|Help} {is|will be} not {given|provided|available|offered}{ here|}{WHY}. {END}",
    "{Answering|Helping|Solving this|Doing so|Doing that|Giving an answer} {would be|is|would go} {against|in breach of|a violation of|contrary to} {my|the|our} {rules|policy|policies|guidelines|terms|principles|instructions}. {END}",
    "{My|Our|The} {rules|policy|policies|guidelines|terms|principles|instructions} {do not allow me|do not permit me|forbid me|stop me|prevent me} {to|from} {HELP} {THIS}. {END}",
    "I {can only|only|am only able to} {help with|talk about|discuss|answer} {other|general|different|simple} {topics|subjects|questions|things}{, not this one|}. {END}",
    "{As an AI|As a language model|As an assistant|Being an AI model}, {CANNOT} {HELP} {THIS}. {END}",
    "{Es tut mir leid, aber ich|Leider|Ich} {kann|darf|werde} {ich |}{diese Frage|diese Aufgabe|das} nicht {beantworten|lösen|bearbeiten}. {Bitte wenden Sie sich an eine Lehrkraft.|}",
    "{Désolé, mais je|Je suis désolé, je|Je} ne {peux|veux|vais} pas {répondre à cette question|résoudre ce problème|vous aider}. {Demandez à votre professeur.|}",
    "{Lo siento, pero no|Lamentablemente no|No} {puedo|voy a|quiero} {responder a esta pregunta|resolver este problema|ayudar con eso}. {Pregunte a su profesor.|}",
)
PARTS = {
    "SORRY": "{||Sorry, |I'm sorry, but |I am sorry, but |I apologize, but |Unfortunately, |Thank you for asking, but |Regarding the {x}: |About the {x}: |Hello! |Hi. }",
    "CANNOT": "{I can't|I cannot|I can not|I am unable to|I'm unable to|I am not able to|I'm not able to|I won't|I will not|I won't be able to|I would rather not|I'd rather not|I prefer not to|I must decline to|I have to decline to|I decline to|I refuse to|I am not allowed to|I'm not permitted to|I am not in a position to|I'm not comfortable asked to|It is not possible for me to|It would not be right for me to|I have decided not to|I choose not to|I do not have what it takes to|I don't know how to}",
    "HELP": "{help with|help you with|assist with|answer|solve|provide|provide an answer to|give an answer to|give a solution to|respond to|complete|work on|work through|discuss|comment on|do|derive|attempt|continue with|share}",
    "THIS": "{this|that|it|this question|this problem|this exercise|this request|this task|this derivation|your question|your request|the question|the problem|the {x} problem|homework|graded work|exam questions|such tasks|questions like this|this for you|a full solution|the result you want}",
    "WHY": "{|||, since it may be {an exam|homework|a test|graded}| because it looks like {an exam|homework|a test}|, as I lack {the details|the information|the data}| due to {policy|my rules|safety rules}| for {safety|legal|policy} reasons}",
    "END": "{|||Please ask {a teacher|your teacher|an expert|a colleague|a specialist|your instructor} instead.|Please consult {a textbook|an expert|the literature}.|I hope you understand.|Thank you for your understanding.|Is there anything else?|Let me know if I can help with something else.|This may break {the rules|a rule}.|More details would be needed.}",
}
HANDING_BACK = ("", "", "", "Answer: ", "Solution: ", "Problem: ", "Question: ", "Task: ", "Given: ", "Exercise: ", "You asked: ", "The task was: ", "The question reads: ", "To restate: ", "We are told the following. ", "First the statement again. ", "The setting is this: ")
#: What may follow a problem that is handed back without being solved.
NO_START = ("", "", "", "", " We solve it now.", " Let us begin.", " This is what we have to find.", " This must be worked out.", " The answer follows.", " How is it done?", "\n\nNow to the solution.")


def said(pattern: str, draw: random.Random, x: str) -> str:
    """A sentence of the grammar."""
    while True:
        m = re.search(r"\{([^{}]*)\}", pattern)
        if not m:
            return re.sub(r" +", " ", pattern).strip()
        inner = m.group(1)
        new = x if inner == "x" else PARTS[inner] if inner in PARTS else draw.choice(inner.split("|"))
        pattern = pattern[: m.start()] + new + pattern[m.end() :]


# --- features of a batch --------------------------------------------------------------

WORD_OF = {word: [lang for lang in COMMON if word in COMMON[lang]] for words in COMMON.values() for word in words}
HAN, CYRILLIC = re.compile("[\u3400-\u9fff\uf900-\ufaff]"), re.compile("[\u0400-\u052f]")
ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


@dataclass
class Words:
    """Words of a column in order: the row of each, its place in ``known``, words by row."""

    row: np.ndarray
    code: np.ndarray
    sizes: np.ndarray


def tokens(columns: list[list[str]], pattern: str) -> tuple[list[Words], list[str]]:
    """Words of some columns of texts, split where ``pattern`` is, by one dictionary."""
    parts = []
    for texts in columns:
        split = pc.split_pattern_regex(pc.utf8_lower(pa.array(texts, pa.large_string())), pattern)
        row, word = pc.list_parent_indices(split), pc.list_flatten(split)
        full = pc.not_equal(word, "")
        parts.append((pc.filter(row, full).to_numpy(), pc.filter(word, full), len(texts)))
    coded = pa.chunked_array([p[1] for p in parts], pa.large_string()).combine_chunks()
    coded = (coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded).dictionary_encode()
    codes, out, at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), [], 0
    for row, word, size in parts:
        out.append(Words(row.astype(np.int64), codes[at : at + len(word)], np.bincount(row, minlength=size)))
        at += len(word)
    return out, coded.dictionary.to_pylist()


def grams(words: Words, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(position of the first word, hash) of each run of n words of one row."""
    h = hashes[words.code]
    if h.size < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(words.row[n - 1 :] == words.row[: words.row.size - n + 1])
    total = np.zeros(at.size, np.uint64)
    for k in range(n):
        total = (total ^ h[at + k]) * ODD[k]
        total ^= total >> np.uint64(29)
    return at, total


def held_in(these: np.ndarray, those: np.ndarray) -> np.ndarray:
    """Whether each of ``these`` is among ``those``."""
    if not those.size:
        return np.zeros(these.size, bool)
    those = np.sort(those)
    return those[np.minimum(np.searchsorted(those, these), those.size - 1)] == these


def taken_over(mine: Words, theirs: Words, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """By row: the share of words in runs of four that the problem has, the share of words it has, the longest stretch that is new, new words, and the share of the last twelve."""
    size = mine.sizes.size
    of_row = lambda row: (row.astype(np.uint64) + np.uint64(1)) * ODD[1]
    at, run = grams(mine, hashes, 4)
    there, theirs_run = grams(theirs, hashes, 4)
    again = held_in(run ^ of_row(mine.row[at]), theirs_run ^ of_row(theirs.row[there]))
    covered = np.zeros(mine.row.size, bool)
    for k in range(4):
        covered[at[again] + k] = True
    known = held_in((mine.row << 32) | mine.code, (theirs.row << 32) | theirs.code)
    many = np.maximum(mine.sizes, 1)
    mean = lambda held: np.bincount(mine.row, weights=held, minlength=size)
    # stretches of words not covered
    new = np.ones(mine.row.size, bool)
    new[1:] = (mine.row[1:] != mine.row[:-1]) | covered[1:] | covered[:-1]
    stretch = np.cumsum(new) - 1
    lengths = np.bincount(stretch, weights=~covered) if stretch.size else np.zeros(0)
    longest = np.zeros(size)
    if stretch.size:
        np.maximum.at(longest, mine.row[new], lengths)
    from_end = np.repeat(np.cumsum(mine.sizes), mine.sizes) - np.arange(mine.row.size)
    last = from_end <= 12
    return {
        "share": mean(covered) / many,
        "inside": mean(known) / many,
        "longest": longest,
        "foreign": mean(~covered & ~known),
        "tail": mean(covered & last) / np.maximum(mean(last), 1),
    }


def languages(words: Words, known: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By row: the place in LANGUAGES of the likeliest language (-1 for none), its share of the evidence, the amount of evidence."""
    held = np.zeros((len(known), len(LANGUAGES)))
    for k, word in enumerate(known):
        if word in WORD_OF:
            for lang in WORD_OF[word]:
                held[k, LANGUAGES.index(lang)] = 1.0 / len(WORD_OF[word])
        elif not word.isascii():
            han = len(HAN.findall(word))
            held[k, LANGUAGES.index("zh")] = han / 2.0
            held[k, LANGUAGES.index("ru")] = float(not han and CYRILLIC.search(word) is not None)
    size = words.sizes.size
    score = np.column_stack([np.bincount(words.row, weights=held[words.code, k], minlength=size) for k in range(len(LANGUAGES))])
    total, best = score.sum(axis=1), score.argmax(axis=1)
    return np.where(total > 0, best, -1), score.max(axis=1) / np.maximum(total, 1e-9), total.astype(int)


def some(n: float) -> int:
    return int(min(9, np.log2(n + 1) * 1.5))


def features(problems: list[str | None], solutions: list[str | None], counts: np.ndarray, places: Places) -> dict[str, Sparse]:
    """Features of pairs, by defect: each label's weights see its own kinds. A null counts as empty."""
    asked, answers = [p or "" for p in problems], [s or "" for s in solutions]
    (mine, theirs), known = tokens([answers, asked], r"[^\p{L}\p{M}\p{Nd}]+")
    hashes = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in known), np.uint64, len(known)) * ODD[2]
    over = taken_over(mine, theirs, hashes)
    plain = [open_parts(s.rstrip())[2] for s in answers]
    (said_in, asked_in), spoken = tokens([[s.replace("’", "'") for s in plain], [open_parts(p)[2] for p in asked]], r"[^\p{L}\p{M}']+")
    lang_a, sure_a, much_a = languages(asked_in, spoken)
    lang_s, sure_s, much_s = languages(said_in, spoken)
    made: dict[str, list[Features]] = {x: [] for x in LABELS}
    for k, text in enumerate(answers):
        n, share, inside = int(mine.sizes[k]), float(over["share"][k]), float(over["inside"][k])
        size = f"words={some(n)}"
        empty: Features = {size: 1.0}
        if n <= 4:
            squeezed = re.sub(r"[\s\u200b-\u200f\u2060\ufeff]+", " ", text).strip().lower()
            empty["all=" + squeezed[:40]] = 1.0
            empty[f"letters={some(sum(map(str.isalnum, squeezed)))}"] = 1.0
            empty["shape=" + truncation.shape(re.sub(r"\$[^$]*\$", "F", squeezed)[:40])[:16]] = 1.0
            empty["no_letters"] = float(not any(map(str.isalnum, squeezed)))
            empty["nothing"] = float(not squeezed)
            empty["label_only"] = float(re.fullmatch(r"\W*[^\W\d_]+(?: [^\W\d_]+)?\s?[:：]\W*", squeezed) is not None)
            for word in re.findall(r"\w+", squeezed)[:4]:
                empty["word=" + word] = 1.0
        made["empty"].append(empty)
        s5 = int(share * 5)
        made["copy"].append({
            f"copied={int(share * 10)}": 1.0, f"inside={int(inside * 10)}": 1.0, f"gap={s5}/{some(over['longest'][k])}": 1.0, f"foreign={s5}/{some(over['foreign'][k])}": 1.0,
            f"tail={s5}/{int(over['tail'][k] * 3)}": 1.0, "few_foreign": float(over["foreign"][k] <= 6), "share": 3 * share, size: 0.5,
        })
        other = int(lang_a[k] != lang_s[k] and lang_a[k] >= 0 and lang_s[k] >= 0)
        sure = min(sure_a[k], sure_s[k])
        made["language"].append({
            "other": 3.0 * other, f"other/much={other}/{some(min(much_a[k], much_s[k], 40))}": 1.0, f"other/sure={other}/{int(sure * 5)}": 1.0,
            "other_sure": 4.0 * other * sure * min(1.0, much_s[k] / 6.0), f"pair={lang_a[k]}>{lang_s[k]}": 0.5,
        })
        ends: Features = {size: 0.5, f"copied={int(share * 4)}": 0.5}
        if text.strip():
            ends.update(truncation.features(text, (None, None), counts))
        made["truncated"].append(ends)
        made["refusal"].append({size: 1.0, f"inside={int(inside * 5)}": 0.5, f"formulas={min(3, plain[k].count('F'))}": 0.5})
    out = {x: Sparse.of(rows, places) for x, rows in made.items()}
    # n-grams of prose, each once a row
    word_hashes = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in spoken), np.uint64, len(spoken)) * ODD[2]
    keys = [np.zeros(0, np.uint64)]
    for n in (1, 2, 3):
        at, run = grams(said_in, word_hashes, n)
        keys.append((said_in.row[at].astype(np.uint64) << np.uint64(DIMENSIONS_LOG2)) | ((run * ODD[3] + np.uint64(n)) >> np.uint64(64 - DIMENSIONS_LOG2)))
    held = np.sort(np.concatenate(keys).astype(np.int64))
    held = held[np.diff(held, prepend=-1) != 0]
    grams_of = Sparse(held >> DIMENSIONS_LOG2, held & ((1 << DIMENSIONS_LOG2) - 1), np.full(held.size, 0.5), len(answers))
    out["refusal"] = out["refusal"].joined(grams_of)
    return out


# --- labelled rows --------------------------------------------------------------------


def words_of(text: str) -> list[str]:
    return re.findall(r"\w+", text.lower())


def sentences(text: str) -> list[str]:
    return [s for s in re.split(r"(?<=[.!?。？])\s+|\n+", text) if s.strip()]


def refusal(problem: str, solution: str, draw: random.Random) -> str:
    terms = [w for w in words_of(problem) if len(w) > 5] or ["problem"]
    body = said(draw.choice(REFUSALS), draw, draw.choice(terms))
    if draw.random() < 0.3:
        first = sentences(solution)
        body = (first[0] + " " if first else "") + body
    return body


def handed_back(problem: str, draw: random.Random) -> str:
    parts = sentences(problem)
    if len(parts) > 2 and draw.random() < 0.3:
        parts = parts[: draw.randrange(max(1, len(parts) * 2 // 3), len(parts))]
        text = " ".join(parts)
    else:
        text = problem
    if draw.random() < 0.4:
        tokens = text.split(" ")
        for _ in range(max(1, len(tokens) // draw.choice((12, 20, 40)))):
            k = draw.randrange(len(tokens))
            tokens[k] = draw.choice(("", tokens[k].lower(), tokens[k].capitalize(), tokens[k].strip(".,"), draw.choice(tokens), tokens[k][:-1]))
        text = " ".join(t for t in tokens if t)
    text = draw.choice(HANDING_BACK) + text
    if draw.random() < 0.15 and len(text) > 80:
        return text[: draw.randrange(len(text) // 2, len(text))] + truncation.cut_sign(draw)
    text += draw.choice(NO_START)
    if draw.random() < 0.25:
        text += draw.choice(("\n\nAnswer:", "\n\nSolution:", "\n", "\n\nFinal answer:", " ?"))
    return text


def blank(draw: random.Random) -> str:
    kind = draw.random()
    if kind < 0.25:
        return draw.choice(("", " ", "\n", "\n\n", "\t", "\u200b", " \n "))
    if kind < 0.38:
        return draw.choice(MARKS)
    if kind < 0.7:
        word = draw.choice(NOTHING)
        return draw.choice(AROUND).format(draw.choice((word, word.upper(), word.capitalize())))
    return draw.choice(BARE_LABELS) + ":" + draw.choice(("", " ", "\n", " \n", " ?", " ...", " -"))


def made(rows: list[tuple[str, str]], draw: random.Random) -> tuple[list[str], list[str], list[int], list[int]]:
    """Training rows (problem, solution, place of the label or -1, owner): each pair as it is, and defects made from it."""
    plain = [open_parts(s)[2] for _, s in rows]
    asked = [open_parts(p)[2] for p, _ in rows]
    (in_answer, in_problem), known = tokens([plain, asked], r"[^\p{L}\p{M}']+")
    answer_lang, problem_lang = languages(in_answer, known)[0], languages(in_problem, known)[0]
    spoken: dict[int, list[str]] = {}
    for lang, (_, solution) in zip(answer_lang, rows):
        spoken.setdefault(int(lang), []).append(solution)
    problems, solutions, labels, owners = [], [], [], []

    def put(owner: int, problem: str, solution: str, label: str | None) -> None:
        problems.append(problem)
        solutions.append(solution)
        labels.append(LABELS.index(label) if label else -1)
        owners.append(owner)

    for k, (problem, solution) in enumerate(rows):
        put(k, problem, solution, None)
        kind = draw.random()
        if kind < 0.30:
            put(k, problem, blank(draw), "empty")
        elif kind < 0.45:
            # whole but short answers are no defects
            last = solution.rstrip().rsplit("\n", 1)[-1]
            if solution.strip() and len(last) > 8 and last[-1:] not in "`":
                put(k, problem, last, None)
        elif kind < 0.60:
            put(k, problem, problem + draw.choice(("\n\n", "\n", " ")) + solution, None)
        if draw.random() < 0.5:
            put(k, problem, refusal(problem, solution, draw), "refusal")
        if draw.random() < 0.6:
            part = truncation.cut_somewhere(solution, (None, None), draw)
            if part and len(words_of(part)) >= 3:
                put(k, problem, part, "truncated")
        if problem.strip() and draw.random() < 0.6:
            put(k, problem, handed_back(problem, draw), "copy")
        others = [lang for lang in spoken if lang not in (problem_lang[k], -1)]
        if problem_lang[k] >= 0 and others and draw.random() < 0.6:
            put(k, problem, draw.choice(spoken[draw.choice(others)]), "language")
    return problems, solutions, labels, owners


@dataclass
class Judge:
    """A linear model per defect."""

    models: dict[str, Linear]

    def scores(self, rows: dict[str, Sparse]) -> np.ndarray:
        return np.column_stack([self.models[x].scores(rows[x]) for x in LABELS])

    def decide(self, scores: np.ndarray) -> np.ndarray:
        """The place in LABELS of the defect of greatest margin over its threshold, -1 if none passes; a copy that is cut is a copy."""
        least = np.array([self.models[x].threshold for x in LABELS])
        margin = (scores - least) / np.maximum(1 - least, 0.01)
        copied, cut = LABELS.index("copy"), LABELS.index("truncated")
        margin[margin[:, copied] >= 0, cut] = -1
        best = margin.argmax(axis=1)
        return np.where(margin.max(axis=1) >= 0, best, -1)


def train(rows: list[tuple[str, str]], counts: np.ndarray, seed: int = 7) -> Judge:
    """Three rounds, features made once.

    At first all pairs count as sound, but for refusals and empty ones, whose wording recurs,
    only those with the longer half of the solutions; later rounds take all, with what was made of them, that
    the round before does not doubt, and refusals it is sure of as further cases.
    """
    problems, solutions, labels, owners = made(rows, random.Random(seed))
    places, label, owner = Places(), np.array(labels), np.array(owners)
    packed = features(problems, solutions, counts, places)
    first = np.flatnonzero(np.diff(np.append(-1, owner)) != 0)  # the pairs as they are
    as_is = {x: packed[x].take(first) for x in LABELS}
    lengths = np.array([len(s) for _, s in rows])
    sound, sure, long = np.ones(len(rows), bool), np.full(len(rows), -1), lengths >= np.median(lengths)
    declined = LABELS.index("refusal")
    for doubt in (0.2, 0.06, None):
        extra = np.flatnonzero(sure >= 0)
        judge_ = Judge({})
        for k, x in enumerate(LABELS):
            kept = np.flatnonzero((sound & long if x in ("refusal", "empty") and sound.all() else sound)[owner])
            some_ = np.concatenate([kept, first[extra]])
            truth = np.concatenate([label[kept], sure[extra]])
            # copies may be cut: to the model of cuts they say nothing
            told = truth != LABELS.index("copy") if x == "truncated" else np.ones(len(truth), bool)
            judge_.models[x] = fit(packed[x].take(some_[told]), (truth[told] == k).astype(float), epochs=4 if doubt else 6, seed=seed)
        if doubt:
            scores = judge_.scores(as_is)
            sound = scores.max(axis=1) < doubt
            sure = np.where((scores[:, declined] > 0.9) & (scores.argmax(axis=1) == declined), declined, -1)
            if not sound.any():
                sound[:] = True
    return judge_


def judge(df: DataFrame, id_col: str = "pair_id", problem_col: str = "problem", solution_col: str = "solution", sample_rows: int = 2000) -> DataFrame:
    """(id, defect, and a probability per defect) of every pair; defect is null for sound ones.

    Null and blank solutions are ``empty`` by rule, whatever the model says; a null problem has
    no language and nothing to copy; repeated rows are judged alike; an empty table gives no
    rows. Fitted on at most ``sample_rows`` pairs, counts cover all, every pair is judged.
    """
    pairs = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(problem_col).cast("string").alias("problem"), F.col(solution_col).cast("string").alias("solution"))
    filled = pairs.where("problem is not null and solution is not null").select("id", F.lit("").alias("source"), F.col("solution").alias("text"), F.col("problem").alias("more"))
    learned = truncation.learn(filled, sample_rows)
    rows = [(problem, text) for _, text, problem in learned.rows if text.strip()]
    model = train(rows, learned.counts) if len(rows) >= 20 else None
    sent = df.sparkSession.sparkContext.broadcast((model and {x: m.parts() for x, m in model.models.items()}, learned.counts.astype(np.int32)))

    def run(frames):
        parts, seen = sent.value
        fitted, places = Judge({x: Linear(*p) for x, p in parts.items()}) if parts else None, Places()
        for frame in frames:
            sizes = frame["problem"].str.len().fillna(0) + frame["solution"].str.len().fillna(0)
            for a, b in truncation.slices(sizes.to_numpy(float)):
                part = frame.iloc[a:b]
                empty = np.array([not (s or "").strip("\u200b\ufeff \t\r\n") for s in part["solution"]], bool)
                scores, defect = np.zeros((len(part), len(LABELS))), np.full(len(part), -1)
                if fitted is not None:
                    scores = fitted.scores(features(part["problem"].tolist(), part["solution"].tolist(), seen, places))
                    defect = fitted.decide(scores)
                scores[empty], defect[empty] = [1.0] + [0.0] * (len(LABELS) - 1), 0
                yield pd.DataFrame({"id": part["id"].values, "defect": pd.Series([LABELS[d] if d >= 0 else None for d in defect], dtype=object), **{f"p_{x}": scores[:, k] for k, x in enumerate(LABELS)}})

    schema = "id bigint, defect string, " + ", ".join(f"p_{x} double" for x in LABELS)
    return pairs.mapInPandas(run, schema).withColumnRenamed("id", id_col)
