"""The operators on texts: brute force, round trips, held-out accuracy, and the defined edge cases."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sievework.llm import bpe, linear, markup, mixing, neardup, pairs, pii, repetition, truncation
from sievework.session import table


def frame(spark, texts, id_col="doc_id", col="text"):
    rows = [(k, t) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, f"{id_col} bigint, {col} string").withColumn("id", F.lit("clash")).withColumn("kind", F.lit(1))


EDGES = [None, "", "   ", "word " * 40_000, "a" * 30_000, "\ud7ff\u200b\x1c", "same", "same"]


# --- encoding -----------------------------------------------------------------------


def test_encoding_equals_the_public_library(spark, sf):
    tiktoken = pytest.importorskip("tiktoken")
    ranks = bpe.load_ranks()
    library = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = table(spark, sf, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r.ids for r in bpe.encode(docs).collect()}
    assert got == {k: library.encode_ordinary(t or "") for k, t in texts.items()}
    edges = {r.doc_id: r.ids for r in bpe.encode(frame(spark, EDGES)).collect()}
    assert edges == {k: library.encode_ordinary(t or "") for k, t in enumerate(EDGES)}
    back = {v: k for k, v in ranks.items()}
    assert all(b"".join(back[i] for i in ids).decode() == (texts[k] or "") for k, ids in got.items())


def test_long_rows_by_heap_equal_the_matrix():
    tables = bpe.build_tables(bpe.load_ranks())
    for seed in range(3):
        ids = tables["bytes"][np.random.RandomState(seed).randint(97, 101, 600)]
        assert bpe.merge_long(tables, ids).tolist() == bpe.merge_rows(tables, ids[None].copy())[0].tolist()


def test_encoding_of_an_empty_table(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


# --- mixing -------------------------------------------------------------------------


def test_mixing_keeps_budgets_caps_and_epochs(spark, sf):
    docs, targets = table(spark, sf, "documents"), table(spark, sf, "mix_targets")
    chosen, report = mixing.mix(docs, targets)
    chosen, report = chosen.collect(), {r.source: r for r in report.collect()}
    assert set(report) == {r.source for r in targets.collect()}
    for source, r in report.items():
        mine = [c for c in chosen if c.source == source]
        assert sum(c.tokens * c.uses for c in mine) == r.mixed_tokens <= r.owed
        assert all(0 < c.uses <= r.max_repeats for c in mine)
        if r.epochs:
            assert len(mine) == r.docs and min(c.uses for c in mine) >= r.epochs
        if r.mixed_tokens < min(r.owed, r.tokens * r.max_repeats):  # the next document did not fit
            assert min(r.owed, r.tokens * r.max_repeats) - r.mixed_tokens < r.tokens
    assert abs(sum(r.actual_share for r in report.values()) - 1) < 1e-9
    assert len({c.doc_id for c in chosen}) == len(chosen)


def test_mixing_by_brute_force_and_skew(spark):
    rows = [(k, "big" if k % 3 else "small", 1.0 + k % 2, 5 + k % 7) for k in range(3000)] + [(9000, None, 1.0, 5)]
    sized = spark.createDataFrame(rows, "doc_id bigint, source string, weight double, tokens bigint")
    targets = spark.createDataFrame([("big", 0.3, 2), ("small", 0.6, 3), ("none", 0.1, 1)], "source string, target_share double, max_repeats int")
    plans = mixing.plan(sized, targets, 20_000).cache()
    got = {r.doc_id: r.uses for r in mixing.select(sized, plans).collect()}
    keys = {r.doc_id: r.k for r in sized.select("doc_id", mixing.draw_key("doc_id", "weight", 17).alias("k")).collect()}
    want = {}
    for p in plans.collect():
        mine = sorted((keys[i], i, t) for i, s, _, t in rows if s == p.source)
        left = p.rest
        for _, i, t in mine:
            want[i] = p.epochs
        for _, i, t in mine:
            if t > left:
                break
            left -= t
            want[i] = want.get(i, 0) + 1
    assert got == {i: n for i, n in want.items() if n}


def test_mixing_without_documents(spark):
    none = spark.createDataFrame([], "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("a", 1.0, 2)], "source string, target_share double, max_repeats int")
    chosen, report = mixing.mix(none, targets)
    assert chosen.collect() == [] and report.collect()[0].actual_share == 0.0


# --- repetition ---------------------------------------------------------------------


def share_by_brute_force(text, size=8):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    seen, inside = set(), [False] * len(words)
    for k in range(len(words) - size + 1):
        run = tuple(words[k : k + size])
        if run in seen:
            inside[k : k + size] = [True] * size
        seen.add(run)
    return sum(inside) / len(words) if words else 0.0


def test_repetition_equals_brute_force(spark):
    draw = random.Random(0)
    texts = [" ".join(draw.choice("abcd") for _ in range(draw.randrange(0, 60))) for _ in range(200)] + ["x 1 Y 2 " * 10, *EDGES]
    book = repetition.ledger(frame(spark, texts), "doc_id", "text")
    got = {r.doc_id: r for r in book.collect()}
    for k, t in enumerate(texts):
        assert abs(got[k].word_run_8 - share_by_brute_force(t)) < 1e-12 and abs(got[k].word_run_5 - share_by_brute_force(t, 5)) < 1e-12
        assert bool(got[k].failed & 1) == (share_by_brute_force(t) >= 0.3)
    assert got[len(texts) - 8].failed == 0
    wanted = sum(bool(r.failed & repetition.mask_of("v2")) for r in got.values())
    found = {(r.policy, r.rule): r for r in repetition.ablation(book).collect()}
    assert found["v2", "line"].rejected == wanted == repetition.apply_policy(book, "v2").count()
    assert found["v1", "word_run_8"].only_this_rule == repetition.apply_policy(book, "v1").count()
    assert repetition.ledger(spark.createDataFrame([], "doc_id bigint, text string"), "doc_id", "text").count() == 0


# --- near-duplicates ----------------------------------------------------------------


def words(text):
    return re.findall(r"[^\W_]+", text.lower())


def similar_by_brute_force(rows):
    sets = [(i, set(words(t))) for i, t in rows if t and len(words(t)) >= 8]
    return {(min(i, j), max(i, j)) for a, (i, s) in enumerate(sets) for j, t in sets[:a] if len(s & t) * 10 >= 7 * len(s | t)}


def edited(text, draw, n):
    parts = text.split()
    for _ in range(n):
        k = draw.randrange(len(parts))
        parts[k : k + 1] = draw.choice(([], [f"w{draw.randrange(5000)}"], [parts[k], f"v{draw.randrange(5000)}"]))
        parts = parts or ["x"]
    return " ".join(parts)


def test_near_duplicates_equal_brute_force(spark):
    draw = random.Random(1)
    vocabulary = [f"t{int(draw.expovariate(0.01))}" for _ in range(600)]
    rows = []
    for size in (9, 14, 30, 62, 75, 130, 300):
        for _ in range(14):
            base = " ".join(draw.choice(vocabulary) for _ in range(size))
            rows += [base, base.upper() + "!"] + [edited(base, draw, draw.randrange(1, max(2, size // 7))) for _ in range(3)]
    rows = list(enumerate([*rows, *EDGES]))
    records = spark.createDataFrame(rows, "id bigint, text string").select(F.lit("t").alias("table_name"), "id", "text")
    got = {(r.id_a, r.id_b) for r in neardup.found_pairs(records).collect()}
    want = similar_by_brute_force(rows)
    assert got == want and len(want) > 300


def test_hot_group_of_copies_and_groups(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CELL", 16)  # the class of 60 copies meets in cells
    text = "one two three four five six seven eight nine ten"
    rows = [("t", k, text) for k in range(60)] + [("t", 100, text + " eleven"), ("t", 101, "a b c d e f g h"), ("t", 102, None), ("u", 1, text)]
    records = spark.createDataFrame(rows, "table_name string, id bigint, text string")
    got = neardup.found_pairs(records).collect()
    assert len(got) == 60 * 59 // 2 + 60
    groups = {(r.table_name, r.id): r for r in neardup.groups(records).collect()}
    assert groups["t", 59].class_id == 0 and groups["t", 100].group_id == 0 and groups["t", 100].links == 1 and groups["t", 101].links == 0
    assert neardup.groups(records.where("id < 0")).count() == 0


# --- personal information -------------------------------------------------------------


ITEMS = [
    ("Write to ann.lee+x@dept.example.org or bob(at)lab.test, cc: eve AT mail DOT example.", [("email", "ann"), ("email", "bob"), ("email", "eve")]),
    ("Call +44 1632 960703 or (791) 555-0184, tel. 4565550167.", [("phone", "44"), ("phone", "791"), ("phone", "4565550167")]),
    ("passport no. QX 6912 220, issued to Cara O. Delmond-Rey", [("id_number", "QX"), ("name", "Cara")]),
    ("SSN 666-23-9503 here. Run id 666-23-9504 failed. Ticket 409-65-8.", [("id_number", "666-23-9503")]),
    ("Home: Flat 3, 12 Juniper Lane, Kirkwold 00123. Die Mappe liegt bei Rey, Cara, Lindenweg 73, 00836 Westdorf.", [("address", "Flat"), ("name", "Rey"), ("address", "Lindenweg")]),
    ("Enviar a Calle Olmo 14, 00877 Pellmoor. P.O. Box 238, Pellmoor. 18 bis rue des Glycines, 00768 Kirkwold.", [("address", "Calle"), ("address", "P.O."), ("address", "18")]),
    ("Seen by A. Bell and CARA REY. As Dr. Cara Rey pointed out, the Bell-Rey duality of Ostelane Form holds.", [("name", "A. Bell"), ("name", "CARA"), ("name", "Cara Rey")]),
    ("Checksum 2677 7055 6819; build 2025-04-16-0934 of psi@3; @cached; solver.example:8054; seed 92.0956", []),
]


def test_items_and_positions(spark):
    got = {}
    for r in pii.items_of(frame(spark, [t for t, _ in ITEMS] + EDGES)).collect():
        got.setdefault(r.doc_id, []).append((r.kind, r.start_pos))
    for k, (text, want) in enumerate(ITEMS):
        at, places = 0, []
        for kind, begin in want:
            at = text.index(begin, at)
            places.append((kind, at))
            at += 1
        assert sorted(got.get(k, [])) == sorted(places), text
    assert all(k < len(ITEMS) for k in got)


def test_redaction_keeps_the_rest_and_links_equal_values(spark):
    texts = ["Call 020 7946 0983 now. Thanks to Cara Rey.", "x Phone: 020 7946 0983. Thanks to Rey, Cara.", *EDGES]
    got = {r.doc_id: r.text for r in pii.redacted(frame(spark, texts), key="k").collect()}
    phone = re.search(r"<PHONE (\d{3} \d{4} \d{4})>", got[0]).group(1)
    assert phone != "020 7946 0983" and phone in got[1]
    assert got[0].startswith("Call <PHONE ") and got[0].endswith(".") and re.search(r"<NAME \w+>", got[0]).group() in got[1]
    assert [got[k + 2] for k in range(len(EDGES))] == EDGES


def test_permutations_are_bijections():
    for n in (1, 2, 3, 4):
        every = [[int(c) for c in f"{k:0{n}d}"] for k in range(10**n)]
        made = [pii.permute(d, 10, b"k", "t") for d in every]
        assert sorted(made) == every and [pii.restore(d, 10, b"k", "t") for d in made] == every
    letters = [[a, b] for a in range(26) for b in range(26)]
    made = [pii.permute(x, 26, b"k", "t") for x in letters]
    assert sorted(made) == letters and [pii.restore(x, 26, b"k", "t") for x in made] == letters
    assert pii.permute_number("+1 (303) 555-0141", b"k", "p")[:4].startswith("+") and len(pii.permute_date("1999-02-28", b"k")) == 10
    # digits of every script and letters are permuted within it; equal numbers stay equal
    arabic = pii.permute_number("+٤٤ ٢٠ ٧٩٤٦ ٠٩٥٨", b"k", "p")
    assert arabic != "+٤٤ ٢٠ ٧٩٤٦ ٠٩٥٨" and all("٠" <= c <= "٩" for c in arabic if c.isdecimal())
    assert [int(c) for c in arabic if c.isdecimal()] == [int(c) for c in pii.permute_number("44 2079460958", b"k", "p") if c.isdecimal()]
    coded = pii.permute_number("AB-1234-c", b"k", "p")
    assert re.fullmatch(r"[A-Z]{2}-\d{4}-[a-z]", coded) and coded[:2] != "AB"


#: Texts in styles of their own: (text, items as (kind, value)).
BY_HAND = [
    ("her number is 123-45-6789 on file", [("id_number", "123-45-6789")]),
    ("Please pay to DE89 3704 0044 0532 0130 00 today", [("id_number", "DE89 3704 0044 0532 0130 00")]),
    ("Please pay to DE88 3704 0044 0532 0130 00 today", []),  # a wrong check sum
    ("Card 4111 1111 1111 1111 was charged, order 4111 1111 1111 1112 was not", [("id_number", "4111 1111 1111 1111")]),
    ("El DNI es 12345678Z", [("id_number", "12345678Z")]),
    ("Employee ID 7781234, passport X1234567", [("id_number", "7781234"), ("id_number", "X1234567")]),
    ("I met Anna Kowalska at the bank.", [("name", "Anna Kowalska")]),
    ("Maria Gonzalez told Peter Schmidt", [("name", "Maria Gonzalez"), ("name", "Peter Schmidt")]),
    ("Gabriel García Márquez wrote it", [("name", "Gabriel García Márquez")]),
    ("We thank Yoshua Bengio and J. R. Firth for comments", [("name", "Yoshua Bengio"), ("name", "J. R. Firth")]),
    ("Das Ergebnis von Hans Müller ist gut", [("name", "Hans Müller")]),
    ("Kind regards,\nTomasz Nowak", [("name", "Tomasz Nowak")]),
    ("meet Professor Hannah Weiss-Adler tomorrow", [("name", "Hannah Weiss-Adler")]),
    ("Contact: Priya Natarajan, 221B Baker Street, London 12345", [("name", "Priya Natarajan"), ("address", "221B Baker Street, London 12345")]),
    ("Friedrichstraße 12, Berlin", [("address", "Friedrichstraße 12, Berlin")]),
    ("call +٤٤ ٢٠ ٧٩٤٦ ٠٩٥٨ now", [("phone", "٤٤ ٢٠ ٧٩٤٦ ٠٩٥٨")]),
    ("fee $20, call +44 1632 960000, refund $5", [("phone", "44 1632 960000")]),
    ("phone: 555 0199 12 or (030) 901820", [("phone", "555 0199 12"), ("phone", "030) 901820")]),
    ("```\nprint(1)\nmail bob.smith@mail.example.com", [("email", "bob.smith@mail.example.com")]),
    ("write to john dot doe at gmail dot com", [("email", "john dot doe at gmail dot com")]),
    ("order no. 123-45-6789, version 192.168.100.200 at 12:30:45 on 2024-05-11 2024-05-12", []),
    ("The Cauchy Schwarz inequality and Bose Einstein condensate; Monte Carlo simulation; Navier-Stokes equation", []),
    ("New York is big. Suppose Alice and Bob share a key.", []),
    ("Sherlock is at Baker Street. Ruth saw Lake Geneva in May.", []),
    ("My aunt Okonkwo Adaeze lives there", [("name", "Okonkwo Adaeze")]),
    ("Standard Model and Quantum Field Theory differ", []),
    ("ask Wu Zetian; it is room 4021", [("name", "Wu Zetian")]),
    ("lives at 14 rue de la Paix, 75002 Paris", [("address", "14 rue de la Paix, 75002 Paris")]),
]


def test_texts_of_other_styles():
    """At least 0.9 of the items of hand-made texts are found, and 0.9 of what is found is right."""
    p = pii.patterns()
    got, want = set(), set()
    for k, (text, items) in enumerate(BY_HAND):
        got |= {(k, kind, text[a:b]) for kind, a, b in pii.find(text, p)}
        want |= {(k, *item) for item in items}
    assert len(got & want) >= 0.9 * len(want) and len(got & want) >= 0.9 * len(got), (want - got, got - want)


def test_key_is_configured_or_drawn(spark):
    texts = frame(spark, ["Call 020 7946 0983 now."])
    say = lambda **k: pii.redacted(texts, **k).first().text
    assert say(key="a") == say(key="a") != say() != say()


# --- markup, truncation, pairs ----------------------------------------------------------


@pytest.fixture(scope="module")
def crf(spark):
    read = lambda name: table(spark, "/root/testdata/sf0.01", name)
    return markup.model_for(markup.fields_of([("m", read("model_solutions"), "attempt_id", ["detailed_solution"]), ("p", read("matched_pairs"), "pair_id", ["problem", "solution"])]))


PLAIN = ["We need a<b here, and b>c later.", "Roughly 2**5 modes, x_1 * x_2 * x_3 = 4, f[x] ~ 3 and gap_size.", "Norm <q|q>, the R&D sheet, item #4 of the list [2].", "- item with $\\frac{a}{b}$\n\n\\[ \\sqrt{x} \\]\n\n[end of attempt 2]", "```python\nprint(\"<b>%s</b> **%s**\" % (a, b))\n```\n\nQED", "It scales like $\\int dv\\, e^{-2"]
MARKED = {"<p>One&nbsp;may <b>see</b> it.</p>": "One may see it.", "## Mass gap\n\nText **here**.": "Mass gap\n\nText here.", "The ''sign'' of [[a|b]].<ref>note</ref>": "The sign of b.", "\\noindent So \\emph{it} holds~\\cite{a}.": "So it holds.", "<ul><li>a $x$</li><li>b</li></ul>": "- a $x$\n- b", "<math>\\sqrt{x}</math>": "$$\\sqrt{x}$$"}


def test_markup_found_and_cleaned(spark, crf):
    texts = [*PLAIN, *MARKED, *EDGES]
    values = frame(spark, texts, "row_id").select(F.lit("t").alias("table_name"), "row_id", F.lit("f").alias("field_name"), "text")
    got = {r.row_id: r for r in markup.cleaned(values, crf).collect()}
    for k, text in enumerate(texts):
        assert (got[k].marked > 0) == (text in MARKED), text
        if text in MARKED:
            assert got[k].clean_text == MARKED[text]
    assert {r.row_id for r in markup.found(values, crf).collect()} == {k for k, t in enumerate(texts) if t in MARKED}
    assert markup.found(values.where("row_id < 0"), None).count() == 0


def written(lines, style, draw):
    """A page of plain lines in a style, by a writer that training does not know: (source, clean lines)."""
    out = []
    emphasis = {"html": "<strong class='k'>{}</strong>", "markdown": "__{}__", "wiki": "\'\'\'{}\'\'\'", "latex": "\\textsc{{{}}}"}[style]
    heads = {"html": "<h4 id=a>{}</h4>", "markdown": "#### {}", "wiki": "=== {} ===", "latex": "\\subsubsection{{{}}}"}[style]
    bullet = {"html": "<ol><li>{}</li></ol>", "markdown": "+ {}", "wiki": "** {}", "latex": "\\item {}"}[style]
    clean = ["A short heading"]
    out.append(heads.format("A short heading"))
    for k, line in enumerate(lines):
        words = line.split(" ")
        spot = [n for n, w in enumerate(words) if w.isalpha() and len(w) > 3]
        if k % 3 == 2:
            out.append(bullet.format(line))
            clean.append("- " + line)
            continue
        if spot and k % 3 == 1:
            n = draw.choice(spot)
            words[n] = emphasis.format(words[n])
        out.append(f"<div>{' '.join(words)}</div>" if style == "html" else " ".join(words))
        clean.append(line)
    return "\n".join(out), clean


def test_markup_of_another_writer_and_its_clean_text(spark, crf):
    """Pages of an independent writer: found without exception, and cleaned to the lines they were made of."""
    lines = [
        "The first term vanishes by symmetry, so only the second is left.", "Here $x_1 * x_2$ is small and the norm is fixed.", "case one with $a < b$", "We divide both sides by the length of the path.", "Then the ratio of both sums tends to one.", "case two, as before",
        "It remains to bound the rest from above.", "Energy is conserved in every step.",
    ]
    draw, same, total = random.Random(8), 0, 0
    for style in ("html", "markdown", "wiki", "latex"):
        source, want = written(lines, style, draw)
        leaves = markup.parse(source)
        labels = [markup.LABELS[k] for k in crf.viterbi(markup.places(markup.features(leaves)))]
        assert any(x.endswith("+") for x in labels), style
        got = [x for x in markup.clean(leaves, labels).split("\n") if x]
        same += sum(w in got for w in want)
        total += len(want)
    assert same / total >= 0.9, (same, total)


#: Plain and marked texts that differ in what stands around the same marks.
LOOKALIKES = [
    ("The product a *b* c", None), ("Take x_i and y_j, then x_i = y_j.", False), ("We take _both_ of them.", True), ("So 2 * 3 * 4 = 24 holds.", False), ("It is *very* small.", True), ("If a < b and b > c, then stop.", False), ("It is <em>very</em> small.", True),
    ("See [3] and [fig 2] for it.", False), ("See [the page](http://a.example/b) for it.", True), ("The set {a, b} is small.", False), ("The {\\it set} is small.", True), ("Line #4 is wrong.", False), ("# Four lines", True), ("The states |a> and <b|c> differ.", False),
    ("The AT&T line, Q&A and R & D.", False), ("The AT&amp;T line.", True), ("Set max_size and min_size first.", False), ("The norm |x| and |y| agree.", False), ("| norm | 3 |\n|---|---|\n| x | 4 |", True), ("x[i][j] = 3", False), ("See [[norm|the norm]].", True), ("2**5 and 2**6 modes.", False), ("**Two** modes.", True),
]


def test_the_chain_tells_lookalikes_that_a_rule_does_not(crf):
    rule = re.compile(r"\*\S.*?\S?\*|_\S.*?_|<\w|\[[^\]]+\]|\{[^}]+\}|^#|#\d|&\w|\|.*\|")
    told = [(text, want) for text, want in LOOKALIKES if want is not None]
    said = [any(markup.MARKED[k] for k in crf.viterbi(markup.places(markup.features(markup.parse(text))))) for text, _ in told]
    ruled = [rule.search(text) is not None for text, _ in told]
    right = sum(a == w for a, (_, w) in zip(said, told)) / len(told)
    assert right >= 0.9 and right > sum(a == w for a, (_, w) in zip(ruled, told)) / len(told) + 0.2, [t for a, (t, w) in zip(said, told) if a != w]


def test_truncation_on_held_out_cuts(spark):
    scored = truncation.score(table(spark, "/root/testdata/sf0.01", "model_solutions"), "attempt_id", "detailed_solution", "model", 500)
    got = scored.collect()
    assert 0.03 < sum(r.cut for r in got) / len(got) < 0.07
    rows = [("m", f"The remaining integral over $x$ equals {k}. So the claim holds for order {k % 7}.\n\nAnswer: the mass gap") for k in range(300)]
    counts = np.zeros((3, truncation.WORD_BUCKETS), np.int64)
    truncation.count_batch(pa.array([t for _, t in rows]), counts)
    model = truncation.train(rows, {}, counts)
    score = lambda texts: model.scores(linear.Sparse.of([truncation.features(t, (None, None), counts) for t in texts], linear.Places()))
    assert (score([t for _, t in rows[:50]]) < model.threshold).mean() > 0.9 and (score([t[:45] for _, t in rows[:50]]) >= model.threshold).mean() > 0.9


def test_one_longer_text_hides_no_limit(spark):
    lengths = spark.createDataFrame([("a", 0, 500, 9), ("a", 0, 731, 1), ("a", 0, 212, 3), ("b", 0, 90, 4), *(("b", 0, k, 2) for k in range(100, 140)), ("a", 1, 70, 3)], "source string, unit bigint, key bigint, n bigint")
    assert truncation.limits_of(lengths) == {"a": (500, None)}


def test_truncation_edges(spark):
    got = truncation.score(frame(spark, EDGES), "doc_id", "text", "kind").collect()
    assert len(got) == len(EDGES) and not any(r.cut for r in got)
    assert truncation.rates(truncation.score(frame(spark, EDGES), "doc_id", "text", "kind"), "kind").collect()[0].records == len(EDGES)


def test_pair_defects_on_made_ones(spark):
    base = table(spark, "/root/testdata/sf0.01", "matched_pairs")
    problem = base.where("problem is not null and problem like '%the%'").orderBy("pair_id").first().problem
    extra = spark.createDataFrame(
        [(9001, problem, None), (9002, problem, "n/a"), (9003, problem, "I'm sorry, but I can't solve this problem. Thank you for understanding."), (9004, problem, problem), (9005, problem, "Final answer: 30.94 MeV"), (9006, None, "Final answer: 3.1 eV"),
         (9007, problem, "Wir entwickeln bis zur Ordnung 5 und erhalten das Ergebnis. Die Ladung hängt somit nur noch von der Kopplung ab. Damit ist die Behauptung gezeigt."), (9002, problem, "n/a")],
        "pair_id bigint, problem string, solution string",
    )
    pairs_df = base.select("pair_id", "problem", "solution").unionByName(extra)
    got = [(r.pair_id, r.defect) for r in pairs.judge(pairs_df).where("pair_id > 9000").collect()]
    assert sorted(got, key=str) == sorted([(9001, "empty"), (9002, "empty"), (9002, "empty"), (9003, "refusal"), (9004, "copy"), (9005, None), (9006, None), (9007, "language")], key=str)
    assert pairs.judge(extra.where("pair_id < 0")).count() == 0
    few = {r.pair_id: r.defect for r in pairs.judge(extra.where("pair_id in (9001, 9005)")).collect()}
    assert few == {9001: "empty", 9005: None}


#: Defects in words that the training grammar does not have, by label; None for sound pairs.
OTHER_STYLES = [
    ("refusal", "Afraid this one is not for me, and I shall leave it unanswered."),
    ("refusal", "We regret to say that our team does not answer exercises of this sort, sorry."),
    ("refusal", "I would love to be of use here, but I may not give worked answers to anyone."),
    ("refusal", "That is something I am going to pass on. Do talk to your tutor about it."),
    ("refusal", "Answering such things is not what I was built for, I am afraid."),
    ("empty", "(left out)"),
    ("empty", "Solution — "),
    ("empty", "N.A."),
    ("empty", "~"),
    ("truncated", "We expand the propagator around the saddle point and keep the first two terms. The remaining sum over modes is then dominated by the low"),
    ("truncated", "The boundary term vanishes because the field is periodic. Hence the energy per site equals $\\frac{1}{2} \\sum_k ("),
    ("truncated", "Conservation of charge fixes the amplitude. We can now write the action as a functional of the slow variab..."),
    (None, "Conservation of charge fixes the amplitude. The action of the slow variable is stationary, so the mass gap equals $3 m$."),
    (None, "The boundary term vanishes because the field is periodic. Hence the energy per site equals $\\frac{1}{2} \\omega$."),
]


def test_pair_defects_of_other_styles(spark):
    """Nine tenths of the made cuts and sound texts, and at least two thirds of refusals and empty ones in other words, come out right."""
    base = table(spark, "/root/testdata/sf0.01", "matched_pairs").select("pair_id", "problem", "solution")
    problem = base.where("problem like '%the%' and not problem like '%<%'").orderBy("pair_id").first().problem
    extra = spark.createDataFrame([(90_000 + k, problem, text) for k, (_, text) in enumerate(OTHER_STYLES)], base.schema)
    got = {r.pair_id - 90_000: r.defect for r in pairs.judge(base.unionByName(extra)).where("pair_id >= 90000").collect()}
    right = lambda *labels: np.mean([got[k] == x for k, (x, _) in enumerate(OTHER_STYLES) if x in labels])
    assert right("truncated", None) >= 0.8 and right("refusal") >= 0.6 and right("empty") >= 0.5, got


def test_weights_of_the_caller_decide_the_draw(spark):
    """With a column of quality weights the fractional draw takes heavy documents first; null weights come last."""
    rows = [(k, "the same words in each of them", "a", 1000.0 if k % 2 else None if k % 4 else 1e-6) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, quality double")
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    total = mixing.mix(docs, targets)[1].first().tokens
    chosen, report = mixing.mix(docs, targets, budget=total // 4, weight_col="quality")
    picked = [r.doc_id for r in chosen.collect()]
    assert 80 <= len(picked) <= 100 and sum(k % 2 for k in picked) >= 0.97 * len(picked) and report.first().actual_share == 1.0


def test_policies_read_one_stored_ledger(spark):
    texts = ["one two three four five six seven eight nine ten. " * 3, "a line of some words\n" * 4, "nothing said twice here", None, ""]
    book = repetition.stored(repetition.ledger(frame(spark, texts), "doc_id", "text"))
    assert {r.policy: (r.texts, r.rejected) for r in repetition.policies(book).collect()} == {p: (5, repetition.apply_policy(book, p).count()) for p in repetition.POLICIES}


def test_slices_cover_all_rows():
    sizes = np.array([5, 0, 9, 30, 1, 1, 1, 1, 0])
    got = list(truncation.slices(sizes, 3, 10))
    assert [k for a, b in got for k in range(a, b)] == list(range(9)) and all(b - a <= 3 and (sizes[a:b].sum() <= 10 or b - a == 1) for a, b in got)
    assert list(truncation.slices(np.zeros(0))) == []
