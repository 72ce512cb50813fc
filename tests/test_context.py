"""The whole running context of a topic, against brute force."""

from sievework.operators import allocate
from sievework import queries as core
from sievework.session import table


def test_whole_context_and_prompts(spark, sf):
    told = {}
    placed = {(r.topic_entry_id, r.position): r.problem_description for r in core.QUERIES["whole_context"](spark, sf).where("position is not null").collect()}
    rows = {r.problem_key: r for r in core.QUERIES["whole_context"](spark, sf).collect()}
    for r in table(spark, sf, "problem_metadata").where("topic_entry_id is not null").orderBy("problem_key").collect():
        got = [placed[r.topic_entry_id, k] for k in range(1, rows[r.problem_key].earlier + 1)]
        assert got == told.setdefault(r.topic_entry_id, [])
        if (r.problem_description or "").strip(" "):
            told[r.topic_entry_id].append(r.problem_description)
    assert max(map(len, told.values())) >= 3
    prompts = core.QUERIES["generation_prompts"](spark, sf).collect()
    assert len(prompts) == core.TOTAL
    for r in prompts:
        want = "\n".join(f"{k}. {d}" for k, d in enumerate(told.get(r.topic_id, []), 1))
        assert want in r.prompt and ("Previously generated" in r.prompt) == bool(want)


def test_a_hot_group_spreads_over_ranges(spark):
    """Half of all rows in one group, nulls and blanks among them: counts and last values by brute force."""
    rows = [("hot" if k % 2 else f"t{k % 7}", k, None if k % 5 == 0 else " " if k % 11 == 0 else f"v{k}") for k in range(4000)] + [(None, 9001, "a"), (None, 9002, None), (None, 9003, "b")]
    df = spark.createDataFrame(rows, "topic string, no bigint, text string").repartition(5)
    got = {r.no: (r.earlier, r.last_earlier) for r in allocate.before(df, "topic", ["no"], "text").collect()}
    seen = {}
    for topic, no, text in sorted(rows, key=lambda r: r[1]):
        held = seen.setdefault(topic, [])
        assert got[no] == (len(held), held[-1] if held else None)
        if text and text.strip():
            held.append(text)
    parts = allocate.before(df, "topic", ["no"], "text")
    assert parts.count() == len(rows)
