"""Near-duplicates at the borders of size and of physical batches."""

import random

from pyspark.sql import functions as F

from sievework.llm import neardup


def words(n, *more):
    return " ".join([f"word{k:03d}" for k in range(n)] + list(more))


def linked(spark, texts, parts):
    """Pairs of classes that are linked, the i-th text in partition i % parts."""
    rows = spark.createDataFrame([("t", n, text) for n, text in enumerate(texts)], "table_name string, id bigint, text string")
    coded = neardup.numbered(neardup.word_sets(rows).select("table_name", F.col("id").alias("rep"), "words"))
    return {(r.a, r.b) for r in neardup.similar_classes(coded.repartitionByRange(parts, "rep")).collect()}


def test_link_does_not_depend_on_the_slice(spark):
    for small, large in ((95, 96), (58, 59), (12, 13), (155, 156)):
        assert linked(spark, [words(small), words(large)], 2) == {(0, 1)}, (small, large)


def test_size_pairs_of_the_threshold(spark):
    # contained sets whose sizes lie on both sides of a border, far apart
    for small, large in ((46, 59), (75, 96), (27, 36), (123, 156), (201, 253)):
        assert linked(spark, [words(small), words(large)], 2) == {(0, 1)}, (small, large)


def test_all_pairs_by_brute_force_with_split_signatures(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CELL", 7)
    monkeypatch.setattr(neardup, "AT_ONCE", 300)
    draw = random.Random(5)
    texts = []
    for size in (8, 9, 13, 22, 36, 64, 95, 160):
        base = [f"w{k}" for k in range(size)]
        for _ in range(14):
            kept = draw.sample(base, len(base) - draw.randint(0, size // 5))
            texts.append(" ".join(kept + [f"x{draw.randint(0, 40)}" for _ in range(draw.randint(0, size // 5))]))
    sets = {}
    for n, text in enumerate(texts):
        if len(text.split()) >= neardup.FEWEST_WORDS:
            sets.setdefault(frozenset(text.split()), n)
    kept = sorted(sets.items(), key=lambda x: x[1])
    want = {(i, j) for s, i in kept for r, j in kept if i < j and len(s & r) * 10 >= len(s | r) * 7}
    rows = spark.createDataFrame([("t", n, texts[n]) for _, n in kept], "table_name string, id bigint, text string")
    coded = neardup.numbered(neardup.word_sets(rows).select("table_name", F.col("id").alias("rep"), "words"))
    got = [(r.a, r.b) for r in neardup.similar_classes(coded).collect()]
    assert len(want) > 200 and set(got) == want and len(got) == len(want)
    # signatures of more than CELL sets were split
    sets_of = coded.select("t", "rep", F.transform("words", lambda w: F.xxhash64(w)).alias("words"))
    plan, place = neardup.plan_of(neardup.word_counts(sets_of), len(kept), 200)
    assert max(neardup.crowded(sets_of, plan, place, 1).values()) > 1


def test_nothing_of_the_data_is_broadcast(spark):
    records = neardup.default_records(spark, lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet"))
    links = neardup.similar_classes(neardup.numbered(neardup.word_sets(records).select("table_name", F.col("id").alias("rep"), "words")))
    for plan in (links, neardup.found_pairs(records), neardup.groups(records)):
        assert "Broadcast" not in plan._jdf.queryExecution().executedPlan().toString()


def test_recall_against_brute_force(spark):
    """All pairs of both tables at sf0.1 by a matrix product of word counts."""
    import numpy as np

    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet")
    records = neardup.default_records(spark, read)
    want = set()
    for name in ("problem_metadata", "matched_pairs"):
        rows = neardup.word_sets(records.where(F.col("table_name") == name)).collect()
        words = {w: k for k, w in enumerate(sorted({w for r in rows for w in r.words}))}
        held = np.zeros((len(rows), len(words)), np.float32)
        for k, r in enumerate(rows):
            held[k, [words[w] for w in r.words]] = 1
        common = (held @ held.T).astype(int)
        size = held.sum(axis=1).astype(int)
        x, y = np.nonzero(np.triu(common * 10 >= 7 * (size[:, None] + size[None] - common), 1))
        want |= {(name, min(rows[i].id, rows[j].id), max(rows[i].id, rows[j].id)) for i, j in zip(x, y)}
    assert {tuple(r) for r in neardup.found_pairs(records).collect()} == want and len(want) > 500


def test_shares_are_all_signatures_each_once():
    import numpy as np

    draw = np.random.default_rng(3)
    sizes = draw.integers(1, 120, 100)
    words, of, t = draw.integers(0, 2**62, sizes.sum()), np.repeat(np.arange(100), sizes), np.ones(100, np.int64)
    plan, place = neardup.plan_of(np.full(neardup.BUCKETS, 2), 100, 120)
    whole = sorted(zip(*(x.tolist() for x in neardup.signatures_of(words, of, sizes, t, plan, place))))
    for many in (2, 7, 300):
        shares = [zip(*(x.tolist() for x in neardup.signatures_of(words, of, sizes, t, plan, place, (i, many)))) for i in range(many)]
        assert sorted(x for share in shares for x in share) == whole


def test_passes_find_all_pairs(spark, monkeypatch):
    for name, value in (("CELL", 7), ("PASS_SHARE", 3), ("PASS_ROWS", 1), ("PASS_PAIRS", 20)):
        monkeypatch.setattr(neardup, name, value)
    draw = random.Random(6)
    texts = []
    for size in (9, 22, 64):
        base = [f"w{k}" for k in range(size)]
        texts += [" ".join(draw.sample(base, size - draw.randint(0, size // 5)) + [f"x{draw.randint(0, 40)}"]) for _ in range(14)]
    sets = [frozenset(text.split()) for text in texts]
    want = {(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) * 10 >= len(sets[i] | sets[j]) * 7}
    assert len(want) > 100 and linked(spark, texts, 3) == want


def test_disk_within_four_times_the_input(spark, monkeypatch):
    """Files of shuffles and of the shared folder, while pairs are looked for."""
    import os
    import threading

    from sievework.session import shared_dir

    monkeypatch.setattr(neardup, "PASS_ROWS", 1, raising=False)  # or the passes of such a table would be one
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    places = [*manager.localDirsString(), shared_dir(spark).removeprefix("file://")]

    def used():
        total = 0
        for place in places:
            for folder, _, names in os.walk(place):
                for name in names:
                    try:
                        total += os.path.getsize(os.path.join(folder, name))
                    except OSError:
                        pass
        return total

    files = [f"/root/testdata/sf0.1/{name}.parquet" for name in ("problem_metadata", "matched_pairs")]
    records = neardup.default_records(spark, lambda name: spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet"))
    before, seen, over = used(), [0], threading.Event()

    def watch():
        while not over.wait(0.02):
            seen.append(used())

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        assert neardup.found_pairs(records).count() > 500
    finally:
        over.set()
        watcher.join()
    assert max(seen) - before <= 4 * sum(os.path.getsize(x) for x in files)
