"""Near-duplicate records by PartEnum signatures.

A text is the set of its distinct words. Sets come in bands of size; two sets of one band
that share 0.7 of their words differ in at most k words, k by the band's greatest size. The
word domain is partitioned into n1 parts, so that in one of them two such sets differ in at
most k2 = ceil((k + 1) / n1) - 1 words; each part is divided into n2 smaller ones, of which
at least n2 - k2 hold the same words of both. A signature is a part and n2 - k2 of its small
parts with the words they hold: all choices are enumerated, so two such sets share one
signature for certain, whatever the texts. Sets that share a signature pass a parity
sketch that never rejects a pair that is alike, and then the exact similarity. Equal sets
form one class and enter once; a signature of very many sets is split into cells.

Signatures are many times the input, so they are made, shuffled and compared in passes, each
of which has its share of every band's choices, leaves only pairs and frees its disk.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import comb, exp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm.graph import components
from sievework.session import cut, discard, released, scratch, store

#: Share of words two texts must have in common, as a fraction of integers.
ALIKE = (7, 10)
FEWEST_WORDS = 8
#: Buckets of the hashed word counts by which the domain is partitioned evenly; the result does not depend on them.
BUCKETS = 1 << 16
#: Sets of one signature that are compared in one cell.
CELL = 8192
#: One set in so many is asked for signatures of more than CELL sets: it decides how work is split, not what is found.
ASKED = 16
#: At most so many signatures are split (the list is broadcast).
MOST_SPLIT = 1 << 16
#: Cost of a signature's way through the shuffle, in comparisons of two sketches.
ROW_COST = 400
#: Signatures of a pass: so many for each set, and as many as these in any case. They decide the disk that is in use at once, not what is found.
PASS_SHARE, PASS_ROWS = 16, 5_000_000
#: Pairs that are compared word by word at once: as many as there are sets, and these in any case.
PASS_PAIRS = 1_000_000
#: Rows of the sorted stream that are worked on at once, and rows of a block of comparisons.
AT_ONCE, BLOCK = 200_000, 16
#: Rows of a cell that counts as small, and pairs of small cells that are compared at once.
SMALL, PAIRS = 192, 1_000_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sketch(words: np.ndarray, of: np.ndarray, count: int) -> np.ndarray:
    """count x 2 words of 64 bits. Bit k is the parity of the set's words that hash to k: sketches differ in at most as many bits as sets differ in words."""
    bit = (mixed(words.view(np.uint64) ^ np.uint64(0xA5A5A5A5)) >> np.uint64(57)).astype(np.int64)
    odd = np.bincount(of * 128 + bit, minlength=count * 128).reshape(count, 2, 64).astype(np.uint64) & np.uint64(1)
    return np.bitwise_or.reduce(odd << np.arange(64, dtype=np.uint64), axis=2)


def word_sets(records: DataFrame) -> DataFrame:
    """table_name, id, words (sorted, distinct), key of the set. ``records`` is (table_name, id, text).

    Words are runs of letters or digits, case ignored. Null texts, null ids and texts of
    fewer than eight words are left out.
    """
    found = F.regexp_extract_all(F.lower(F.col("text")), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    split = records.where("text is not null and id is not null").select("table_name", "id", found.alias("all_words"))
    some = split.where(F.size("all_words") >= FEWEST_WORDS)
    return some.select("table_name", "id", F.array_sort(F.array_distinct("all_words")).alias("words")).withColumn("key", F.unhex(F.md5(F.array_join("words", " "))))


def classes(sets: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """(classes, members, path of the stored classes): sets that are equal form a class, named by its least id."""
    spark, at, path = sets.sparkSession, scratch(sets.sparkSession, "sets"), scratch(sets.sparkSession, "classes")
    held = store(sets, at)
    # words have no blanks: joined, they take a third of an array's room in the shuffle
    named = held.groupBy("table_name", "key").agg(F.min("id").alias("rep"), F.first(F.array_join("words", " ")).alias("text"))
    named = store(named.select("table_name", "key", "rep", F.split("text", " ").alias("words")), path)
    with released(spark):
        reps = named.select("table_name", "key", "rep").hint("merge")
        members = cut(held.select("table_name", "key", "id").join(reps, ["table_name", "key"]).select("table_name", coded("table_name").alias("t"), "id", "rep"))
    discard(spark, at)
    return named.select("table_name", "rep", "words"), members, path


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words of a list column, the set of each, and the sets' sizes."""
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(np.arange(len(column)), sizes), sizes


def bucket(words: np.ndarray) -> np.ndarray:
    return (mixed(words.view(np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)


def word_counts(hashed: DataFrame) -> np.ndarray:
    """Sets by bucket of their words: a fixed number of sums, whatever the table."""

    def run(batches):
        held = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            held += np.bincount(bucket(flat(batch.column(0))[0]), minlength=BUCKETS)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(held[at])], names=["bucket", "n"])

    sums = hashed.select("words").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(BUCKETS, np.int64)
    counts[sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    return counts


def bands(most: int) -> list[tuple[int, int]]:
    """Bands of sizes [low, high) up to the one that holds ``most``; a set's partners lie in its own and the next band."""
    num, den = ALIKE
    out, low = [], 1
    while low <= most:
        high = max(low + 1, -(-low * den // num))
        out.append((low, high))
        low = high
    return out


def differing(high: int) -> int:
    """Words in which two sets that are alike differ at most, both smaller than ``high``."""
    num, den = ALIKE
    return 2 * (high - 1) * (den - num) // (den + num)


def partition(k: int, sets: int, info: float) -> tuple[int, int, int]:
    """(n1, n2, k2) of least expected work for sets that differ in at most ``k`` words.

    ``info`` is what the whole domain tells apart (nats), so a signature of n2 - k2 small
    parts is shared by chance by exp(-its part of it) of the sets. Every choice is complete.
    """
    best = None
    for k2 in range(min(k, 4) + 1):
        n1 = -(-(k + 1) // (k2 + 1))
        for n2 in range(k2 + 1, k2 + 5) if k2 else (1,):
            kept = (n2 - k2) / n2 / n1
            work = n1 * comb(n2, k2) * (ROW_COST + sets * exp(-info * kept) / 2)
            if best is None or work < best[0]:
                best = (work, (n1, n2, k2))
    return best[1]


def plan_of(counts: np.ndarray, sets: int, most: int) -> tuple[list[tuple[int, int, int, int, int]], np.ndarray]:
    """Bands with their partitions, and the place of each bucket by its count: places are dealt to parts in turn."""
    p = np.minimum(counts / max(sets, 1), 1.0)
    info = float(-np.log(p * p + (1 - p) * (1 - p)).sum())
    place = np.empty(BUCKETS, np.int64)
    place[np.argsort(-counts, kind="stable")] = np.arange(BUCKETS)
    return [(low, high, *partition(differing(high), sets, info)) for low, high in bands(most)], place


def signatures_of(words: np.ndarray, of: np.ndarray, sizes: np.ndarray, t: np.ndarray, plan: list, place: np.ndarray, share: tuple[int, int] = (0, 1)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set, signature, whether the set's size is of the band itself) of some sets, in all their bands.

    ``share`` (i, n): the i-th of n shares of each band's choices; all shares together are all signatures, each once.
    """
    num, den = ALIKE
    sets, found, own = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
    at, hashes = place[bucket(words)], mixed(words.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
    for low, high, n1, n2, k2 in plan:
        choices = list(combinations(range(n2), n2 - k2))
        # choice ``number`` of a part is the (part * len(choices) + number)-th of the band
        first, last = (n1 * len(choices) * i // share[1] for i in (share[0], share[0] + 1))
        begin, end = first // len(choices), -(-last // len(choices))
        chosen = np.flatnonzero((sizes < high) & (sizes * den >= low * num))
        if not chosen.size or first == last:
            continue
        row = np.full(sizes.size, -1)
        row[chosen] = np.arange(chosen.size)
        mine, slot, slots = row[of], at % (n1 * n2) - begin * n2, (end - begin) * n2
        there = (mine >= 0) & (slot >= 0) & (slot < slots)
        held = np.zeros(chosen.size * slots, np.uint64)
        np.add.at(held, mine[there] * slots + slot[there], hashes[there])
        held = held.reshape(chosen.size, end - begin, n2)
        salt = mixed((t[chosen].astype(np.uint64) << np.uint64(32)) + np.uint64(low))[:, None]
        for number, some in enumerate(choices):
            parts = np.arange(max(begin, -((number - first) // len(choices))), min(end, -((number - last) // len(choices))))
            if not parts.size:
                continue
            which = parts.astype(np.uint64) * np.uint64(1 << 16) + np.uint64(number + 1)
            sums = held[:, parts[0] - begin : parts[-1] + 1 - begin, some].sum(axis=2, dtype=np.uint64)
            found.append(mixed(mixed(sums ^ mixed(which)[None]) + salt).ravel())
            sets.append(np.repeat(chosen, parts.size))
            own.append(np.repeat(sizes[chosen] >= low, parts.size))
    return np.concatenate(sets), np.concatenate(found), np.concatenate(own)


def passes(hashed: DataFrame, plan: list, sets: int, split: dict[int, int]) -> int:
    """Passes in which the signatures are worked on, from their number."""
    num, den = ALIKE
    n = F.size("words")
    of_band = [F.coalesce(F.sum(F.when((n < high) & (n * den >= low * num), n1 * comb(n2, k2))), F.lit(0)) for low, high, n1, n2, k2 in plan]
    rows = sum(hashed.agg(*of_band).first()) + sum(CELL * parts * parts for parts in split.values())
    return max(1, -(-rows // max(PASS_ROWS, PASS_SHARE * sets)))


#: What of a row's ``about`` is the table, the size and the marks.
TABLE_BITS, MARK_BITS = 32, 3
ROW = "key bigint, about bigint, rep bigint, s0 bigint, s1 bigint"


def signature_rows(hashed: DataFrame, plan: list, place: np.ndarray, split: dict[int, int], share: tuple[int, int] = (0, 1)) -> DataFrame:
    """A row per signature (of a share) of each set and cell it takes part in: key, about (table, size, marks), rep, sketch.

    A signature in ``split`` has its sets in that many blocks by hash; cell (i, j), i <= j,
    holds blocks i and j as sides 1 and 2, or block i alone as side 0, so that each two sets meet in one cell.
    """
    keys = np.array(sorted(split), np.uint64)
    parts = np.array([split[int(k)] for k in keys], np.int64)
    shipped = hashed.sparkSession.sparkContext.broadcast((plan, place.astype(np.int32), keys, parts))

    def run(batches):
        plan, place, keys, parts = shipped.value
        place = place.astype(np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                some = batch.slice(start, 2048)
                words, of, sizes = flat(some.column(2))
                t = some.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                reps = some.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
                bits = sketch(words, of, some.num_rows)
                row, key, own = signatures_of(words, of, sizes, t, plan, place, share)
                side = np.zeros(row.size, np.int64)
                if keys.size:
                    spot = np.minimum(np.searchsorted(keys, key), keys.size - 1)
                    wide = np.where(keys[spot] == key, parts[spot], 1)
                    first = np.repeat(np.cumsum(wide) - wide, wide)
                    other = np.arange(first.size) - first
                    row, key, own, wide = (np.repeat(x, wide) for x in (row, key, own, wide))
                    block = (mixed(reps[row].view(np.uint64) + np.uint64(77)) % wide.astype(np.uint64)).astype(np.int64)
                    cell = np.minimum(block, other) * wide + np.maximum(block, other)
                    key = np.where(wide > 1, mixed(key ^ mixed(cell.astype(np.uint64) + np.uint64(1))), key)
                    side = np.where(block == other, 0, np.where(block < other, 1, 2))
                about = (t[row] << TABLE_BITS) + (sizes[row] << MARK_BITS) + side * 2 + own
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(about), pa.array(reps[row]), pa.array(bits[row, 0].view(np.int64)), pa.array(bits[row, 1].view(np.int64))], names=["key", "about", "rep", "s0", "s1"])

    return hashed.select("t", "rep", "words").mapInArrow(run, ROW)


def crowded(hashed: DataFrame, plan: list, place: np.ndarray, asked: int = ASKED) -> dict[int, int]:
    """signature -> blocks, for signatures that more than CELL sets seem to have, asking one set in ``asked``."""
    some = hashed.where(F.pmod(F.xxhash64("rep"), F.lit(asked)) == 0)
    many = signature_rows(some, plan, place, {}).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * asked > CELL)
    top = many.orderBy(F.desc("n")).limit(MOST_SPLIT).collect()  # a bounded number of rows
    return {r["key"] % (1 << 64): -(-r["n"] * asked // CELL) for r in top}


def alike(t: np.ndarray, n: np.ndarray, side: np.ndarray, bits: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (x, y) of rows, x no greater than y, those that size, side and sketch allow."""
    num, den = ALIKE
    differ = np.bitwise_count(bits[0][x] ^ bits[0][y]).astype(np.int64) + np.bitwise_count(bits[1][x] ^ bits[1][y])
    fit = (differ * (num + den) <= (n[x] + n[y]) * (den - num)) & (n[x] * den >= n[y] * num) & ((side[x] == 0) | (side[x] != side[y])) & (t[x] == t[y])
    return x[fit], y[fit]


def meeting(t: np.ndarray, n: np.ndarray, own: np.ndarray, side: np.ndarray, bits: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of rows of one cell that may be alike; cells end at ``ends``, rows within by size.

    The greater set must be of the band itself: two smaller ones meet in their own band.
    Small cells are compared all at once, large ones in blocks of rows.
    """
    num, den = ALIKE
    starts = np.append(0, ends[:-1])
    first = starts + np.diff(np.append(0, np.cumsum(~own)[ends - 1]))
    small = ends - starts <= SMALL
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    # rows of small cells: each meets those behind it
    cell = np.repeat(np.arange(ends.size), ends - starts)
    rows = np.flatnonzero(small[cell])
    low = np.maximum(rows + 1, first[cell[rows]])
    many = np.maximum(ends[cell[rows]] - low, 0)
    some = many > 0
    rows, low, many = rows[some], low[some], many[some]
    done = np.cumsum(many)
    a = 0
    while a < rows.size:
        b = int(np.searchsorted(done, (done[a - 1] if a else 0) + PAIRS, "right"))
        b = max(b, a + 1)
        each = many[a:b]
        x = np.repeat(rows[a:b], each)
        y = np.repeat(low[a:b] - (np.cumsum(each) - each), each) + np.arange(x.size)
        x, y = alike(t, n, side, bits, x, y)
        left.append(x)
        right.append(y)
        a = b
    for c in np.flatnonzero(~small):
        start, end = int(starts[c]), int(ends[c])
        for i in range(start, end - 1, BLOCK):
            stop, begin = min(i + BLOCK, end), max(i, int(first[c]))
            most = int(n[stop - 1])
            last = start + int(np.searchsorted(n[start:end], most * den // num, "right"))
            if begin >= last:
                continue
            differ = np.bitwise_count(bits[0][i:stop, None] ^ bits[0][None, begin:last])
            differ += np.bitwise_count(bits[1][i:stop, None] ^ bits[1][None, begin:last])
            near = np.flatnonzero(differ <= np.minimum((n[begin:last] + most) * (den - num) // (num + den), 128).astype(np.uint8))
            x, y = near // (last - begin) + i, near % (last - begin) + begin
            x, y = alike(t, n, side, bits, x[x < y], y[x < y])
            left.append(x)
            right.append(y)
    return np.concatenate(left), np.concatenate(right)


def candidates(rows: DataFrame) -> DataFrame:
    """(t, a, b), a < b: sets that share a signature and may be alike by size and sketch, each pair once."""

    def work(held):
        key, about, rep, *bits = (held.column(k).to_numpy() for k in range(5))
        t, n = about >> TABLE_BITS, (about & ((1 << TABLE_BITS) - 1)) >> MARK_BITS
        new = np.flatnonzero(np.diff(key) != 0) + 1
        x, y = meeting(t, n, (about & 1) == 1, (about >> 1) & 3, np.stack(bits).view(np.uint64), np.append(new, key.size))
        pairs = np.unique(np.stack([t[x], np.minimum(rep[x], rep[y]), np.maximum(rep[x], rep[y])], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].astype(np.int32)), pa.array(pairs[:, 1]), pa.array(pairs[:, 2])], names=["t", "a", "b"])

    def run(batches):
        waiting, count = [], 0
        for batch in batches:
            waiting.append(batch)
            count += batch.num_rows
            if count < AT_ONCE:
                continue
            held = pa.Table.from_batches(waiting).combine_chunks()
            key = held.column(0).to_numpy()
            # the last cell may go on in the next batch
            whole = int(np.flatnonzero(key != key[-1]).max(initial=-1)) + 1
            if whole:
                yield work(held.slice(0, whole))
            waiting, count = held.slice(whole).to_batches(), held.num_rows - whole
        if count:
            yield work(pa.Table.from_batches(waiting).combine_chunks())

    # a fixed number of tasks: they are small to read and long to run
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(tasks, "key").sortWithinPartitions("key", "about")
    return ordered.mapInArrow(run, "t int, a bigint, b bigint").distinct()


def similar_classes(named: DataFrame) -> DataFrame:
    """(t, a, b), a < b: pairs of classes of one table that are alike; ``named`` is (t, rep, words)."""
    spark, base = named.sparkSession, scratch(named.sparkSession, "similar")
    hashed = store(named.select("t", "rep", F.transform("words", lambda w: F.xxhash64(w)).alias("words")), f"{base}/hashed")
    size = hashed.agg(F.count(F.lit(1)).alias("sets"), F.coalesce(F.max(F.size("words")), F.lit(0)).alias("most")).first()
    with released(spark):
        plan, place = plan_of(word_counts(hashed), size["sets"], size["most"])
        split = crowded(hashed, plan, place) if size["sets"] > CELL else {}
    many = passes(hashed, plan, size["sets"], split) if plan else 1
    for i in range(many):
        store(candidates(signature_rows(hashed, plan, place, split, (i, many))), f"{base}/pass{i}")
    found = spark.read.schema("t int, a bigint, b bigint").parquet(*(f"{base}/pass{i}" for i in range(many)))
    if many > 1:
        found = store(found.distinct(), f"{base}/found")
    discard(spark, f"{base}/hashed", *(f"{base}/pass{i}" for i in range(many) if many > 1))
    chunks = max(1, -(-found.count() // max(PASS_PAIRS, size["sets"])))
    for i in range(chunks):
        store(verified(found.where(F.pmod(F.xxhash64("t", "a", "b"), F.lit(chunks)) == i), named), f"{base}/links{i}")
    links = cut(spark.read.schema("t int, a bigint, b bigint").parquet(*(f"{base}/links{i}" for i in range(chunks))))
    discard(spark, base)
    return links


def verified(found: DataFrame, named: DataFrame) -> DataFrame:
    """The pairs (t, a, b) of ``found`` that are alike by their words."""
    num, den = ALIKE
    # Spark takes what Arrow functions return for as small as what they read: without the hints it would send all words to the driver
    words = named.select("t", "rep", F.array_join("words", " ").alias("text"))
    left, right = (words.select("t", F.col("rep").alias(end), F.col("text").alias("w" + end)).hint("merge") for end in "ab")
    both = found.hint("merge").join(left, ["t", "a"]).join(right, ["t", "b"])
    both = both.select("t", "a", "b", F.split("wa", " ").alias("wa"), F.split("wb", " ").alias("wb"))
    common = F.size(F.array_intersect("wa", "wb"))
    return both.where(common * den >= (F.size("wa") + F.size("wb") - common) * num).select("t", "a", "b")


def numbered(named: DataFrame) -> DataFrame:
    """Classes with a number ``t`` in place of the table's name."""
    return named.select(coded("table_name").alias("t"), "rep", "words")


def coded(name: str) -> Column:
    """A table name as a number of 31 bits."""
    return F.pmod(F.xxhash64(name), F.lit(2**31 - 1)).cast("int")


def near_duplicates(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, members): links (t, a, b) between classes, members (table_name, t, id, rep).

    ``records`` is (table_name, id, text). Every link of similarity 0.7 or more is found.
    """
    named, members, path = classes(word_sets(records))
    links = similar_classes(numbered(named))
    discard(records.sparkSession, path)
    return links, members


def copies(members: DataFrame) -> DataFrame:
    """(table_name, id_a, id_b) of the members of one class; a class of more than CELL members meets in cells."""
    blocks = members.groupBy("t", "rep").agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("blocks"), F.count(F.lit(1)).alias("size")).where("size > 1")
    own = F.pmod(F.xxhash64("id", F.lit(5)), F.col("blocks"))
    placed = members.hint("merge").join(blocks.hint("merge"), ["t", "rep"]).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sided = placed.select("table_name", "t", "rep", "id", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"))
    left = sided.where("side <> 2").hint("merge")
    right = sided.where("side <> 1").select("t", "rep", "i", "j", F.col("id").alias("y"), F.col("side").alias("with")).hint("merge")
    met = left.join(right, ["t", "rep", "i", "j"]).where("(side = 0 and with = 0 and id < y) or (side = 1 and with = 2)")
    return met.select("table_name", F.least("id", "y").alias("id_a"), F.greatest("id", "y").alias("id_b"))


def found_pairs(records: DataFrame) -> DataFrame:
    """(table_name, id_a, id_b), id_a < id_b: every pair of records that are alike, copies included."""
    links, members = near_duplicates(records)
    left = members.select("table_name", "t", F.col("rep").alias("a"), F.col("id").alias("x")).hint("merge")
    right = members.select("t", F.col("rep").alias("b"), F.col("id").alias("y")).hint("merge")
    across = links.hint("merge").join(left, ["t", "a"]).join(right, ["t", "b"]).select("table_name", F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
    return across.unionByName(copies(members))


def groups(records: DataFrame) -> DataFrame:
    """(table_name, id, class_id, group_id, links): one row per record that has eight words or more.

    class_id is the least id with the same words, group_id the least id in its group of
    linked classes, links the number of other classes its class is linked to.
    """
    links, members = near_duplicates(records)
    out = []
    for row in members.select("table_name", "t").distinct().collect():  # one row per table of the query
        mine = links.where(F.col("t") == row["t"]).select("a", "b")
        group = components(mine).withColumnRenamed("node", "rep").hint("merge")
        ends = mine.select(F.col("a").alias("rep")).unionByName(mine.select(F.col("b").alias("rep"))).groupBy("rep").agg(F.count(F.lit(1)).alias("links")).hint("merge")
        joined = members.where(F.col("t") == row["t"]).join(group, "rep", "left").join(ends, "rep", "left")
        out.append(joined.select(F.lit(row["table_name"]).alias("table_name"), "id", F.col("rep").alias("class_id"), F.coalesce("component", "rep").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links")))
    if not out:
        return records.sparkSession.createDataFrame([], "table_name string, id bigint, class_id bigint, group_id bigint, links bigint")
    return reduce(DataFrame.unionByName, out)


def default_records(spark: SparkSession, read) -> DataFrame:
    """Problem descriptions and seed problems as (table_name, id, text)."""
    a = read("problem_metadata").select(F.lit("problem_metadata").alias("table_name"), F.col("problem_key").alias("id"), F.col("problem_description").alias("text"))
    b = read("matched_pairs").select(F.lit("matched_pairs").alias("table_name"), F.col("pair_id").alias("id"), F.col("problem").alias("text"))
    return a.unionByName(b)
