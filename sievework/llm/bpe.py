"""Byte-level BPE over a whole corpus with padded numpy matrices.

Pieces of a text (cut by the vocabulary's public pattern) are collected once per
chunk, put into matrices by length, and merged together: in each round every row
merges its leftmost pair of least rank, found in a hashed pair table, and is
compacted by one column. Rows without a pair left leave the matrix.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the pattern published with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
NONE = np.int32(2**31 - 1)
SLOTS_LOG2 = 20
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Pieces longer than this many bytes are merged one at a time with a heap.
LONGEST_ROW = 768
#: Characters of text handled at once by a worker; bounds its memory.
CHUNK_CHARS = 1_500_000
#: Bytes of pieces a worker remembers before it starts afresh.
CACHE_BYTES = 16_000_000


def load_ranks(path: str = DEFAULT_VOCABULARY) -> dict[bytes, int]:
    """Token bytes to id, from a file of "base64 rank" lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def build_tables(ranks: dict[bytes, int]) -> dict[str, np.ndarray]:
    """Byte ids and the open-addressing table (id, id) -> merged id."""
    keys, values = [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                keys.append(left << 32 | right)
                values.append(rank)
    mask = (1 << SLOTS_LOG2) - 1
    if len(keys) * 2 > mask:
        raise ValueError("the vocabulary has too many pairs for the table")
    slots, found = np.full(mask + 1, -1, np.int64), np.full(mask + 1, NONE, np.int32)
    home = first_slot(np.array(keys, np.int64))
    for key, value, slot in zip(keys, values, home.tolist()):
        while slots[slot] != -1:
            slot = slot + 1 & mask
        slots[slot], found[slot] = key, value
    byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
    if (byte_ids < 0).any():
        raise ValueError("the vocabulary lacks single bytes")
    return {"slots": slots, "found": found, "bytes": byte_ids}


def first_slot(keys: np.ndarray) -> np.ndarray:
    return (keys.astype(np.uint64) * MIX >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)


def pair_ids(tables: dict[str, np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Merged id of each pair, NONE where there is none or an operand is padding (-1)."""
    keys = left.astype(np.int64) << 32 | right.astype(np.int64)
    out = np.full(keys.shape, NONE, np.int32)
    todo = np.flatnonzero((left >= 0) & (right >= 0))
    flat, want = out.reshape(-1), keys.reshape(-1)[todo]
    slot, mask = first_slot(want), (1 << SLOTS_LOG2) - 1
    while todo.size:
        there = tables["slots"][slot]
        hit = there == want
        flat[todo[hit]] = tables["found"][slot[hit]]
        on = ~hit & (there != -1)
        todo, want, slot = todo[on], want[on], slot[on] + 1 & mask
    return out


def merge_rows(tables: dict[str, np.ndarray], rows: np.ndarray) -> list[np.ndarray]:
    """Ids of each row of byte ids; rows are padded with -1 on the right."""
    done: list[np.ndarray] = [np.empty(0, np.int32)] * len(rows)
    which, at = np.arange(len(rows)), np.arange(len(rows))
    ranks = pair_ids(tables, rows[:, :-1], rows[:, 1:])
    while len(rows):
        if ranks.shape[1]:
            best = ranks.argmin(axis=1)
            least = ranks[at, best]
        else:
            best, least = np.zeros(len(rows), np.int64), np.full(len(rows), NONE)
        alive = least != NONE
        if not alive.all():
            for k, row in zip(which[~alive].tolist(), rows[~alive]):
                done[k] = row[row >= 0]
            rows, ranks, which, best, least = rows[alive], ranks[alive], which[alive], best[alive], least[alive]
            at = np.arange(len(rows))
            if not len(rows):
                break
        count, width = rows.shape
        rows[at, best] = least
        keep = np.ones((count, width), bool)
        keep[at, best + 1] = False
        rows = rows[keep].reshape(count, width - 1)
        ranks = ranks[keep[:, 1:]].reshape(count, width - 2)
        for column in (best - 1, best):
            fit = np.flatnonzero((column >= 0) & (column < width - 2))
            if fit.size:
                c = column[fit]
                ranks[fit, c] = pair_ids(tables, rows[fit, c], rows[fit, c + 1])
    return done


def merge_long(tables: dict[str, np.ndarray], ids: np.ndarray) -> np.ndarray:
    """The same for one very long row: linked list and heap, O(n log n)."""
    import heapq

    n = len(ids)
    token, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
    ranks = pair_ids(tables, ids[:-1], ids[1:])
    heap = [(int(r), k, token[k], token[k + 1]) for k, r in enumerate(ranks) if r != NONE]
    heapq.heapify(heap)
    gone = bytearray(n)
    while heap:
        rank, k, left, right = heapq.heappop(heap)
        j = after[k]
        if gone[k] or j >= n or token[k] != left or token[j] != right:
            continue
        token[k], gone[j], after[k] = rank, 1, after[j]
        if after[j] < n:
            before[after[j]] = k
        for a, b in ((before[k], k), (k, after[k])):
            if a >= 0 and b < n:
                r = int(pair_ids(tables, np.array([token[a]]), np.array([token[b]]))[0])
                if r != NONE:
                    heapq.heappush(heap, (r, a, token[a], token[b]))
    return np.array([token[k] for k in range(n) if not gone[k]], np.int32)


def encode_pieces(tables: dict[str, np.ndarray], pieces: list[bytes]) -> list[np.ndarray]:
    """Ids of each piece: rows of like length share a matrix."""
    out: list[np.ndarray] = [np.empty(0, np.int32)] * len(pieces)
    lengths = np.array([len(p) for p in pieces], np.int64)
    for k in np.flatnonzero(lengths > LONGEST_ROW).tolist():
        out[k] = merge_long(tables, tables["bytes"][np.frombuffer(pieces[k], np.uint8)])
    edges = [1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512, LONGEST_ROW]
    for low, high in zip([0, *edges], edges):
        of = np.flatnonzero((lengths > low) & (lengths <= high))
        step = max(1, 4_000_000 // high)
        for start in range(0, len(of), step):
            some = of[start : start + step]
            size = lengths[some]
            rows = np.full((len(some), high), -1, np.int32)
            rows[np.arange(high) < size[:, None]] = tables["bytes"][np.frombuffer(b"".join(pieces[k] for k in some.tolist()), np.uint8)]
            for k, ids in zip(some.tolist(), merge_rows(tables, rows)):
                out[k] = ids
    return out


class Encoder:
    """Encodes chunks of texts; remembers pieces it has met, within a bound."""

    def __init__(self, tables: dict[str, np.ndarray]):
        self.tables, self.split = tables, regex.compile(PATTERN)
        self.codes: dict[str, int] = {}
        self.ids: list[np.ndarray] = []
        self.held = 0

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the offsets of each; null and empty texts have none."""
        if self.held > CACHE_BYTES:
            self.codes, self.ids, self.held = {}, [], 0
        codes, new, used, counts = self.codes, [], [], []
        for text in texts:
            pieces = self.split.findall(text) if text else []
            counts.append(len(pieces))
            for piece in pieces:
                code = codes.get(piece)
                if code is None:
                    code = codes[piece] = len(codes)
                    new.append(piece)
                used.append(code)
        if new:
            raw = [p.encode("utf-8", "surrogatepass") for p in new]
            self.ids.extend(encode_pieces(self.tables, raw))
            self.held += sum(map(len, raw)) + 100 * len(raw)
        sizes = np.array([len(x) for x in self.ids], np.int64)
        begins = np.concatenate([[0], np.cumsum(sizes)])
        pool = np.concatenate(self.ids) if self.ids else np.empty(0, np.int32)
        used_codes = np.array(used, np.int64)
        size = sizes[used_codes] if len(used_codes) else np.empty(0, np.int64)
        ends = np.concatenate([[0], np.cumsum(size)])
        places = np.arange(ends[-1]) + np.repeat(begins[used_codes] - ends[:-1], size) if len(size) else np.empty(0, np.int64)
        offsets = ends[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        return pool[places].astype(np.int32), offsets


def chunks_of(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most CHUNK_CHARS characters together (one row at least)."""
    start, chars = 0, 0
    for k, text in enumerate(texts):
        size = len(text or "")
        if chars + size > CHUNK_CHARS and k > start:
            yield start, k
            start, chars = k, 0
        chars += size
    if start < len(texts):
        yield start, len(texts)


def vocabulary(spark: SparkSession, path: str = DEFAULT_VOCABULARY):
    """The tables, broadcast: 13 MB whatever the corpus, for the vocabulary is fixed."""
    return spark.sparkContext.broadcast(build_tables(load_ranks(path)))


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """(id, ids array<int>) of every row, without special tokens.

    Null and empty texts give an empty list, blank texts are encoded as they are;
    a null id and repeated rows stay as they come; other columns are left out; an
    empty table gives an empty table. Narrow: one pass, no shuffle.
    """
    tables = vocabulary(df.sparkSession, path)

    def run(batches):
        encoder = Encoder(tables.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in chunks_of(texts):
                flat, offsets = encoder(texts[a:b])
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], ids], names=["id", "ids"])

    source = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "id bigint, ids array<int>").withColumnRenamed("id", id_col)


def count_tokens(df: DataFrame, text_col: str = "text", out: str = "tokens", path: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``df`` with a bigint column of token counts; null and empty texts count 0."""
    tables = vocabulary(df.sparkSession, path)
    fields = [f for f in df.schema.fields if f.name not in (text_col, out)]

    def run(batches):
        encoder = Encoder(tables.value)
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = batch.column(at).to_pylist()
            counts = [np.diff(encoder(texts[a:b])[1]) for a, b in chunks_of(texts)]
            rest = [batch.column(k) for k in range(batch.num_columns) if k != at]
            names = [n for n in batch.schema.names if n != text_col]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(np.concatenate(counts) if counts else [], pa.int64())], names=[*names, out])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"`{out}` bigint"])
    return df.select(*(F.col(f"`{f.name}`") for f in fields), F.col(text_col).cast("string").alias(text_col)).mapInArrow(run, schema)
