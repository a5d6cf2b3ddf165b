"""Best-fit decreasing packing of token sequences (operator 8).

Overlong documents are first cut into full windows; the rest of a document is one piece.  Lengths
are integers up to the window, so best-fit decreasing needs only how many pieces have each length: the
pieces of one length are placed in bulk, always into the open windows with the least room that
holds them, which a segment tree over the remaining capacity finds.  The plan is a short list of runs
(``k`` pieces of a length per window, from a window, at an offset), whose size depends on the
window and not on the corpus.  Tasks then look up the place of each piece by its rank within its length.

Documents are tokenized once.  The vocabulary is that of ``byte_bpe_50k.json``, read as merge ranks
(``byte_bpe_50k.tiktoken``), which gives the same ids several times faster.

Defined cases: a null or empty text is the closing id alone; a null doc_id stays null; repeated rows
are packed each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtline.llm.shared import exact, opaque, saved, text_of

WINDOW = 1024
CLOSING = 0
SPECIAL = {"<|endoftext|>": 50256}

_encoders: dict[str, object] = {}


def vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(path: str):
    if path not in _encoders:
        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                            special_tokens=SPECIAL)
    return _encoders[path]


class Tree:
    """Which capacities 0..size have an open window; finds the least one not below a bound."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, at: int, value: bool) -> None:
        at += self.leaves
        self.any[at] = value
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def least_from(self, low: int) -> int | None:
        at = low + self.leaves
        if self.any[at]:
            return low
        while at > 1:  # up to the first right sibling that has one, then down its left edge
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.any[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def plan(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing of ``counts[length]`` pieces: runs (length, first rank, first sequence, pieces
    per sequence, first offset), ordered by length and rank.  The capacity left in a window tells its offset."""
    tree, room, runs, sequences = Tree(window), [deque() for _ in range(window + 1)], [], 0

    def put(capacity: int, first: int, n: int) -> None:
        if n and capacity:
            room[capacity].append((first, n))
            tree.set(capacity, True)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            capacity = tree.least_from(length)
            if capacity is None:
                capacity, first = window, sequences
                n = -(-left // (window // length))
                sequences += n
            else:
                first, n = room[capacity].popleft()
                tree.set(capacity, bool(room[capacity]))
            each = capacity // length
            full = min(n, left // each)
            runs.append((length, rank, first, each, window - capacity))
            put(capacity - each * length, first, full)
            rank, left = rank + full * each, left - full * each
            if full < n and left:  # fewer than fill a window are left
                put(capacity - left * length, first + full, 1)
                full, rank, left = full + 1, rank + left, 0
            put(capacity, first + full, n - full)
    return runs


PIECES = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, part int, place long, rank long"


def _cut(path: str, window: int, with_ids: bool):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, met, place = encoder(path), Counter(), 0
        part = TaskContext.get().partitionId()
        for b in batches:
            rows = []
            for doc, text in zip(b["doc_id"].tolist(), b["text"].tolist()):
                ids = np.array([*coder.encode(text, allowed_special="all"), CLOSING], "<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start:start + window]
                    n = len(piece)
                    rows.append((doc, start, n, zlib.crc32(piece.tobytes()), len(ids), part, place, met[n],
                                 *([piece.astype(np.int32)] if with_ids else [])))
                    met[n] += 1
                    place += 1
            names = [c.split()[0] for c in PIECES.split(", ")] + ["ids"] * with_ids
            yield pd.DataFrame(rows, columns=names)
    return cut


def _placed(shared):
    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs = shared.value
        # runs are ordered by (-length, rank): one number orders them, as ranks stay below 2 ** 50
        keys = [(-int(r[0]) << 50) + int(r[1]) for r in runs]
        keys, table = np.array(keys, np.int64), np.array(runs, np.int64).reshape(-1, 5)
        for b in batches:
            rank = b["rank"].to_numpy(np.int64) + b["before"].to_numpy(np.int64)
            length = b["length"].to_numpy(np.int64)
            run = table[np.searchsorted(keys, (-length << 50) + rank, "right") - 1]
            at = rank - run[:, 1]
            b["sequence_id"] = run[:, 2] + at // run[:, 3]
            b["offset"] = run[:, 4] + at % run[:, 3] * length
            yield b.drop(columns=["part", "place", "rank", "before"])
    return placed


def pack(docs: DataFrame, window: int = WINDOW, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with
    ``with_ids`` the token ids, so that sorting by sequence and offset gives the training sequences."""
    spark = docs.sparkSession
    pieces = saved(opaque(text_of(docs), "doc_id").mapInPandas(_cut(path or vocabulary(), window, with_ids),
                                                               PIECES + ", ids array<int>" * with_ids), "pieces")
    per_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(plan(counts, window))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    out = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    placed = pieces.join(before, ["part", "length"]).select(*pieces.columns, "before") \
        .mapInPandas(_placed(shared), out + ", sequence_id long, offset long")
    return exact(placed, "doc_id")
