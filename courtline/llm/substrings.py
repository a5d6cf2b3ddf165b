"""Removal of repeated 400-byte strings with a difference-cover sample of suffixes (operator 9).

A byte goes if a ``WINDOW``-byte string that also starts anywhere else covers it.  The difference-cover
algorithm, bounded to the depth that matters:

1. Of each text the suffixes at positions p with p mod ``PERIOD`` in ``COVER`` are sampled.  The cover
   holds every difference, so two equal windows, wherever they start, have sampled suffixes at the
   same place inside them, within ``PERIOD - 1`` bytes, and these share at least ``PREFIX`` bytes.
2. A sampled suffix is named by its first ``PREFIX`` bytes, a 64-bit name instead of a rank, so that names need
   no recursion by levels.  Names are sorted within ranges of the name space, and equal neighbours are
   repeated names.
3. The remaining suffixes are merged in where they matter: a start with a repeated sampled suffix in its
   first ``PERIOD`` bytes is named by its first ``WINDOW`` bytes; these names are sorted and equal
   neighbours are repeated windows, whose bytes go.

Texts lie in blocks of about ``BLOCK`` bytes, written once.  A block sends each of its names once, with a
mark if it has it twice, so a passage that a third of all texts hold is one name per block and no range of
names grows with it.  What is repeated comes back as a bit per name sent.  Whole copies of a text are grouped
by digest first: the first one alone takes part.

The name of a window is 64 bits and comes with a second, independent one of 32: two different windows among n are
taken as equal with probability about n^2 / 2^97, 6e-4 for 1e13 of them.  A false name of a sampled suffix only names
more windows.

In the same two passes, over words in place of bytes, passages of over 50 words that another document holds too are
found (``n_passage_words``, the words they cover): a passage of shorter words may have under ``WINDOW`` bytes, and what
only repeats inside its own document is no such passage.  Words stand between white space and compare byte by byte.

Memory of a task: about 100 bytes for each byte of the longest text, which is taken in one piece, besides some
100 MB for blocks and names.

Defined cases: a null or empty text has no bytes and its remainder is empty; a null doc_id stays null;
repeated rows are copies of each other; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.neardup import mixed
from courtline.llm.shared import exact, opaque, saved, scratch, shuffles_removed, text_of

WINDOW = 400
# fixed values: a perfect difference set (each difference modulo 133 occurs once)
PERIOD, COVER = 133, (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)
PREFIX = WINDOW - PERIOD + 1
# fixed values: the same modulo 31, for passages
WORDS, WORD_PERIOD, WORD_COVER = 51, 31, (1, 5, 11, 24, 25, 27)
WORD_PREFIX = WORDS - WORD_PERIOD + 1
BLOCK = 1_000_000
RANGE_BYTES = 8_000_000  # of names in a range; of windows twice as much if every byte starts a candidate
_BASE = 0x2545F4914F6CDD1D
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])

_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64, for texts of up to n bytes."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, n.bit_length())
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.ones(1, np.uint64)
            while len(p) < size:
                p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
            _powers[key] = p
    return _powers["up"], _powers["down"]


class Prefixes:
    """Names of the strings of a text (of bytes, or names of words) by place and length, from sums of its powers."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.sums, self.down = self._summed(data.astype(np.uint64) + np.uint64(1))

    @staticmethod
    def _summed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        up, down = _power(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:len(values)], out=sums[1:])
        return sums, down

    def names(self, at: np.ndarray, length) -> np.ndarray:
        return mixed((self.sums[at + length] - self.sums[at]) * self.down[at])

    def seconds(self, at: np.ndarray, length: int) -> np.ndarray:
        """Names of 32 bits that do not follow from the others: the same sums over scrambled values."""
        if not len(at):
            return np.empty(0, np.uint32)
        sums, down = self._summed(mixed(self.data.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
        return (mixed((sums[at + length] - sums[at]) * down[at]) >> np.uint64(32)).astype(np.uint32)


def sampled(n: int) -> np.ndarray:
    """The places of the cover in a text of n bytes whose suffix has ``PREFIX`` bytes."""
    at = (np.arange(0, max(0, n - PREFIX + 1), PERIOD)[:, None] + np.array(COVER)).ravel()
    return at[at <= n - PREFIX] if n >= WINDOW else at[:0]


def near(at: np.ndarray, n: int) -> np.ndarray:
    """The window starts with one of the places ``at`` within their first ``PERIOD`` bytes."""
    if not len(at):
        return at
    edge = np.zeros(n + 2, np.int32)
    np.add.at(edge, np.maximum(at - PERIOD + 1, 0), 1)
    np.add.at(edge, at + 1, -1)
    starts = np.flatnonzero(np.cumsum(edge) > 0)
    return starts[starts <= n - WINDOW]


def removed(starts: np.ndarray, n: int) -> np.ndarray:
    """The maximal runs (first, end) that windows at the sorted ``starts`` cover."""
    if not len(starts):
        return np.empty((0, 2), np.int64)
    gap = np.flatnonzero(np.diff(starts) > WINDOW)
    return np.stack([starts[np.r_[0, gap + 1]], starts[np.r_[gap, len(starts) - 1]] + WINDOW], 1)


# ---------------------------------------------------------------- blocks

BLOCKS = "part int, block int, ids array<string>, lengths array<int>, digests array<binary>, data binary"


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    part, block = TaskContext.get().partitionId(), 0
    ids, texts, size = [], [], 0

    def row() -> pd.DataFrame:
        return pd.DataFrame({"part": [part], "block": [block], "ids": [ids], "lengths": [[len(t) for t in texts]],
                             "digests": [[hashlib.blake2b(t, digest_size=16).digest() for t in texts]], "data": [b"".join(texts)]})

    for b in batches:
        for i, text in zip(b["doc_id"].tolist(), b["text"].tolist()):
            raw = text.encode("utf-8", "surrogatepass")
            if texts and size + len(raw) > BLOCK:
                yield row()
                block, ids, texts, size = block + 1, [], [], 0
            ids.append(i)
            texts.append(raw)
            size += len(raw)
    if texts:
        yield row()


class Sent:
    """What came back for the blocks of a part, from the folder that holds it."""

    def __init__(self, folder: str):
        self.fs, self.root = pafs.FileSystem.from_uri(folder)
        self.part, self.rows = None, {}

    def of(self, part: int, block: int) -> list[dict]:
        if part != self.part:
            path, self.part, self.rows = f"{self.root}/part={part}", part, {}
            if self.fs.get_file_info(path).type != pafs.FileType.NotFound:
                for f in self.fs.get_file_info(pafs.FileSelector(path)):
                    if f.path.endswith(".parquet"):
                        with self.fs.open_input_file(f.path) as file:
                            for r in pq.ParquetFile(file).read().to_pylist():
                                self.rows.setdefault(r["block"], []).append(r)
        return self.rows.get(block, [])


def _send_back(df: DataFrame, tag: str) -> str:
    """Write rows that name a part and block so that a task can open those of its part alone."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    path = path if "://" in path else f"file://{path.removeprefix('file:')}"
    with shuffles_removed(spark):
        df.repartition("part").write.partitionBy("part").parquet(path)
    return path


def _texts(r, copies: Sent) -> Iterator[tuple[int, np.ndarray]]:
    """The texts of a block that take part: (place, bytes)."""
    skip = {c["place"] for c in copies.of(r.part, r.block) if not c["first"]}
    data, end = np.frombuffer(r.data, np.uint8), np.cumsum(r.lengths)
    for k, n in enumerate(r.lengths):
        if k not in skip and n >= WORDS:
            yield k, data[end[k] - n:end[k]]


def _batched(texts: Iterator[tuple[int, np.ndarray]]) -> Iterator[tuple[list[tuple[int, int, int]], np.ndarray]]:
    """Consecutive texts joined to about a megabyte: the places (text, offset, length) and the bytes."""
    held, size = [], 0

    def one():
        offsets = np.cumsum([0] + [len(x) for _, x in held])
        return [(k, int(o), len(x)) for (k, x), o in zip(held, offsets)], np.concatenate([x for _, x in held])

    for k, x in texts:
        held.append((k, x))
        size += len(x)
        if size > 1_000_000:
            yield one()
            held, size = [], 0
    if held:
        yield one()


class ByteSide:
    """The 400-byte windows of a batch of texts."""

    def __init__(self, spots: list[tuple[int, int, int]], data: np.ndarray, prefixes: Prefixes):
        self.spots, self.prefixes = spots, prefixes
        self.at = [sampled(n) + o for _, o, n in spots]

    def names(self) -> tuple[np.ndarray, None]:
        return self.prefixes.names(np.concatenate(self.at), PREFIX), None

    def windows(self, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, None]:
        """Names and second names of the windows that hold a repeated sampled suffix; keeps where they start."""
        self.starts, done = [], 0
        for (_, o, n), at in zip(self.spots, self.at):
            self.starts.append(near(at[flags[done:done + len(at)]] - o, n))
            done += len(at)
        at = np.concatenate([s + o for s, (_, o, _) in zip(self.starts, self.spots)])
        return self.prefixes.names(at, WINDOW), self.prefixes.seconds(at, WINDOW), None

    def found(self, flags: np.ndarray) -> dict[int, np.ndarray]:
        """The removed runs by text."""
        out, done = {}, 0
        for (k, _, n), s in zip(self.spots, self.starts):
            out[k] = removed(s[flags[done:done + len(s)]], n)
            done += len(s)
        return out


class WordSide:
    """The windows of ``WORDS`` words of a batch of texts; owners are the texts, as repeats count across them."""

    def __init__(self, spots: list[tuple[int, int, int]], data: np.ndarray, prefixes: Prefixes):
        self.spots = spots
        inside, offsets = ~_SPACE[data], np.array([o for _, o, _ in spots])
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        first = np.flatnonzero(inside & (edge[:-1] | ~np.r_[False, inside[:-1]]))
        last = np.flatnonzero(inside & (edge[1:] | ~np.r_[inside[1:], False]))
        self.text = np.searchsorted(offsets, first, "right") - 1
        names = prefixes.names(first, last + 1 - first)
        self.prefixes = Prefixes(names)
        self.begin = np.searchsorted(self.text, np.arange(len(spots)))  # first word of each text
        self.end = np.searchsorted(self.text, np.arange(len(spots)), "right")
        place = np.arange(len(first)) - self.begin[self.text]
        fits = place + WORD_PREFIX <= (self.end - self.begin)[self.text]
        self.at = np.flatnonzero(np.isin(place % WORD_PERIOD, WORD_COVER) & fits & ((self.end - self.begin)[self.text] >= WORDS))

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        return self.prefixes.names(self.at, WORD_PREFIX), self.text[self.at]

    def windows(self, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = self.at[flags]
        edge = np.zeros(len(self.text) + 1, np.int32)
        np.add.at(edge, np.maximum(at - WORD_PERIOD + 1, self.begin[self.text[at]]), 1)
        np.add.at(edge, at + 1, -1)
        starts = np.flatnonzero(np.cumsum(edge) > 0)
        self.starts = starts[starts + WORDS <= self.end[self.text[starts]]] if len(starts) else starts
        return self.prefixes.names(self.starts, WORDS), self.prefixes.seconds(self.starts, WORDS), self.text[self.starts]

    def found(self, flags: np.ndarray) -> dict[int, int]:
        """The words in shared passages by text."""
        hits = self.starts[flags]
        edge = np.zeros(len(self.text) + 1, np.int32)
        np.add.at(edge, hits, 1)
        np.add.at(edge, hits + WORDS, -1)
        covered = np.bincount(self.text[np.cumsum(edge[:-1]) > 0], minlength=len(self.spots))
        return {k: int(n) for (k, _, _), n in zip(self.spots, covered)}


SIDES = (ByteSide, WordSide)


def _sides(r, copies: Sent) -> list[list]:
    """The batches of a block by side."""
    out: list[list] = [[] for _ in SIDES]
    for spots, data in _batched(_texts(r, copies)):
        prefixes = Prefixes(data)
        for k, side in enumerate(SIDES):
            out[k].append(side(spots, data, prefixes))
    return out


def _owners(parts: list, batches: list) -> np.ndarray | None:
    """The texts of names, told apart over the batches of a block."""
    if not parts or parts[0] is None:
        return None
    return np.concatenate([np.array([k for k, _, _ in b.spots])[p] if len(p) else p for b, p in zip(batches, parts)])


def _all_names(batches: list) -> tuple[np.ndarray, np.ndarray | None]:
    got = [b.names() for b in batches]
    return _joined([n for n, _ in got], np.uint64), _owners([o for _, o in got], batches)


def _all_windows(batches: list, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    got, done = [], 0
    for b in batches:
        n = sum(map(len, b.at)) if isinstance(b.at, list) else len(b.at)
        got.append(b.windows(flags[done:done + n]))
        done += n
    return _joined([n for n, _, _ in got], np.uint64), _joined([c for _, c, _ in got], np.uint32), _owners([o for _, _, o in got], batches)


def _joined(parts: list, kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, kind)


def _dealt(names: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct names, one place of each, where each range of them starts, and each name's place among them."""
    u, first, inverse = np.unique(names, return_index=True, return_inverse=True)
    # ranges of the sorted names, so that within a range they stay sorted
    edges = np.searchsorted(u >> np.uint64(32), (np.arange(ranges + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(ranges))
    return u, first, edges, inverse


def _cells(r, side: int, names: np.ndarray, ranges: int, owners: np.ndarray | None, seconds: np.ndarray | None) -> pd.DataFrame:
    """The names of a block by range, each once, with a bit if it occurs twice (or, with owners, in two texts)."""
    u, first, edges, inverse = _dealt(names, ranges)
    if owners is None:
        twice = np.bincount(inverse, minlength=len(u)) > 1
    else:
        twice = np.zeros(len(u), bool)
        twice[inverse[owners != owners[first][inverse]]] = True
    full = [k for k in range(ranges) if edges[k] < edges[k + 1]]
    return pd.DataFrame({"side": side, "range": full, "part": r.part, "block": r.block, "names": [u[edges[k]:edges[k + 1]].tobytes() for k in full],
                         "seconds": [None if seconds is None else seconds[first[edges[k]:edges[k + 1]]].tobytes() for k in full],
                         "twice": [np.packbits(twice[edges[k]:edges[k + 1]]).tobytes() for k in full]})


CELLS = "side int, range int, part int, block int, names binary, seconds binary, twice binary"
BITS = "part int, block int, side int, range int, bits binary"


def _repeated(cells: pd.DataFrame) -> pd.DataFrame:
    """Of the names of a range, block by block, the bits that say which occur anywhere else too."""
    every = np.concatenate([np.frombuffer(x, np.uint64) for x in cells["names"]])
    seconds = None if cells["seconds"].iloc[0] is None else np.concatenate([np.frombuffer(x, np.uint32) for x in cells["seconds"]])
    order = np.argsort(every, kind="stable")
    same = every[order[1:]] == every[order[:-1]]
    if seconds is not None:
        differ = seconds[order[1:]] != seconds[order[:-1]]
        if (same & differ).any():  # one name of two strings: their second names tell them apart
            order = np.lexsort((seconds, every))
            same, differ = every[order[1:]] == every[order[:-1]], seconds[order[1:]] != seconds[order[:-1]]
        same &= ~differ
    again = np.zeros(len(every), bool)  # in two blocks: neighbours in sorted order
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    out, done = [], 0
    for x, t in zip(cells["names"], cells["twice"]):
        n = len(x) // 8
        out.append(np.packbits(again[done:done + n] | np.unpackbits(np.frombuffer(t, np.uint8), count=n).astype(bool)).tobytes())
        done += n
    return pd.DataFrame({"part": cells["part"], "block": cells["block"], "side": cells["side"], "range": cells["range"], "bits": out})


def _flags(names: np.ndarray, side: int, ranges: int, sent: list[dict]) -> np.ndarray:
    """Per name (in the order given) whether it is repeated."""
    u, _, edges, inverse = _dealt(names, ranges)
    flag = np.zeros(len(u), bool)
    for s in sent:
        if s["side"] == side:
            a, b = edges[s["range"]], edges[s["range"] + 1]
            flag[a:b] = np.unpackbits(np.frombuffer(s["bits"], np.uint8), count=b - a).astype(bool)
    return flag[inverse]


def _first_pass(copies_at: str, ranges: list[int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        copies = Sent(copies_at)
        for b in batches:
            for r in b.itertuples():
                for side, work in enumerate(_sides(r, copies)):
                    names, owners = _all_names(work)
                    yield _cells(r, side, names, ranges[side], owners, None)
    return run


def _second_pass(copies_at: str, first_at: str, ranges: list[int], window_ranges: list[int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        copies, first = Sent(copies_at), Sent(first_at)
        for b in batches:
            for r in b.itertuples():
                for side, work in enumerate(_sides(r, copies)):
                    flags = _flags(_all_names(work)[0], side, ranges[side], first.of(r.part, r.block))
                    names, seconds, owners = _all_windows(work, flags)
                    yield _cells(r, side, names, window_ranges[side], owners, seconds)
    return run


def _last_found(r, work: list, side: int, first: Sent, second: Sent, ranges: list[int], window_ranges: list[int]) -> dict:
    flags = _flags(_all_names(work)[0], side, ranges[side], first.of(r.part, r.block))
    names = _all_windows(work, flags)[0]
    flags, found, done = _flags(names, side, window_ranges[side], second.of(r.part, r.block)), {}, 0
    for b in work:
        n = sum(map(len, b.starts)) if isinstance(b.starts, list) else len(b.starts)
        found |= b.found(flags[done:done + n])
        done += n
    return found


OUT = "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passage_words long, spans array<struct<first:long,end:long>>"


def _last_pass(copies_at: str, first_at: str, second_at: str, ranges: list[int], window_ranges: list[int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        copies, first, second = Sent(copies_at), Sent(first_at), Sent(second_at)
        for b in batches:
            for r in b.itertuples():
                work = _sides(r, copies)
                runs, words = (_last_found(r, work[k], k, first, second, ranges, window_ranges) for k in range(len(SIDES)))
                copied, rows, end = {c["place"] for c in copies.of(r.part, r.block)}, [], np.cumsum(r.lengths)
                for k, (i, n) in enumerate(zip(r.ids, r.lengths)):
                    data = r.data[end[k] - n:end[k]]
                    n_words = words.get(k, 0)
                    if k in copied:  # a text with a copy is repeated as a whole
                        n_words = len(data.split())
                        n_words = n_words if n_words >= WORDS else 0
                    cut = [(0, n)] if k in copied and n >= WINDOW else runs.get(k, ())
                    kept, at = hashlib.sha256(), 0
                    for a, e in cut:
                        kept.update(data[at:a])
                        at = e
                    kept.update(data[at:])
                    rows.append((i, int(n), int(sum(e - a for a, e in cut)), len(cut), kept.hexdigest(), n_words,
                                 [{"first": int(a), "end": int(e)} for a, e in cut]))
                yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_words", "spans"])
    return run


def repeated_substrings(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passage_words and the removed byte spans."""
    spark = docs.sparkSession
    table = saved(opaque(text_of(docs), "doc_id").mapInPandas(_blocks, BLOCKS), "text-blocks")
    size = table.agg(F.sum(F.octet_length("data").cast("long")).alias("n")).first()["n"] or 0
    # a byte gives len(COVER) / PERIOD sampled names of eight bytes, and a window at most; a word has five bytes and more
    of = lambda names, each: max(12, -(-int(names * 8) // (each * RANGE_BYTES)))
    ranges = [of(size * len(COVER) / PERIOD, 1), of(size / 5 * len(WORD_COVER) / WORD_PERIOD, 1)]
    window_ranges = [of(size, 2), of(size / 5, 2)]
    each = table.select("part", "block", F.posexplode(F.arrays_zip("digests", "lengths")).alias("place", "x")) \
        .select("part", "block", "place", F.col("x.digests").alias("digest"), F.col("x.lengths").alias("n")).filter(F.col("n") >= WORDS)
    groups = each.groupBy("digest", "n").agg(F.min(F.struct("part", "block", "place")).alias("head"), F.count("*").alias("c")) \
        .filter("c > 1").select("digest", "n", "head")
    # the groups are written first, so that Spark can split the join of a large group
    copies = each.join(saved(groups, "copied-texts"), ["digest", "n"]).select(
        "part", "block", "place", (F.col("head") == F.struct("part", "block", "place")).alias("first"))
    copies_at = _send_back(copies, "copies")
    first_at = _exchanged(table, _first_pass(copies_at, ranges), "repeated-samples")
    second_at = _exchanged(table, _second_pass(copies_at, first_at, ranges, window_ranges), "repeated-windows")
    return exact(table.mapInPandas(_last_pass(copies_at, first_at, second_at, ranges, window_ranges), OUT), "doc_id")


def _exchanged(table: DataFrame, names, tag: str) -> str:
    """Names go out by range and come back as bits by part."""
    return _send_back(table.mapInPandas(names, CELLS).groupBy("side", "range").applyInPandas(_repeated, BITS), tag)
