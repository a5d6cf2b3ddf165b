"""Benchmark decontamination by CGK embedding and bit-sampling LSH (operator 1).

Texts are word sequences (A-Z in lower case; ASCII characters other than letters and digits
separate; of scripts that put no spaces between words each character is a word).  A document holds an item if a stretch of it lies within ``floor(share * words)`` word
edits of the whole item.  Items go to the tasks in blocks of bounded size, so any number of items can
be searched; documents are never shuffled.

For every start in a text the CGK random walk emits a symbol per step and advances or stays by a
random bit of (walk, step, symbol).  It maps edit distance to Hamming distance: after an edit, two
walks drift and meet again.  A key is the symbols at ``SAMPLED`` random steps; ``WALKS * SAMPLES`` keys
per window are looked up among those of the items of its length class.  A start whose window holds fewer
word pairs of any item than a match leaves whole (an edit breaks two) cannot match and is skipped.
Each find is verified by exact edit distance.

The more words a walk crosses, the rarer keys without an edit on the way are.  So an item of over ``WHOLE`` words is looked up by its pieces
of at most ``PIECE`` words: of a match within the allowed distance some piece is edited no more than its own share, and each
piece that meets a key leads to the whole item.

An exact copy shares all keys but those whose walk has left the item.  ``recall`` gives the share of edited copies that meet in some key, by
simulation; up to a fifth of the words edited, the allowed distance, it is above 0.95 whatever the length (see the tests).

Items of under ``MIN_WORDS`` words, whose fifth is no word, are looked up as exact word sequences.

Defined cases: null or empty texts hold nothing; items without a word are held by nothing; a null item or doc id stays null in the result; rows repeated in either table repeat
in the result; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.neardup import Words, mixed
from courtline.llm.shared import exact, opaque, ship, text_of

MIN_WORDS = 5
SHARE = 0.2
WALKS, SAMPLES, SAMPLED = 12, 4, 3
WHOLE, PIECE = 60, 45
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 16_000_000

_SEPARATED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_GOLD = np.uint64(0x9E3779B97F4A7C15)

# fixed values: blocks of scripts written without spaces (Thai to Tibetan, Burmese, Khmer, kana and Chinese characters)
_UNSPACED = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_ALONE = re.compile(f"[{_UNSPACED}]")
_WORD = re.compile(f"[{_UNSPACED}]|(?:(?![{_UNSPACED}])[0-9A-Za-z\u0080-\U0010ffff])+")


def word_hashes(text: str, hashes: Words) -> np.ndarray:
    raw = text.encode("utf-8", "surrogatepass")
    if not text.isascii() and (np.frombuffer(raw, np.uint8) >= 0xE0).any():  # three bytes and more
        raw = _ALONE.sub(r" \g<0> ", text).encode("utf-8", "surrogatepass")
    words = raw.translate(_SEPARATED).split()
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def char_span(text: str, first: int, last: int) -> tuple[int, int]:
    """Code points of the words ``first`` to ``last`` (exclusive) of a text."""
    at = [m.span() for k, m in enumerate(_WORD.finditer(text)) if k in (first, last - 1)]
    return at[0][0], at[-1][1]


def edit_ends(item: np.ndarray, text: np.ndarray, anchored: bool = False) -> np.ndarray:
    """Edit distance of ``item`` to the best stretch that ends before each place 0..len(text);
    a stretch starts anywhere, or at 0 if anchored."""
    steps = np.arange(len(text) + 1)
    row = steps.copy() if anchored else np.zeros(len(text) + 1, np.int64)
    for i, w in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (text != w), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    return row


def verify(item: np.ndarray, text: np.ndarray, low: int, high: int, allowed: int) -> tuple[int, int, int] | None:
    """The nearest stretch of ``text[low:high]``: (distance, first word, last word exclusive)."""
    low, high = max(low, 0), min(high, len(text))
    row = edit_ends(item, text[low:high])
    end = int(row.argmin())
    if row[end] > allowed:
        return None
    back = edit_ends(item[::-1], text[low:low + end][::-1], anchored=True)
    length = int(back.argmin())
    return int(row[end]), low + end - length, low + end


def _pairs(words: np.ndarray) -> np.ndarray:
    return mixed(words[:-1] * _GOLD + words[1:])


def _sequence_keys(words: np.ndarray, n: int) -> np.ndarray:
    """A key of each sequence of ``n`` words."""
    key = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        key = mixed(key * _GOLD + words[j:len(words) - n + 1 + j])
    return key


class Index:
    """Keys of a block of items, by length class (powers of 1.25)."""

    def __init__(self, items: list[tuple[int, str]], share: float = SHARE, seed: int = 7):
        hashes = Words()
        self.share = share
        self.items = [(i, h) for i, t in items if len(h := word_hashes(t or "", hashes))]
        whole = [k for k, (_, h) in enumerate(self.items) if len(h) >= MIN_WORDS]
        self.short = {n: self._exact([k for k, (_, h) in enumerate(self.items) if len(h) == n]) for n in range(1, MIN_WORDS)}
        self.pairs = np.unique(np.concatenate([_pairs(self.items[k][1]) for k in whole])) if whole else np.empty(0, np.uint64)
        self.pieces = []  # (item, place in it, words)
        for k in whole:
            h = self.items[k][1]
            parts = np.array_split(h, 1 if len(h) <= WHOLE else -(-len(h) // PIECE))
            self.pieces += zip([k] * len(parts), np.cumsum([0, *map(len, parts[:-1])]).tolist(), parts)
        by_class = defaultdict(list)
        for k, (_, _, h) in enumerate(self.pieces):
            by_class[int(np.log(len(h)) / np.log(1.25))].append(k)
        self.classes = []
        rng = np.random.default_rng(seed)
        for c, members in sorted(by_class.items()):
            shortest = min(len(self.pieces[k][2]) for k in members)
            span = max(SAMPLED, int(1.5 * shortest))  # the walk is then about three quarters through
            draw = [[np.sort(rng.choice(span, SAMPLED, replace=False)) for _ in range(SAMPLES)] for _ in range(WALKS)]
            # the first words of a match, as many as any match in this class has; an edit breaks two pairs at most
            edits = max(int(share * len(self.pieces[k][2])) for k in members)
            first = min(len(self.pieces[k][2]) - int(share * len(self.pieces[k][2])) for k in members)
            entry = {"draw": draw, "need": first - 1 - 2 * edits, "width": first - 1, "seed": 1000 * c, "tables": []}
            flat = np.concatenate([np.r_[self.pieces[k][2], np.zeros(2 * span, np.uint64)] for k in members])
            at = np.cumsum([0] + [len(self.pieces[k][2]) + 2 * span for k in members[:-1]])
            for keys in self.keys(entry, flat, at):
                order = np.argsort(keys, kind="stable")
                entry["tables"].append((keys[order], np.array(members)[order]))
            self.classes.append(entry)

    def _exact(self, members: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys of short items of one length, and the items."""
        keys = np.array([_sequence_keys(self.items[k][1], len(self.items[k][1]))[0] for k in members], np.uint64)
        order = np.argsort(keys, kind="stable")
        return keys[order], np.array(members, np.int64)[order]

    def copies(self, text: np.ndarray) -> Iterator[tuple[int, int]]:
        """(start, item) of each exact copy of a short item in the joined texts."""
        for n, (keys, members) in self.short.items():
            if not len(keys) or len(text) < n:
                continue
            mine = _sequence_keys(text, n)
            lo, hi = np.searchsorted(keys, mine, "left"), np.searchsorted(keys, mine, "right")
            for start in np.flatnonzero(hi > lo).tolist():
                for k in members[lo[start]:hi[start]].tolist():
                    if np.array_equal(text[start:start + n], self.items[k][1]):
                        yield start, k

    def allowed(self, k: int) -> int:
        return int(self.share * len(self.items[k][1]))

    @staticmethod
    def keys(entry: dict, flat: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
        """For each walk and sample set the keys of the windows at ``starts`` of ``flat``."""
        for w, sets in enumerate(entry["draw"]):
            wanted = {j for s in sets for j in s}
            at, seen = starts.copy(), {}
            for j in range(max(wanted) + 1):
                symbol = flat[np.minimum(at, len(flat) - 1)]
                if j in wanted:
                    seen[j] = symbol
                at = at + (mixed(symbol ^ np.uint64(entry["seed"] + 100_003 * w + 7919 * j + 1)) & np.uint64(1)).astype(np.int64)
            for s in sets:
                key = np.zeros(len(starts), np.uint64)
                for j in s:
                    key = mixed(key * _GOLD + seen[j])
                yield key

    def found(self, text: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
        """(start, piece) candidates in the joined texts ``text``; ``bounds`` are the texts' starts and the end.
        Texts are set apart by zeros, which no item has."""
        if not self.classes:
            return
        pairs = _pairs(text)
        place = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        known = np.concatenate([[0], np.cumsum(self.pairs[place] == pairs)])
        every = np.arange(len(text))
        for entry in self.classes:
            held = known[np.minimum(every + entry["width"], len(pairs))] - known
            starts = every[held >= entry["need"]]
            if not len(starts):
                continue
            hits = []
            for (keys, members), mine in zip(entry["tables"], self.keys(entry, text, starts)):
                lo, hi = np.searchsorted(keys, mine, "left"), np.searchsorted(keys, mine, "right")
                some = np.flatnonzero(hi > lo)
                if len(some):
                    times = (hi - lo)[some]
                    within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    hits.append(np.stack([np.repeat(starts[some], times), members[np.repeat(lo[some], times) + within]]))
            if hits:
                yield from map(tuple, np.unique(np.concatenate(hits, axis=1), axis=1).T.tolist())


def matches(index: Index, texts: list[np.ndarray]) -> list[tuple[int, int, int, int, int]]:
    """(text, item place, distance, first word, last word) for the texts of a batch, best stretch per pair."""
    if not texts or not index.items:
        return []
    gap = np.zeros(1, np.uint64)
    joined = np.concatenate([x for t in texts for x in (t, gap)])
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    spots = defaultdict(list)
    for start, k in index.found(joined, bounds):
        d = int(np.searchsorted(bounds, start, "right")) - 1
        item, offset, _ = index.pieces[k]
        spots[d, item].append(start - int(bounds[d]) - offset)
    out = []
    for (d, k), starts in spots.items():
        item, allowed, best = index.items[k][1], index.allowed(k), None
        reach = len(item) + 2 * allowed
        starts.sort()
        low = starts[0] - reach
        for here, following in zip(starts, [*starts[1:], None]):  # near starts are verified as one region
            if following is None or following - here > reach:
                got = verify(item, texts[d], low, here + reach + 1, allowed)
                best = min(filter(None, (best, got)), default=None)
                low = (following or 0) - reach
        if best:
            out.append((d, k, *best))
    first: dict[tuple[int, int], int] = {}
    for start, k in index.copies(joined):
        d = int(np.searchsorted(bounds, start, "right")) - 1
        first[d, k] = min(first.get((d, k), start), start)
    out += [(d, k, 0, s - int(bounds[d]), s - int(bounds[d]) + len(index.items[k][1])) for (d, k), s in first.items()]
    return out


def recall(words: int, edits: int, trials: int = 200, seed: int = 1) -> float:
    """Share of random items that are found in a long random text after ``edits`` random word edits."""
    rng = np.random.default_rng(seed)
    found = 0
    for _ in range(trials):
        item = rng.integers(1, 2000, words)
        copy = list(item)
        for _ in range(edits):
            at, kind = rng.integers(len(copy)), rng.integers(3)
            copy[at:at + (kind != 0)] = [] if kind == 1 else [int(rng.integers(1, 2000))]
        as_text = lambda x: " ".join(f"w{v}" for v in x)
        index = Index([(0, as_text(item))], seed=int(rng.integers(1 << 30)))
        text = as_text([*rng.integers(1, 2000, 50), *copy, *rng.integers(1, 2000, 50)])
        found += bool(matches(index, [word_hashes(text, Words())]))
    return found / trials


OUT = "doc_id string, item_id string, distance long, item_words long, first_word long, last_word long, first_char long, last_char long"


def _portions(texts: list[str], hashes: Words, size: int = 500_000) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The words of consecutive texts, about ``size`` at a time, with the place of the first text."""
    at = 0
    while at < len(texts):
        words, total, begin = [], 0, at
        while at < len(texts) and (not words or total < size):
            words.append(word_hashes(texts[at], hashes))
            total += len(words[-1])
            at += 1
        yield begin, words


def _search(shared):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, hashes = shared.value, Words()
        for b in batches:
            ids, texts, rows = b["doc_id"].tolist(), b["text"].tolist(), []
            for at, words in _portions(texts, hashes):
                for d, k, distance, first, last in matches(index, words):
                    item_id, item = index.items[k]
                    rows.append((ids[at + d], item_id, distance, len(item), first, last,
                                 *char_span(texts[at + d], first, last)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in OUT.split(", ")])
    return search


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most ``BLOCK_ITEMS`` items and about ``BLOCK_CHARS`` characters."""
    block, size = [], 0
    for r in text_of(benchmark, "item_id").toLocalIterator():
        if block and (len(block) >= BLOCK_ITEMS or size + len(r["text"]) > BLOCK_CHARS):
            yield block
            block, size = [], 0
        block.append((None if r["item_id"] is None else str(r["item_id"]), r["text"]))
        size += len(r["text"])
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """A row per document and item that it holds: the nearest stretch, its distance and place."""
    spark, out = docs.sparkSession, None
    for block in blocks(benchmark):
        shared = spark.sparkContext.broadcast(Index(block, share))
        part = opaque(text_of(docs), "doc_id").mapInPandas(_search(shared), OUT)
        out = part if out is None else out.union(part)
    return exact(out if out is not None else spark.createDataFrame([], OUT), "doc_id", "item_id")


def _holds(shared):
    @F.pandas_udf("boolean")
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = Words()
        for b in batches:
            found = np.zeros(len(b), bool)
            for at, words in _portions(b.fillna("").tolist(), hashes):
                found[[at + d for d, *_ in matches(shared.value, words)]] = True
            yield pd.Series(found)
    return holds


def clean_documents(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` that hold no item, with their columns; a row is judged where it is, without a join."""
    spark = docs.sparkSession
    ship(spark)
    for block in blocks(benchmark):
        docs = docs.filter(~_holds(spark.sparkContext.broadcast(Index(block, share)))("text"))
    return docs
