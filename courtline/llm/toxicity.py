"""Toxic passages as maximum-scoring segments (operator 3).

Tokens score the log-odds of their document counts between toxic and clean training documents under an informative Dirichlet
prior (the corpus frequencies, with ``PRIOR`` of the training tokens as its strength), less ``DRIFT``; a word whose log-odds are
not significant takes those of its four-letter stem, and without these the drift alone.  A linear scan
finds all maximal scoring segments of a text (Ruzzo and Tompa).  Segment scores are calibrated as in
sequence search: in a clean text of n tokens, about K n exp(-lambda S) segments reach S.  A document's
evidence is the log of the sum of exp(lambda S) over its segments, less log(K n), and a logistic curve
fitted on the training rows makes it a score.  Segments with an expected count under ``SIGNIFICANT`` are
the toxic passages.

Labels are learned from at most ``TRAIN_ROWS`` labelled rows (the first by hash of the id) whose
crc32(doc_id) mod 5 is not 0; only texts are scored.  A null label is no label; of several the largest
counts.

Defined cases: null and empty texts have no tokens and get the score of no evidence; a null doc_id stays
null and counts as not held out; rows repeated stay repeated; without toxic or without clean training
rows the curve falls back on its weak prior; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.decontaminate import _SEPARATED, char_span
from courtline.llm.shared import bounded_sample, exact, opaque, saved, text_of

TRAIN_ROWS = 20_000
PRIOR = 0.05
MIN_Z = 3.2
DRIFT = 0.3
CAP = 6.0
STEM = 4
SIGNIFICANT = 0.01


def tokens(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_SEPARATED).split()


def stem(token: bytes) -> bytes | None:
    """The first letters and an asterisk, which no token holds; of longer words only."""
    return token[:STEM] + b"*" if len(token) > STEM + 1 else None


class Scores(dict):
    """Scores of tokens; others take those of their stem, or the drift, and are not kept."""

    def __missing__(self, token: bytes) -> float:
        return self.get(stem(token), -DRIFT)


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, last exclusive), from left to right, in linear time."""
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    up = np.flatnonzero(scores > 0)
    if not len(up):
        return []
    firsts = up[np.r_[True, np.diff(up) > 1]].tolist()
    lasts = (up[np.r_[np.diff(up) > 1, True]] + 1).tolist()
    # candidates: (left sum, right sum, first, last, the nearest earlier one with a smaller left sum)
    stack: list[tuple[float, float, int, int, int]] = []
    for first, last in zip(firsts, lasts):
        left, right = float(sums[first]), float(sums[last])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= right:
                stack.append((left, right, first, last, j))
                break
            left, first = stack[j][0], stack[j][2]
            del stack[j:]
    return [(r - lo, a, b) for lo, r, a, b, _ in stack]


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        met = [Counter(), Counter()]
        for text, toxic in zip(b["text"], b["toxic"]):
            words = set(tokens(text))  # once a document: words come in bursts
            met[toxic].update(words)
            met[toxic].update({s for s in map(stem, words) if s})
        yield pd.concat([pd.DataFrame({"token": list(c), "toxic": k, "n": list(c.values())}) for k, c in enumerate(met)])


def log_odds(train: DataFrame) -> DataFrame:
    """(token, odds) of the tokens and stems whose log-odds are significant."""
    counted = train.mapInPandas(_counts, "token binary, toxic int, n long").groupBy("token").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"))
    counted = saved(counted, "token-counts")
    r = counted.agg(F.sum("t").alias("t"), F.sum("c").alias("c")).first()
    all_t, all_c = float(r["t"] or 0), float(r["c"] or 0)
    a = F.lit(PRIOR) * (F.col("t") + F.col("c"))
    t, c, prior = F.col("t") + a, F.col("c") + a, PRIOR * (all_t + all_c)
    odds = F.log(t / (all_t + prior - t)) - F.log(c / (all_c + prior - c))
    z = odds / F.sqrt(1 / t + 1 / c)
    return counted.select("token", odds.alias("odds"), z.alias("z")).filter(F.abs("z") >= MIN_Z).select("token", "odds")


class Model:
    """Token scores, the two calibration constants and the curve."""

    def __init__(self, odds: dict[bytes, float]):
        self.scores = Scores({w: float(np.clip(v, -CAP, CAP)) - DRIFT for w, v in odds.items()})
        self.scale, self.k, self.slope, self.shift = 1.0, 0.1, 1.0, -3.0

    def read(self, text: str) -> tuple[list[tuple[float, int, int]], int, np.ndarray]:
        words = tokens(text)
        s = np.fromiter(map(self.scores.__getitem__, words), np.float64, len(words))
        return segments(s), len(words), s

    def evidence(self, found: list[tuple[float, int, int]], n: int) -> float:
        total = np.logaddexp.reduce([0.0, *(self.scale * s for s, _, _ in found)])
        return float(total - np.log(self.k * max(n, 1)))

    def score(self, evidence: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * evidence + self.shift, -30, 30))))

    def passages(self, found: list[tuple[float, int, int]], n: int) -> list[tuple[float, int, int]]:
        return [x for x in found if self.k * max(n, 1) * np.exp(-self.scale * x[0]) < SIGNIFICANT]


def _scale(histogram: list[tuple[float, float]]) -> float:
    """The positive lambda at which the mean of exp(lambda s) over clean tokens is 1, 1 at most."""
    s, n = np.array([x for x, _ in histogram]), np.array([x for _, x in histogram])
    if not len(s) or s.max() <= 0 or (s * n).sum() >= 0:
        return 1.0
    mean = lambda x: (n * np.exp(x * s)).sum() / n.sum()
    low, high = 0.0, 1.0
    if mean(high) <= 1:
        return high
    for _ in range(50):
        mid = (low + high) / 2
        low, high = (mid, high) if mean(mid) < 1 else (low, mid)
    return max(low, 0.05)


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one feature by Newton steps; a weak prior keeps it finite on separable rows."""
    a, b = 1.0, -3.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([(x * (y - p)).sum() - 0.1 * (a - 1), (y - p).sum() - 0.1 * (b + 3)])
        w = p * (1 - p)
        h = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        a, b = a + float(np.clip(step[0], -1, 1)), b + float(np.clip(step[1], -3, 3))
    return max(a, 0.01), b


def _gathered(shared):
    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for text, toxic in zip(b["text"], b["toxic"]):
                found, n, s = shared.value.read(text)
                values, times = np.unique(np.round(s, 2), return_counts=True) if toxic == 0 else ((), ())
                rows.append((int(toxic), n, [x for x, _, _ in found], list(values), [float(v) for v in times]))
            yield pd.DataFrame(rows, columns=["toxic", "n", "found", "values", "times"])
    return gather


def trained(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """The model, from at most ``rows`` labelled documents outside the held-out fold."""
    spark = docs.sparkSession
    key = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    marked = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (key != 0)) \
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    some = bounded_sample(marked, "doc_id", rows)
    train = saved(text_of(docs).join(F.broadcast(some), "doc_id").select("text", "toxic"), "toxic-train")
    # copies of a text say no more about its words than the text does
    apart = train.groupBy(F.xxhash64("text").alias("h"), F.length("text").alias("n")).agg(
        F.max_by("text", "toxic").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")
    model = Model({bytes(r["token"]): r["odds"] for r in log_odds(apart).collect()})
    shared = spark.sparkContext.broadcast(model)
    seen = saved(train.mapInPandas(_gathered(shared), "toxic int, n long, found array<double>, values array<double>, times array<double>"),
                 "toxic-evidence")
    histogram = seen.select(F.explode(F.arrays_zip("values", "times")).alias("x")).groupBy("x.values").agg(F.sum("x.times").alias("n"))
    model.scale = _scale([(r["values"], r["n"]) for r in histogram.collect()])
    rows_ = seen.select("toxic", "n", "found").collect()  # as many as the training rows at most
    clean = [r for r in rows_ if r["toxic"] == 0]
    high = 2.0
    above, size = sum(s >= high for r in clean for s in r["found"]), sum(r["n"] for r in clean)
    model.k = (above + 0.5) / (max(size, 1) * np.exp(-model.scale * high))
    if rows_:
        x = np.array([model.evidence([(s, 0, 0) for s in r["found"]], r["n"]) for r in rows_])
        model.slope, model.shift = _curve(x, np.array([r["toxic"] for r in rows_], float))
    return model


OUT = "doc_id string, held_out boolean, score double, predicted int, n_passages long, passages string"


def _judge(shared):
    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for b in batches:
            rows = []
            for doc, held, text in zip(b["doc_id"].tolist(), b["held_out"].tolist(), b["text"].tolist()):
                found, n, _ = model.read(text)
                score, spans = model.score(model.evidence(found, n)), model.passages(found, n)
                rows.append((doc, held, score, int(score >= 0.5), len(spans),
                             ",".join("{}:{}".format(*char_span(text, first, last)) for _, first, last in spans)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in OUT.split(", ")])
    return judge


def toxic(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted, and the toxic passages in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model or trained(docs, labels))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    rows = opaque(text_of(docs).select("doc_id", held.alias("held_out"), "text"), "doc_id")
    return exact(rows.mapInPandas(_judge(shared), OUT), "doc_id")
