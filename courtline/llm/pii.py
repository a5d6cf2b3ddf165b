"""Personal data by recognisers and a character BiLSTM-CRF (operator 2).

The recognisers give the base spans.  The method adds spans that they miss (phone numbers without
a plus, card numbers of other lengths): a character-level bidirectional LSTM whose emissions feed a
CRF, trained in numpy from labelled spans.  The labels are the base spans of a bounded sample of the
corpus and generated spans of each kind written into stretches of it.  The sample is ``SAMPLE`` documents with a digit
or an at sign, by hash of the id, and of all windows around digits and signs of their whole texts ``WINDOWS`` at most, by
hash of the window.

Every whole text is searched.  The tagger runs over overlapping windows around each digit or at sign,
since a span of any kind holds one; where windows overlap, each character takes the label of the window
in which it lies deepest, over the whole text.  A tagged span is added if it has the form of its kind and
touches no base span, so base spans stay.

Defined cases: a null or empty text has no spans; a null doc_id stays null; repeated rows each
get a row; further columns are ignored; an empty table gives an empty result, as does training on one
(the tagger is then trained on generated spans alone).
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.shared import bounded_sample, exact, opaque, ship, text_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SEED = re.compile(r"[0-9@]")
_SEED_RUN = re.compile(r"[0-9@](?:.{0,24}?[0-9@])*", re.S)


def luhn(digits: str) -> bool:
    values = [int(c) for c in digits]
    return (sum(values[-1::-2]) + sum(sum(divmod(2 * v, 10)) for v in values[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its test, by kind, then start."""
    if not _SEED.search(text):
        return []
    out: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:  # the local part is the run before the sign, back to the last match at most
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    # a digit run that fails from its start fails from its middle: the look-behind changes nothing but time
    out += [("ip", *m.span()) for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        d = _digits(m.group()) if len(m.group()) <= 40 else ""
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return out


# ---------------------------------------------------------------- tagger

WIDTH, STRIDE = 64, 32
TAGS = ["O", *[f"{b}-{k}" for k in KINDS for b in "BI"]]
SAMPLE, WINDOWS = 1500, 6000
EMBED, HIDDEN = 10, 16
_SYMBOLS = 96 + 3  # printable ASCII, other ASCII, other letters, padding


def encoded(text: str) -> np.ndarray:
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return np.where(x >= 127, 96, np.where(x >= 32, x - 32, 97))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


class Tagger:
    """Embedding, one LSTM in each direction, a linear layer and CRF transitions."""

    def __init__(self, seed: int = 5):
        rng, n = np.random.default_rng(seed), len(TAGS)
        w = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
        self.p = {"E": w(_SYMBOLS, EMBED) * 3, "W": w(2 * HIDDEN, n), "c": np.zeros(n), "T": np.zeros((n, n)), "S": np.zeros(n)}
        for d in "fb":
            self.p |= {f"X{d}": w(EMBED, 4 * HIDDEN), f"H{d}": w(HIDDEN, 4 * HIDDEN), f"b{d}": np.zeros(4 * HIDDEN)}
            self.p[f"b{d}"][HIDDEN:2 * HIDDEN] = 1.0

    def _lstm(self, x: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """States over time of x (time, batch, EMBED), and what the backward pass needs."""
        pre = x @ self.p[f"X{d}"] + self.p[f"b{d}"]
        h = c = np.zeros((x.shape[1], HIDDEN))
        out, kept = np.empty((*x.shape[:2], HIDDEN)), []
        for t in range(len(x)):
            z = pre[t] + h @ self.p[f"H{d}"]
            i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            before, hb = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            kept.append((i, f, o, g, before, tc, hb))
        return out, kept

    def _lstm_back(self, x, d, kept, dout, grads) -> np.ndarray:
        dz = np.empty((*x.shape[:2], 4 * HIDDEN))
        dh = dc = np.zeros((x.shape[1], HIDDEN))
        for t in range(len(x) - 1, -1, -1):
            i, f, o, g, before, tc, hb = kept[t]
            dh = dh + dout[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz[t] = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
            grads[f"H{d}"] += hb.T @ dz[t]
            dh, dc = dz[t] @ self.p[f"H{d}"].T, dc * f
        grads[f"X{d}"] += np.einsum("tbe,tbh->eh", x, dz)
        grads[f"b{d}"] += dz.sum((0, 1))
        return dz @ self.p[f"X{d}"].T

    def emissions(self, symbols: np.ndarray) -> tuple[np.ndarray, tuple]:
        x = self.p["E"][symbols.T]
        fwd, kf = self._lstm(x, "f")
        bwd, kb = self._lstm(x[::-1], "b")
        both = np.concatenate([fwd, bwd[::-1]], 2)
        return both @ self.p["W"] + self.p["c"], (x, kf, kb, both)

    def gradients(self, symbols: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of the tag paths and its gradients."""
        e, (x, kf, kb, both) = self.emissions(symbols)
        steps, batch, _ = e.shape
        trans, y = self.p["T"], tags.T
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = self.p["S"] + e[0]
        for t in range(1, steps):
            alpha[t] = _logsum(alpha[t - 1][:, :, None] + trans, 1) + e[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = _logsum(trans + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        z = _logsum(alpha[-1], 1)
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        rows, cols = np.arange(steps)[:, None], np.arange(batch)
        de = np.exp(alpha + beta - z[None, :, None])
        gold = e[rows, cols, y].sum() + self.p["S"][y[0]].sum() + trans[y[:-1], y[1:]].sum()
        for t in range(steps - 1):
            pair = alpha[t][:, :, None] + trans + (e[t + 1] + beta[t + 1])[:, None, :] - z[:, None, None]
            grads["T"] += np.exp(pair).sum(0)
        np.subtract.at(grads["T"], (y[:-1], y[1:]), 1.0)
        de[rows, cols, y] -= 1.0
        grads["S"] += de[0].sum(0)
        grads["W"] += np.einsum("tbh,tbn->hn", both, de)
        grads["c"] += de.sum((0, 1))
        dboth = de @ self.p["W"].T
        dx = self._lstm_back(x, "f", kf, dboth[:, :, :HIDDEN], grads)
        dx = dx + self._lstm_back(x[::-1], "b", kb, dboth[::-1, :, HIDDEN:], grads)[::-1]
        np.add.at(grads["E"], symbols.T, dx)
        return float((z.sum() - gold) / batch), {k: v / batch for k, v in grads.items()}

    def fit(self, symbols: np.ndarray, tags: np.ndarray, steps: int = 220, batch: int = 48, rate: float = 0.02, seed: int = 3) -> float:
        """Adam over random batches; the last loss."""
        rng = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        loss = 0.0
        for t in range(1, steps + 1):
            pick = rng.integers(0, len(symbols), batch)
            loss, grads = self.gradients(symbols[pick], tags[pick])
            scale = min(1.0, 5.0 / (1e-9 + np.sqrt(sum((g * g).sum() for g in grads.values()))))
            for k, g in grads.items():
                g = g * scale
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.p[k] -= rate * (1 - t / (steps + 20)) * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-8)
        return loss

    def decode(self, symbols: np.ndarray) -> np.ndarray:
        """The best tag path of each window (Viterbi)."""
        e, _ = self.emissions(symbols)
        best, back = self.p["S"] + e[0], []
        for t in range(1, len(e)):
            step = best[:, :, None] + self.p["T"]
            back.append(step.argmax(1))
            best = step.max(1) + e[t]
        path = [best.argmax(1)]
        for b in reversed(back):
            path.append(b[np.arange(len(b)), path[-1]])
        return np.array(path[::-1]).T


def _tagged(text: str, spans: list[Span]) -> np.ndarray:
    tags = np.zeros(len(text), np.int64)
    for kind, a, b in spans:
        k = 1 + 2 * KINDS.index(kind)
        tags[a:b] = k + 1
        tags[a] = k
    return tags


def generated(kind: str, rng: np.random.Generator) -> str:
    """A made-up value of a kind, in one of its usual written forms."""
    num = lambda n: "".join(str(d) for d in rng.integers(0, 10, n))
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 9)))
    if kind == "email":
        return f"{word()}{rng.choice(['.', '_', '', '-'])}{word()}@{word()}.{rng.choice(['com', 'org', 'net', 'co.uk'])}"
    if kind == "ip":
        return ".".join(str(v) for v in rng.integers(0, 256, 4))
    if kind == "card":
        body = str(rng.integers(3, 7)) + num(rng.choice([13, 14, 14, 17]))
        body += next(c for c in "0123456789" if luhn(body + c))
        gap = rng.choice(["", "", " ", "-"])
        return gap.join(body[i:i + 4] for i in range(0, len(body), 4))
    a, b, c = num(3), num(3), num(4)
    return [f"+{rng.integers(1, 99)} ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{rng.integers(1, 99)} {a} {b} {c}",
            f"{a}.{b}.{c}", f"1-{a}-{b}-{c}"][rng.integers(6)]


def _drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every window around a digit or sign of whole texts, with its tags, and a stretch of text from a hashed place."""
    for b in batches:
        for text in b["text"].tolist():
            tags, rows = _tagged(text, base_spans(text)), []
            for k, m in enumerate(_SEED_RUN.finditer(text)):
                draw = zlib.crc32(f"{k}:{m.start()}:{len(text)}".encode())
                a, at = max(0, m.start() - 4 - draw % 26), draw // 26 % max(1, len(text) - 2 * WIDTH)
                rows.append((text[a:a + WIDTH], tags[a:a + WIDTH].tolist(), text[at:at + 2 * WIDTH]))
            yield pd.DataFrame(rows, columns=["window", "tags", "host"])


def training_windows(texts: list[str], drawn: list[tuple[str, list[int]]] = (), seed: int = 11,
                     made: int = 1200) -> tuple[np.ndarray, np.ndarray]:
    """Windows with their tags: the ``drawn`` ones, and ``made`` ones of generated spans written into ``texts``."""
    rng, windows = np.random.default_rng(seed), []
    pad = lambda t: (t + [" "] * WIDTH)[:WIDTH]
    blank = "in the of and to a is for on with as by at from that this it be are or "
    for window, tags in drawn:
        windows.append((pad(list(window)), np.r_[np.array(tags, int), np.zeros(WIDTH, int)][:WIDTH]))
    plain = [t for t in texts if len(t) > WIDTH] or [blank * 3]
    for k in range(made):
        host = plain[rng.integers(len(plain))]
        a = int(rng.integers(0, max(1, len(host) - WIDTH)))
        left = re.sub(r"[0-9@+]", "x", host[a:a + int(rng.integers(3, 26))]).rstrip() + " "
        value = generated(KINDS[k % 4], rng) if k % 5 else generated("ip", rng).replace(".", rng.choice(["/", ":", " ", ","])) + "7"
        after = " " + re.sub(r"[0-9@+]", "x", host[a + 26:a + 26 + WIDTH])
        tags = _tagged(left + value + after, [(KINDS[k % 4], len(left), len(left) + len(value))] if k % 5 else [])
        windows.append((pad(list(left + value + after)), np.r_[tags, np.zeros(WIDTH, int)][:WIDTH]))
    return np.array([encoded("".join(w)) for w, _ in windows]), np.array([t for _, t in windows])


def trained(docs: DataFrame, sample: int = SAMPLE, windows: int = WINDOWS) -> Tagger:
    """A tagger fitted on at most ``windows`` windows of at most ``sample`` documents with a digit or at sign."""
    held = text_of(docs).filter("doc_id is not null").select("doc_id", F.col("text").rlike("[0-9@]").alias("held"))
    # one document in twenty usually holds one; the texts stay with the tasks
    some = bounded_sample(held, "doc_id", sample, among=20 * sample, where="held").select("doc_id").distinct()
    rows = text_of(docs).join(F.broadcast(some), "doc_id", "left_semi").select("text") \
        .mapInPandas(_drawn, "window string, tags array<int>, host string")
    first = rows.dropDuplicates(["window"]).orderBy(F.xxhash64("window"), "window").limit(windows).collect()
    tagger = Tagger()
    tagger.fit(*training_windows([r["host"] for r in first], [(r["window"], r["tags"]) for r in first]))
    return tagger


def well_formed(kind: str, text: str) -> bool:
    """Whether a tagged stretch has the form of its kind."""
    d = _digits(text)
    if kind == "email":
        return bool(re.fullmatch(r"[^\s@]+@[^\s@.]+(\.[^\s@.]+)+", text))
    if kind == "ip":
        return False  # four parts of at most 255 are a base span; nothing else is an address
    if kind == "card":
        return 13 <= len(d) <= 19 and bool(re.fullmatch(r"[0-9]+([ -][0-9]+)*", text)) and luhn(d)
    return 9 <= len(d) <= 15 and bool(re.fullmatch(r"\(?[0-9]{1,4}\)?([ .-]{1,2}\(?[0-9]{2,4}\)?){2,5}", text))


def added_spans(texts: list[str], bases: list[list[Span]], tagger: Tagger) -> list[list[Span]]:
    """The tagger's spans of each text that are well formed and touch no base span."""
    owners, starts, windows = [], [], []
    for k, (text, base) in enumerate(zip(texts, bases)):
        codes = None
        for m in _SEED_RUN.finditer(text) if _SEED.search(text) else ():
            if codes is None:
                codes = np.r_[encoded(text), np.zeros(WIDTH, np.int64)]
            low, high = max(0, m.start() - STRIDE), min(len(text), m.end() + STRIDE)
            for a in range(low, max(low + 1, high - STRIDE), STRIDE):
                owners.append(k)
                starts.append(a)
                windows.append(codes[a:a + WIDTH])
    out: list[list[Span]] = [[] for _ in texts]
    depth = np.minimum(np.arange(WIDTH), WIDTH - 1 - np.arange(WIDTH))
    paths = [tagger.decode(np.array(windows[i:i + 2048])) for i in range(0, len(windows), 2048)]
    paths = np.concatenate(paths) if paths else np.empty((0, WIDTH), int)
    at = 0
    while at < len(owners):
        k, first = owners[at], at
        while at < len(owners) and owners[at] == k:
            at += 1
        text, label, deep = texts[k], np.zeros(len(texts[k]) + WIDTH, np.int64), np.full(len(texts[k]) + WIDTH, -1)
        for w in range(first, at):
            here = slice(starts[w], starts[w] + WIDTH)
            better = depth > deep[here]
            label[here] = np.where(better, paths[w], label[here])
            deep[here] = np.maximum(deep[here], depth)
        label = label[:len(text)]
        inside = np.flatnonzero(label)
        kind = (label + 1) // 2
        cuts = np.flatnonzero((np.diff(inside) > 1) | (np.diff(kind[inside]) != 0)) + 1 if len(inside) else []
        for run in np.split(inside, cuts) if len(inside) else ():
            a, b, name = int(run[0]), int(run[-1]) + 1, KINDS[kind[run[0]] - 1]
            while a < b and text[a] in " .,;:-":
                a += 1
            while b > a and text[b - 1] in " .,;:-(":
                b -= 1
            alone = not (a and text[a - 1].isalnum()) and not (b < len(text) and text[b].isalnum())
            if alone and well_formed(name, text[a:b]) and all(b <= s or a >= e for _, s, e in bases[k]):
                out[k].append((name, a, b))
    return out


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


def _all_spans(texts: list[str], tagger: Tagger) -> Iterator[tuple[list[Span], list[Span]]]:
    bases = [base_spans(t) for t in texts]
    for base, more in zip(bases, added_spans(texts, bases, tagger)):
        yield base, base + more


FOUND = "doc_id string, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _find(shared):
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 500):
                part, rows = b.iloc[at:at + 500], []
                for doc, (base, spans) in zip(part["doc_id"].tolist(), _all_spans(part["text"].tolist(), shared.value)):
                    rows.append((doc, *[sum(s[0] == k for s in base) for k in KINDS],
                                 hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in FOUND.split(", ")])
    return find


def find(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, the base spans' counts by kind and their digest, and all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger or trained(docs))
    return exact(opaque(text_of(docs), "doc_id").mapInPandas(_find(shared), FOUND), "doc_id")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first, longest one counts."""
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join(out) + text[end:]


def mask(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """``docs`` with every span in ``text`` masked and ``n_chars``, where there is one, counted anew; null texts stay."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tagger or trained(docs))

    @F.pandas_udf("string")
    def mask_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            out = b.copy()
            texts = b[b.notna()]
            for at in range(0, len(texts), 500):
                part = texts.iloc[at:at + 500]
                out.loc[part.index] = [masked(t, s) for t, (_, s) in zip(part, _all_spans(part.tolist(), shared.value))]
            yield out

    out = docs.withColumn("text", mask_text("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
