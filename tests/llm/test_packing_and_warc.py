"""Packing against plain best-fit decreasing; archives by round trip."""

import hashlib
import io
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.fs as pafs
import pytest

from courtline.llm import packing, warc


def best_fit(lengths, window):
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, k) for k, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits)[1]] -= n
        else:
            room.append(window - n)
    return sorted(room)


def test_plan_is_best_fit_decreasing():
    for seed in range(25):
        rng = random.Random(seed)
        window = rng.choice([8, 37, 64])
        counts = Counter(rng.randint(1, window) for _ in range(rng.randint(1, 300)))
        runs, used, cells = packing.plan(counts, window), Counter(), set()
        for length, n in counts.items():
            mine = [r for r in runs if r[0] == length]
            for rank in range(n):
                _, first, sequence, each, offset = [r for r in mine if r[1] <= rank][-1]
                s, o = sequence + (rank - first) // each, offset + (rank - first) % each * length
                used[s] += length
                span = {(s, o + k) for k in range(length)}
                assert not span & cells and o + length <= window
                cells |= span
        assert sorted(window - n for n in used.values()) == best_fit(counts.elements(), window)
        assert cells == {(s, k) for s, n in used.items() for k in range(n)} and set(used) == set(range(len(used)))


def test_pieces_hold_all_ids(spark):
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    t = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    rng = random.Random(2)
    odd = "a é 中 😀 \n\t  's <|endoftext|> ​́ 1٣ _-".split(" ")
    texts = ["", None, "word " * 3000, "x" * 5000] + ["".join(rng.choice(odd + [" "]) for _ in range(rng.randrange(400))) for _ in range(60)]
    rows = [(k if k != 9 else None, x, "s") for k, x in enumerate(texts)] + [(5, texts[5], "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(3)
    out = packing.pack(docs, with_ids=True).collect()
    want = Counter()
    for doc, text, _ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for s in range(0, len(ids), 1024):
            part = np.array(ids[s:s + 1024], "<u4")
            want[doc, s, len(part), zlib.crc32(part.tobytes()), len(ids), tuple(part.tolist())] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, tuple(r.ids)) for r in out) == want
    ends = defaultdict(int)
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 1024
    assert packing.pack(docs.limit(0)).count() == 0


def test_archives_round_trip(spark, tmp_path):
    big = "<p>é" + "y" * 1200
    rows = [(1, "u", big), (2, "u v\r\n", big), (3, None, None), (4, "u", "short"), (5, "u", "short"), (9, "z", big), (None, "n", big),
            (7, "q", "\r\n\r\nWARC/1.1\r\n\r\n" * 100), (8, "w", ""), (6, "l", "long " * 200_000), (4, "u", "short"), (2, "x", big + "!")]
    pages = spark.createDataFrame([(*r, "a") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    out = warc.archived(pages, str(tmp_path)).collect()
    want = Counter()
    for page, _, text in rows:
        raw = (text or "").encode()
        same = [p for p, _, x in rows if x == text and p is not None]
        revisit = len(raw) >= 1000 and page is not None and page != max(same)
        want[page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out) == want
    # the index alone is enough to fetch a record, and a gzip reader sees the same file as one stream
    found = 0
    for f in (tmp_path / "normal").glob("*.warc.gz"):
        data = f.read_bytes()
        whole = b"".join(warc.inflated(io.BytesIO(data)))
        raw = (tmp_path / "raw" / f.name).read_bytes()
        assert zlib.decompressobj(31).decompress(raw) == whole  # one member before, one for each record after
        for line in (tmp_path / "normal" / f"{f.name}.idx").read_text().splitlines():
            offset, size, record_id, _ = (line + " ").split(" ", 3)
            record = zlib.decompress(data[int(offset):int(offset) + int(size)], 31)
            assert record_id.encode() in record.split(b"\r\n\r\n", 1)[0]
            found += 1
    assert found == len(rows)
    assert warc.archived(pages.limit(0)).count() == 0


def test_damaged_archives_are_noticed():
    good = warc.record(1, "u", b"x" * 50, None)
    assert warc.parsed(good)[:2] == (1, "u")
    with pytest.raises(ValueError):
        warc.parsed(good.replace(b"xxxx", b"yyyy", 1))
    with pytest.raises(ValueError):
        list(warc.records(iter([good, good[:-9]])))
    assert [r for r in warc.records(iter([good[:5], good[5:] + good, b""]))] == [good, good]
    assert pafs.FileSystem.from_uri("file:///tmp")[1] == "/tmp"
