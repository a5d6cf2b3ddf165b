"""Repeated byte strings against a count of every window; main text against pages of known content."""

import hashlib
import random
from collections import Counter, defaultdict

from courtline.llm import substrings, webtext


def brute(rows, window=400):
    raw = [(doc, (text or "").encode()) for doc, text in rows]
    often = Counter(b[k:k + window] for _, b in raw for k in range(len(b) - window + 1))
    out = Counter()
    for doc, b in raw:
        covered = bytearray(len(b))
        for k in range(len(b) - window + 1):
            if often[b[k:k + window]] > 1:
                covered[k:k + window] = b"\1" * window
        runs = sum(c and not p for p, c in zip(b"\0" + bytes(covered), covered))
        kept = bytes(x for x, c in zip(b, covered) if not c)
        out[doc, len(b), sum(covered), runs, hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_removed_bytes(spark, monkeypatch):
    assert {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER} == set(range(substrings.PERIOD))
    rng = random.Random(3)
    some = lambda n: "".join(rng.choice("abcdefé \n") for _ in range(n))
    p, q, x = some(700), some(395), some(300)
    rows = [(1, some(50) + p + some(90)), (2, p[100:] + some(300)), (3, q + some(30)), (4, some(31) + q), (5, "a" * 1000), (6, None), (7, ""),
            (8, some(1000)), (9, None), (None, some(900) + p[50:480]), (11, some(399)), (12, some(10) + p[:399]), (14, x * 3 + some(20)),
            (15, some(20_000) + p + some(20_000) + p[:600])]
    rows += [(10, rows[7][1]), (8, rows[7][1]), (13, rows[10][1])]
    rows += [(100 + k, some(rng.randrange(200)) + p[rng.randrange(200):] + some(rng.randrange(600))) for k in range(25)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, part int").repartition(4)
    monkeypatch.setattr(substrings, "BLOCK", 9_000)  # so that documents lie in many blocks
    out = substrings.repeated_substrings(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out) == brute(rows)
    assert all(sum(s["end"] - s["first"] for s in r.spans) == r.n_removed for r in out)
    assert substrings.repeated_substrings(docs.limit(0)).count() == 0


def brute_words(rows, n=51):
    """Per row the words in strings of n words that another row holds."""
    split = [(text or "").encode().split() for _, text in rows]
    holders = defaultdict(set)
    for r, w in enumerate(split):
        for k in range(len(w) - n + 1):
            holders[tuple(w[k:k + n])].add(r)
    out = []
    for (doc, _), w in zip(rows, split):
        covered = [False] * len(w)
        for k in range(len(w) - n + 1):
            if len(holders[tuple(w[k:k + n])]) > 1:
                covered[k:k + n] = [True] * n
        out.append((doc, sum(covered)))
    return Counter(out)


def test_many_blocks_on_several_parts(spark, monkeypatch):
    """A generated table of passages, copies and loops over many blocks, bytes and words at once."""
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdefgé") for _ in range(rng.randrange(1, 7))) for _ in range(400)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [some(rng.choice([48, 51, 52, 60, 90, 200])) for _ in range(30)]
    rows = []
    for k in range(500):
        w = some(rng.randrange(3, 160))
        for _ in range(rng.choice([0, 0, 1, 2])):
            p = rng.choice(passages)
            a, b = (0, len(p)) if rng.random() < 0.6 else (rng.randrange(10), len(p) - rng.randrange(10))
            at = rng.randrange(len(w))
            w = w[:at] + p[a:b] + w[at:]
        if k % 17 == 0:
            w += 3 * some(70)[:60]
        rows.append((k, rng.choice([" ", "  ", "\n", "\u00a0", " "]).join(w)))
    rows += [(1000 + k, rows[k * 3][1]) for k in range(60)] + [(2000 + k, " ".join(passages[0])) for k in range(40)]
    rows += [(3000, " ".join(some(60) * 4)), (3001, None), (3002, "x " * 51), (3003, "x " * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    monkeypatch.setattr(substrings, "BLOCK", 5_000)
    monkeypatch.setattr(substrings, "RANGE_BYTES", 4_000)  # many ranges
    out = substrings.repeated_substrings(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out) == brute(rows)
    assert Counter((r.doc_id, r.n_passage_words) for r in out) == brute_words(rows)


def test_second_names_tell_equal_names_apart():
    import numpy as np
    import pandas as pd
    names, pack = np.array([5, 7, 9], np.uint64), lambda *bits: np.packbits(np.array(bits, bool)).tobytes()
    second = lambda *v: np.array(v, np.uint32).tobytes()
    cells = pd.DataFrame({"side": 0, "range": 0, "part": [0, 1, 2], "block": 0, "names": [names.tobytes()] * 3,
                          "seconds": [second(1, 1, 1), second(2, 1, 3), second(1, 9, 4)], "twice": [pack(0, 0, 0), pack(0, 0, 1), pack(0, 0, 0)]})
    out = substrings._repeated(cells)
    got = [np.unpackbits(np.frombuffer(b, np.uint8), count=3).tolist() for b in out["bits"]]
    assert got == [[1, 1, 0], [0, 1, 1], [1, 0, 0]]
    data = np.frombuffer(b"abcd" * 300, np.uint8)
    p = substrings.Prefixes(data)
    at = np.arange(500)
    assert (p.seconds(at, 100) == p.seconds(at + 4, 100)).all() and len(set(p.seconds(at, 100).tolist())) == 4


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<nav><a href=x>Home</a></nav><div id="cookie-notice">We use cookies</div><main><article class="post"><header><h1>Real &lt;title&gt;</h1></header>
<p>First <b>bold</b> para&nbsp;graph.<p>Second<br>line &amp; more<!-- <p>no --></p><div class="ad">Buy</div><ul><li>One<li>Two</ul>
<form><input>Sub</form><script>var a="</p>";</script><p title="a > b">Third</p></article>
<section id="comments"><article class="comment"><p>Nice post</p></article></section></main><aside>side</aside><footer>&copy; f</footer></body>"""


def test_article_text():
    main = [t for t, zone, _ in webtext.blocks(PAGE) if zone == webtext.MAIN]
    assert main == ["Real <title>", "First bold para graph.", "Second line & more", "One", "Two", "Third"]
    assert [t for t, *_ in webtext.blocks("<p>cut &am")] == ["cut &am"] and webtext.blocks("<p") == [] and webtext.blocks("") == []
    assert [t for t, *_ in webtext.blocks("1 < 2 <b>and</b> 3")] == ["1 < 2 and 3"]


def test_what_a_host_repeats_goes(spark):
    own = lambda k: " ".join(f"w{k}_{j}" for j in range(30))
    around = ("<div>Welcome to our great site dear reader of news here</div>", "<div>All rights reserved by the company in two thousand and four</div>")
    rows = [(k, f"http://h.com/{k}", f"<body>{around[0]}<p>{own(k)}</p>{around[1]}</body>") for k in range(6)]
    rows += [(20 + k, "http://copy.net/x", f"<body><p>{own('same')}</p></body>") for k in range(9)]  # copies are no boilerplate
    rows += [(9, None, None), (10, "u", ""), (11, "http://other.com", rows[0][2]), (12, "x", PAGE), (None, "x", PAGE), (12, "x", PAGE),
             (13, "y", "<article>" + "<p>long text</p>" * 20_000)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, host string").repartition(3)
    out = webtext.main_text(pages).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    got = {r.page_id: r.text for r in out}
    assert all(got[k] == own(k) for k in range(6)) and all(got[20 + k] == own("same") for k in range(9))
    assert got[9] == got[10] == "" and got[11].startswith("Welcome") and got[12] == got[None] and got[12].startswith("Real <title>\nFirst")
    assert got[13] == "\n".join(["long text"] * 20_000)
    assert webtext.main_text(pages.limit(0)).count() == 0


def test_large_host_keeps_copies_phrases_and_linked_paragraphs(spark):
    own = lambda k, n=40: " ".join(f"w{k}_{j}" for j in range(n))
    foot = "<div>All rights reserved by the company that runs this site since two thousand and four</div>"
    phrase = "it is what many people say of it on most days of the year"
    link = f'<p><a href="x">{own("linked", 14)}</a></p>'
    page = lambda k, body: f"<body><div>menu of {own(f'menu{k}', 3)}</div><p>{body}</p>{foot}</body>"
    rows = [(k, page(k, own(k)) + (f"<p>{phrase}</p>" if k < 50 else "")) for k in range(2000)]
    rows += [(5000 + k, page(f"c{k}", own("copied"))) for k in range(3)] + [(6000, page(6000, own(6000)) + link + '<div><a href="y">Home</a></div>')]
    rows = [(k, "http://large.com/x", h) for k, h in rows]
    rows += [(7000 + k, "http://small.com/x", page(f"s{k}", own("same" if k < 3 else f"s{k}"))) for k in range(8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in webtext.main_text(pages).collect()}
    menu = lambda k: f"menu of {own(f'menu{k}', 3)}\n"
    assert all(got[k] == menu(k) + own(k) + ("\n" + phrase if k < 50 else "") for k in range(2000))
    assert all(got[5000 + k] == menu(f"c{k}") + own("copied") for k in range(3))
    assert got[6000] == menu(6000) + own(6000) + "\n" + own("linked", 14)
    assert all(own("same" if k < 3 else f"s{k}") in got[7000 + k] and "rights" not in got[7000 + k] for k in range(8))


def test_marks_are_whole_class_or_id_values():
    page = """<article class="post category-commentary"><h2 id="related-work">Related</h2><section id="search-algorithms"><p>Search</p></section>
<div id="social-impact">Impact</div><div class="promotion">Promotion</div><h3 class="comment">Heading</h3><section id="skip-list">Skip</section>
<div class="related-posts">r</div><div class="x comment-list">c</div><div id="sidebar-1">s</div><div class="ads">a</div></article>
<article class="comment depth-2"><p>Nice post</p></article>"""
    assert [t for t, zone, _ in webtext.blocks(page) if zone == webtext.MAIN] == ["Related", "Search", "Impact", "Promotion", "Heading", "Skip"]
    assert [t for t, zone, _ in webtext.blocks('<div class="top-story">Story</div><div class="page-header">Site</div>') if zone == webtext.LOOSE] == ["Story"]


def brute_host(rows):
    """The rule of repeated runs on pages without an article, with the runs themselves in place of names."""
    run = webtext.RUN
    parsed = [(i, webtext.host_of(url or ""), webtext.blocks(html or "")) for i, url, html in rows]
    runs = lambda w: [tuple(w[k:k + run]) for k in range(len(w) - run + 1)]
    low = lambda texts: [w.lower() for t in texts for w in t.split()]
    on_pages, pages = defaultdict(set), defaultdict(set)
    for _, host, found in parsed:
        text = "\n".join(t for t, *_ in found)
        pages[host].add(text)
        for r in runs(low([t for t, *_ in found])):
            on_pages[host, r].add(text)  # equal pages count once
    out = Counter()
    for i, host, found in parsed:
        w, n_pages = low([t for t, *_ in found]), len(pages[host])
        loose = [z == webtext.LOOSE for t, z, _ in found for _ in t.split()]
        times = [len(on_pages[host, r]) for r in runs(w)]
        covered = [False] * len(w)
        for n in {n for n in times if n >= webtext.PAGES and n >= webtext.PAGES_SHARE * n_pages}:
            some = [any(times[k] == n for k in range(max(0, j - run + 1), min(j, len(times) - 1) + 1)) for j in range(len(w))]
            if 2 * sum(a and b for a, b in zip(some, loose)) <= sum(loose) or 2 * n > n_pages >= 2 * webtext.PAGES:
                covered = [a or b for a, b in zip(covered, some)]
        kept, at = [], 0
        for text, zone, link in found:
            n = len(text.split())
            own = [not c for c in covered[at:at + n]]
            at += n
            longest = max(map(len, "".join("x" if o else " " for o in own).split()), default=0)
            if zone == webtext.LOOSE and (link < 0.5 or n >= run) and (2 * sum(own) > n or longest >= run):
                kept.append(text)
        out[i, "\n".join(kept)] += 1
    return out


def test_repeated_runs_of_hosts_against_the_runs_themselves(spark):
    rng = random.Random(21)
    some = lambda n: " ".join(rng.choice("lorem ipsum dolor sit amet elit sed do magna aliqua ut enim".split()) + str(rng.randrange(40)) for _ in range(n))
    rows = []
    for h, size in enumerate((2, 5, 6, 7, 30, 60)):
        shared, rare, copied = [some(rng.randrange(6, 30)) for _ in range(4)], some(14), some(60)
        for k in range(size):
            parts = [some(rng.randrange(1, 50)) for _ in range(rng.randrange(1, 4))]
            parts += rng.sample(shared, rng.randrange(0, 4)) + [rare] * (k < 3) + [copied] * (k in (1, 3, 4))
            rng.shuffle(parts)
            tail = f'<p><a href="/x">{some(rng.choice([4, 12]))}</a></p>' if rng.random() < 0.4 else ""
            rows.append((len(rows), f"http://h{h}.org/{k}", "<body>" + "".join(f"<p>{p} {some(rng.randrange(3))}</p>" for p in parts) + tail + "</body>"))
        rows.append((len(rows), f"http://h{h}.org/again", rows[-1][2]))
    rows += [(None, None, rows[5][2]), (9000, "", None), (rows[0][0], rows[0][1], rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    want = brute_host(rows)
    assert Counter((r.page_id, r.text) for r in webtext.main_text(pages).collect()) == want
    whole = Counter((i, "\n".join(t for t, *_ in webtext.blocks(html or ""))) for i, _, html in rows)
    assert 20 < sum(want[x] for x in want if x not in whole) < len(rows)  # the rule acts, and not on all


def brute_articles(rows):
    """The rule of repeated runs inside articles, with the runs themselves."""
    run = webtext.RUN
    parsed = [(i, webtext.host_of(url or ""), [t for t, zone, _ in webtext.blocks(h) if zone == webtext.MAIN]) for i, url, h in rows]
    low = lambda texts: [w.lower() for t in texts for w in t.split()]
    runs = lambda w: [tuple(w[k:k + run]) for k in range(len(w) - run + 1)]
    articles = defaultdict(set)
    for _, host, texts in parsed:
        articles[host].add(tuple(texts))
    times = Counter((host, r) for host, found in articles.items() for texts in found for r in set(runs(low(texts))))
    out = Counter()
    for i, host, texts in parsed:
        w, covered, n = low(texts), set(), len(articles[host])
        for k, r in enumerate(runs(w)):
            if n >= 2 * webtext.PAGES and times[host, r] > n * webtext.ARTICLES_SHARE:
                covered.update(range(k, k + run))
        kept, at = [], 0
        for t in texts:
            own = "".join(" " if j in covered else "x" for j in range(at, at + len(t.split())))
            at += len(own)
            if 2 * len(covered) > len(w) or 2 * own.count("x") > len(own) or max(map(len, own.split()), default=0) >= run:
                kept.append(t)
        out[i, "\n".join(kept)] += 1
    return out


def test_what_a_hosts_articles_repeat_goes(spark):
    rng = random.Random(8)
    some = lambda n: " ".join(rng.choice("lorem ipsum dolor sit amet elit sed do magna aliqua".split()) + str(rng.randrange(40)) for _ in range(n))
    rows, foot = [], "Reporting by our staff in all parts of the country and editing by the desk"
    for h, size in enumerate((4, 5, 6, 7, 12, 60)):
        half, rare, copied = some(16), some(20), some(80)
        for k in range(size):
            parts = [copied] if k > size // 3 and h == 4 else [some(rng.randrange(20, 60)) for _ in range(rng.randrange(1, 4))]
            parts += [half] * (k % 2) + [rare] * (k % 5 == 0)
            rng.shuffle(parts)
            parts += [f"{foot} {some(rng.randrange(3))}"] * (k != 2) + [some(40) + " " + foot] * (k == 3)
            rows.append((len(rows), f"http://h{h}.org/{k}", f"<nav>{some(3)}</nav><article>" + "".join(f"<p>{p}</p>" for p in parts) + "</article>"))
        rows += [(len(rows) + j, f"http://h{h}.org/again", rows[-1][2].replace("<nav>", "<nav>x ")) for j in range(size)]  # copies count once
    rows += [(None, None, rows[5][2]), (rows[0][0], rows[0][1], rows[0][2]), (2 ** 60 + 1, rows[-1][1], rows[-1][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = brute_articles(rows)
    whole = Counter((i, "\n".join(t for t, zone, _ in webtext.blocks(h) if zone == webtext.MAIN)) for i, _, h in rows)
    assert 20 < sum(want[x] for x in want if x not in whole) < len(rows)
    assert any(foot in t for _, t in want) and any(i is not None and foot not in t for i, t in want)
    for parts in (1, 7):
        assert Counter((r.page_id, r.text) for r in webtext.main_text(pages.repartition(parts)).collect()) == want
