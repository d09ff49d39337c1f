"""Vector codes, main text and the filter audit against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import permutations
from math import floor

import numpy as np
import pytest

from emporia.llm import filter_audit, main_text, registry, vector_codes

SF = "/root/testdata/sf0.001"

# ------------------------------------------------------------ vector codes


def _plain_codes(rows, parts=4, entries=256, rounds=4):
    """Codes by comparing everything with everything, in Python's integers."""
    kept = [(i, v, lab) for i, v, lab in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    kept = [(i, [floor(1024 * float(np.float64(x))) for x in v], lab) for i, v, lab in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0], r[1]))[:entries]
    d = len(first[0][1]) // parts
    cut = [[tuple(v[p * d : p * d + d]) for _, v, _ in kept] for p in range(parts)]
    books = [[list(v[p * d : p * d + d]) for _, v, _ in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = {}
            for x in cut[p]:
                groups.setdefault(nearest(x, book)[1], []).append(x)
            for j, members in groups.items():
                book[j] = [sum(c) // len(members) for c in zip(*members)]
    found = [[nearest(cut[p][r], books[p]) for p in range(parts)] for r in range(len(kept))]
    errors = [sum(e for e, _ in f) for f in found]
    by_label = {}
    for (_, _, lab), e in zip(kept, errors):
        by_label[lab] = by_label.get(lab, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(
        ((i, "".join(f"{j:02x}" for _, j in f), e, by_label[lab], sha) for (i, _, lab), f, e in zip(kept, found, errors)), key=repr
    )


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def _codes(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def test_codes_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.normal(size=16).astype(np.float32)], int(i) % 3 or None) for i in range(330)]
    rows += [(7, rows[7][1], 1)] * 3 + [(400 + i, rows[9][1], 2) for i in range(40)]  # repeated rows and ids, copies
    rows += [(500, None, 1), (501, [float("nan")] + [0.0] * 15, 1), (502, [None] + [0.0] * 15, 1), (503, [float("inf")] + [0.0] * 15, 2)]
    rows += [(504, [0.0] * 16, None), (505, [], 1), (None, [0.25] * 16, 5)]
    df = _vectors(spark, rows).repartition(5)
    expected = _plain_codes(rows)
    assert _codes(vector_codes.compressed(df)) == expected
    assert len(expected) == 330 + 43 + 2


def test_codes_of_few_huge_and_no_vectors(spark):
    rows = [(1, [1e30, -1e30, 3.0, 4.0], None), (2, [1e12, 2.5, -0.0001, 4.0], None), (3, [0.0, 0.0, 0.0, 0.0], 1)]
    got = {r[0]: r for r in _codes(vector_codes.compressed(_vectors(spark, rows)))}
    assert [got[i][1] for i in (1, 2, 3)] == ["00000000", "01010100", "02020202"]  # the last parts of 1 and 2 are equal
    assert all(r[2] == 0 and r[3] == 0 for r in got.values())
    assert vector_codes.compressed(_vectors(spark, [])).count() == 0
    assert vector_codes.compressed(_vectors(spark, [(1, None, 1)])).count() == 0
    # another length than the first vector's: left out; other columns pass through, clashing names too
    odd = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0], "a", 9), (2, [1.0], "b", 8)], "vec_id long, embedding array<double>, code string, __vector int")
    out = vector_codes.encode(odd, vector_codes.train(odd))
    assert out.columns == ["vec_id", "code", "__vector", "code_"] and [r.vec_id for r in out.collect()] == [1]


@pytest.mark.parametrize("dense", [0.0, 0.1, 2.0])
@pytest.mark.parametrize("scale", [3, 1000, 10**7, 10**17])
def test_slice_search_is_exact(scale, dense, monkeypatch):
    """Masks and radii find what a full comparison finds, ties to the lower entry, in all sizes of numbers."""
    monkeypatch.setattr(vector_codes, "DENSE", dense)
    rng = random.Random(scale)
    entries = np.array([[rng.randint(-scale, scale) for _ in range(4)] for _ in range(130)], np.int64)
    entries[70] = entries[3]
    points = np.array([[rng.randint(-scale, scale) for _ in range(4)] for _ in range(1500)] + [entries[70].tolist()] * 3, np.int64)
    big = not vector_codes._small([points, entries])
    slices = vector_codes.Slices(entries.astype(object) if big else entries)
    nearest, least = slices.search(points.astype(object) if big else points)
    for x, j, d in zip(points.tolist(), nearest.tolist(), least.tolist()):
        assert (d, j) == min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(entries.tolist()))
    assert nearest[-1] == 3 and big == (scale > 10**9)


def test_op11_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    rows = sorted(rows, key=lambda r: r[0])
    got = _codes(registry.QUERIES["op11_vector_codes"](spark, SF))
    kept = np.array([r[1] for r in rows if r[1] and np.isfinite(np.array(r[1], float)).all()], np.float64)
    ints = np.floor(kept * 1024).astype(np.int64)
    books = [ints[:256, 16 * p : 16 * p + 16].copy() for p in range(4)]
    for _ in range(4):
        for p, book in enumerate(books):
            x = ints[:, 16 * p : 16 * p + 16]
            near = ((x[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
            for j in np.unique(near):
                members = x[near == j]
                book[j] = members.sum(axis=0) // len(members)
    sha = hashlib.sha256(",".join(str(int(v)) for b in books for v in b.ravel()).encode()).hexdigest()
    distance = [((ints[:, None, 16 * p : 16 * p + 16] - books[p][None]) ** 2).sum(axis=2) for p in range(4)]
    codes = ["".join(f"{int(d[r].argmin()):02x}" for d in distance) for r in range(len(ints))]
    assert {r[4] for r in got} == {sha}
    assert sorted(r[1] for r in got) == sorted(codes) and sum(r[2] for r in got) == sum(int(d.min(axis=1).sum()) for d in distance)


# ------------------------------------------------------------ main text

ARTICLE = "<h1>A &amp; B</h1><p>One  <b>bold</b>\n line.<br>Two<p>Three &eacute;&nbsp;x</p>"
AROUND = (
    '<!doctype html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body class="has-sidebar">'
    '<header><p>Site name</p></header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- <p>no</p> -->'
    '<div class="cookie-notice"><p>We use cookies, a long notice about cookies and more cookies.</p></div>{}'
    '<div class="AdBox ad"><p>Buy now, a long advert with many many words in it.</p></div>'
    '<aside><p>About</p></aside><section id="comments"><article class="comment"><p>First! I read this.</p></article></section>'
    "<form><p>Your name</p><input></form><footer>&copy; 2024</footer></body></html>"
)
WANT = "A & B\nOne bold line. Two\nThree é x"


def test_main_text_of_one_page():
    assert main_text.extract(AROUND.replace("{}", f"<article>{ARTICLE}</article>"), []) == WANT
    assert main_text.extract(AROUND.replace("{}", f'<div id="content">{ARTICLE}</div>'), []) == WANT
    # cut off, unclosed, in a form around everything, upper case, attributes with ">"
    assert main_text.extract(f"<BODY><NAV><ul><li>x<ARTICLE title='a>b'>{ARTICLE}", []) == WANT
    assert main_text.extract(f"<body><form id=aspnet><p>Search</p><article>{ARTICLE}</article></form>", []) == WANT
    assert main_text.extract("<p>a<!-- open", []) == "a" and main_text.extract("a < b &lt; c", []) == "a < b < c"
    inside = "<article><h1>T</h1><div class='share-buttons'>Tweet</div><p>x <span class=ad>ad</span>y</p><footer>tags</footer></article>"
    assert main_text.extract(inside, []) == "T\nx y"
    assert main_text.extract("<article><div class='entry-header'><h1>T</h1></div><p>body</article>", []) == "T\nbody"
    for nothing in ("", " ", "<", "<script>x", "<nav>a</nav>", "<!--", "<p"):
        assert main_text.extract(nothing, []) in ("", "<", "<p")


def test_long_and_deep_pages():
    words = "word " * 200_000
    assert main_text.extract(f"<article><p>{words}</p></article>", []) == words.strip()
    assert main_text.extract("<div>" * 30_000 + "deep", []) == "deep"
    assert main_text.extract("<a>" * 50_000 + "x" + "</b>" * 50_000, []) == "x"


def test_hosts_agree_on_a_path(spark):
    """A short article beside a long unlabelled block is found by its host's other pages only."""
    page = '<body><article class="c-{i}">{x}</article><div class="box">{ad}</div></body>'
    long, ad = "<p>" + "real text " * 30 + "</p>", "<p>" + "buy this " * 12 + "</p>"
    rows = [(i, f"https://A.example/{i}", page.format(i=i, x=long, ad=ad), "t", "h") for i in range(8)]
    rows += [(20, "http://u@a.example:80/s", page.format(i=9, x="<p>short</p>", ad=ad), "t", "h")]
    rows += [(21, "https://b.example/", page.format(i=9, x="<p>short</p>", ad=ad), "t", "h"), (22, None, None, None, None)]
    rows += [(23, "not a url", "<article><p>own</p></article>", "t", "h"), (20, "http://u@a.example:80/s", page.format(i=9, x="<p>short</p>", ad=ad), "t", "h")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, `__host` string")
    out = main_text.main_text(df)
    assert out.columns == ["page_id", "url", "text", "__host", "text_"]
    got = sorted((r.page_id, r["text_"]) for r in out.collect())
    real, bought = ("real text " * 30).strip(), ("buy this " * 12).strip()
    assert got == [*((i, real) for i in range(8)), (20, "short"), (20, "short"), (21, "short\n" + bought), (22, ""), (23, "own")]
    winners = {r.host: r.winners for r in main_text.winning_paths(df).collect()}
    assert winners["a.example"][0] == "body>article.c-0" and set(winners) == {"a.example", "b.example"}
    assert main_text.main_text(df.limit(0)).count() == 0


def test_op12_equals_a_plain_reading(spark):
    """The driver's pages are regular enough for a reading by search and replace."""
    import html

    def plain(markup):
        inner = re.search(r"(?s)<article>(.*?)</article>", markup or "")
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner[1].replace("<br>", " "))) if inner else []
        return "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)

    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = sorted(map(tuple, registry.QUERIES["op12_main_text"](spark, SF).collect()))
    assert got == sorted((p.page_id, p.url, plain(p.html), len(plain(p.html))) for p in pages)


# ------------------------------------------------------------ filter audit


def _plain_audit(docs, labels):
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    good, toxic = ({i for i, q, t in labels if (q, t)[k] == 1 and i is not None} for k in (0, 1))
    parts = {}
    for i, text, source in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and i > first[t],
        }
        parts.setdefault(source or "", []).append((i, {f for f, bad in fails.items() if bad}))
    out = []
    for part, rows in parts.items():
        taken = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                earlier = sum(f in r[1] for r in rows) - len(gone)
                left = [r for r in left if f not in r[1]]
                taken[f] += len(gone)
                only = sum(r[1] == {f} for r in rows)
                lost = [sum(r[0] in ids for r in gone) for ids in (good, toxic)]
                lines.append((part, "".join(order), step, len(left), len(gone), earlier, only, *lost, f))
        out += [(*x[:-1], taken[x[-1]]) for x in lines]
    return sorted(out)


def test_audit_equals_playing_all_orders(spark):
    rng = random.Random(4)

    def text():
        words = [f"w{rng.randrange(rng.choice((20, 400)))}" for _ in range(rng.choice((5, 150, 250, 260)))]
        return " ".join(words) + rng.choice(("", " AB" * 30, " #", "\x0b x", " é"))

    some = [text() for _ in range(40)] + [None, "", " ", " "]
    docs = [(i, rng.choice(some), rng.choice(("a", "b", None, ""))) for i in range(300)]
    docs += [(None, some[0], "a"), (None, some[0], "a"), (3, docs[3][1], docs[3][2]), (3, some[1], "c"), (1000, "word " * 100_000, "c")]
    labels = [(i, rng.randrange(2), rng.randrange(2)) for i in range(0, 300, 2)] + [(None, 1, 1), (4, None, None), (4, 1, 0), (6, None, 1)]
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, source string, mask int, part string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, filter_audit.audit(d, lab).collect())) == _plain_audit(docs, labels)
    assert filter_audit.audit(d.limit(0), lab).count() == 0


def test_constrained_least_squares_give_shapley_values():
    rng = random.Random(8)
    for players in (2, 3, 5):
        game = [0] + [rng.randrange(1000) for _ in range((1 << players) - 1)]
        sums = [0] * players
        for order in permutations(range(players)):
            s = 0
            for i in order:
                sums[i] += game[s | 1 << i] - game[s]
                s |= 1 << i
        n = len(list(permutations(range(players))))
        assert [n * x for x in filter_audit.shapley(game, players)] == sums


def test_op13_equals_playing_all_orders(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert sorted(map(tuple, registry.QUERIES["op13_filter_audit"](spark, SF).collect())) == _plain_audit(docs, labels)
