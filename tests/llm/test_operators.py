"""Operators of the training-data pipeline against brute force, on small hand-made tables."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from emporia.llm import (
    archives, language_model, neighbours, packing, pii, quality, simhash, tiling, token_files, tokens, toxicity,
)
from emporia.session import fresh_dir

ODD = ["", " ", "a", "two  spaces \n x", "don't <|endoftext|> é\u0085b", "A" * 3000, "word " * 2500]


def _docs(spark, texts, **more):
    """Documents with a null text, a repeated row and columns named like internal ones."""
    rows = [(i, t, "x", i) for i, t in enumerate(texts)] + [(len(texts), None, "x", 0), (0, texts[0], "x", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, label string, n_chars long")


def _empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, label string, n_chars long")


def _words(rng, n, size=300):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def test_encoder_equals_the_library():
    encoder = tokens.Encoder.of(tokens.default_vocabulary())
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("ab1 .'\n\t é€") for _ in range(40)) for _ in range(500)]
    for text, got in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_token_files_round_trip(spark):
    path = fresh_dir(spark, "tokens")
    docs = _docs(spark, ODD)
    token_files.write(docs, path)
    got = sorted(map(tuple, token_files.read(spark, path).collect()), key=lambda r: (r[0], r[1]))
    encoder, at = tokens.Encoder.of(tokens.default_vocabulary()), 0
    rows = sorted([(0, ODD[0]), *enumerate(ODD), (len(ODD), "")])
    assert len(got) == len(rows)
    for (doc_id, text), (found, start, n, ids) in zip(rows, got):
        expected = encoder.tokenizer.encode(text, add_special_tokens=False).ids + [0]
        assert (found, start, n) == (doc_id, at, len(expected)) and np.frombuffer(ids, "<u4").tolist() == expected
        at += n
    shard = token_files.Shard(token_files.manifest(spark, path).first()["file"])
    first = int(shard.doc_ids[0])
    assert shard.find(first) == shard.ids(0) and shard.find(10**9) is None
    shard.close()
    empty = fresh_dir(spark, "tokens")
    token_files.write(_empty(spark), empty)
    assert token_files.read(spark, empty).count() == 0


def test_minimum_bin_slack_fills_windows():
    assert packing.fill({5: 2, 3: 3}, 11) == {5: 1, 3: 2}
    assert sum(k * n for k, n in packing.fill({7: 1, 6: 1}, 10).items()) == 7
    rng = random.Random(1)
    for _ in range(20):
        lengths = {rng.randint(1, 32): rng.randint(1, 9) for _ in range(12)}
        patterns = packing.plan(lengths, 32)
        assert all(sum(k * n for k, n in p.contents) <= 32 for p in patterns)
        used = {}
        for p in patterns:
            for k, n in p.contents:
                used[k] = used.get(k, 0) + n * p.repeats
        assert used == lengths


def test_packing_places_every_id_once(spark):
    docs = _docs(spark, ODD + ["same text here"] * 40)
    cut = packing.pieces(docs, window=64)
    rows = packing.pack(cut, window=64, buckets=4).collect()
    assert len(rows) == cut.count() and len({r.piece_id for r in rows}) == len(rows)
    sequences = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sequences.get(r.sequence_id, 0)
        sequences[r.sequence_id] = r.offset + r.length
    assert max(sequences.values()) <= 64
    whole = packing.sequences(packing.pack(cut, window=64), window=64).collect()
    assert all(len(r.ids) == 4 * 64 or r.length & (r.length - 1) == 0 for r in whole)
    assert packing.pack(packing.pieces(_empty(spark))).count() == 0


def _simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if words else 0


def test_simhash_components_equal_brute_force(spark):
    rng = random.Random(5)
    base = [_words(rng, 80) for _ in range(30)]
    texts = ODD + base + [b.replace("w1", "w2", 1) for b in base] + ["Tab\tand\x0bV"] * 3
    got = {(r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.components(_docs(spark, texts)).collect()}
    prints = {i: _simhash(t) for i, t in enumerate(texts + [""])}
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i in prints:
            for j in prints:
                if (prints[i] ^ prints[j]).bit_count() <= 4 and label[i] > label[j]:
                    label[i], changed = label[j], True
    assert got == {(i, prints[i], label[i]) for i in prints}
    assert simhash.components(_empty(spark)).count() == 0
    kept = simhash.representatives(_docs(spark, texts))
    assert kept.columns == ["doc_id", "text", "label", "n_chars"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(label.values()))
    clash = spark.createDataFrame([(1, "a b", 5, 6), (2, "a b", 7, 8), (None, "c", 9, 0)], "doc_id long, text string, __id int, __n int")
    assert sorted(tuple(r)[2:] for r in simhash.representatives(clash).collect()) == [(5, 6), (9, 0)]


def test_vantage_trees_lose_no_pair():
    rng = np.random.default_rng(2)
    centres = rng.integers(0, 2**63, 200, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), False)) for _ in range(1500)], np.uint64)
    fps = np.unique(rng.choice(centres, 1500) ^ flips)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    masks, radius = simhash.band_masks(4)
    found = np.zeros_like(near)
    for mask in masks:
        nodes = simhash.build_tree(fps, mask, len(fps), 64)
        rows, shard, home = simhash.route(nodes, mask, fps, radius)
        assert np.bincount(rows[home], minlength=len(fps)).tolist() == [1] * len(fps)
        for s in np.unique(shard):
            mine, at_home = rows[shard == s], rows[(shard == s) & home]
            found[np.ix_(mine, at_home)] |= near[np.ix_(mine, at_home)]
    assert ((found | found.T) == near).all()


def test_tiling_catches_reordered_passages(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    w = item.split()
    texts = [
        f"intro words, {item}! outro", " ".join([*w[6:], "filler", *w[:6]]), " ".join(w[:5]), "nothing of it", item.upper(), "",
    ]
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "alpha beta")], "item_id long, text string")
    found = tiling.contaminated(_docs(spark, texts), bench).filter("item_id = 7").collect()
    assert sorted((r.doc_id, r.tiles) for r in found) == [(0, 1), (0, 1), (1, 2), (4, 1)]
    assert all(r.coverage == 1.0 for r in found)
    split = tiling.contaminated(_docs(spark, texts), bench, block_bytes=20).filter("item_id = 7")
    assert split.count() == 4
    clean = tiling.decontaminate(_docs(spark, texts), bench.filter("item_id = 7"))
    assert sorted(r.doc_id for r in clean.collect()) == [2, 3, 5, 6] and clean.columns[2] == "label"
    assert tiling.decontaminate(_docs(spark, texts), bench.filter("item_id = 99")).count() == len(texts) + 2


@pytest.mark.parametrize(("version", "compress"), [(1, True), (2, True), (2, False), (None, True)])
def test_archives_round_trip(spark, version, compress):
    html = ["<a>", "<b>é\r\n\r\n</b>", "<a>", None, "", "HTTP/1.1 fake\r\n\r\nx"]
    rows = [(i, None if i == 1 else f"http://x/ {i}", h, "u") for i, h in enumerate(html)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, file string")
    root = fresh_dir(spark, "arc")
    warc = archives.read_warc(archives.convert(archives.write_arc(pages, f"{root}/a", version, compress=compress), f"{root}/w"))
    got = {r.page_id: r for r in warc.collect()}
    assert len(got) == len(html)
    for i, h in enumerate(html):
        data, r = (h or "").encode(), got[i]
        first = next(j for j, x in enumerate(html) if (x or "") == (h or ""))
        assert (r.payload_bytes, r.payload_digest) == (len(data), archives.digest(data))
        assert (r.record_type, r.refers_to) == (("response", None) if first == i else ("revisit", first))
        assert r.record_id.startswith("<urn:uuid:") and r.date == "2000-01-01T00:00:00Z"
    assert archives.pages_to_warc(pages.limit(0), fresh_dir(spark, "arc")).count() == 0


def test_arc_lines_that_lie_raise():
    import io

    good = archives.arc_version_block("x", 1) + archives.arc_record("http://a b", "text/html", b"body", 1, "x", 0)
    assert [body for _, _, body in archives.arc_records(io.BytesIO(good))][1] == b"body"
    with pytest.raises(ValueError, match="beyond the end"):
        list(archives.arc_records(io.BytesIO(good[:-4])))
    with pytest.raises(ValueError, match="not an ARC header"):
        list(archives.arc_records(io.BytesIO(b"one two\n")))
    assert archives.warc_date("199701020304") == "1997-01-02T03:04:00Z" and archives.warc_date("?") == "1970-01-01T00:00:00Z"


def test_base_spans_equal_the_patterns():
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    rng = random.Random(4)
    for _ in range(20000):
        text = "".join(rng.choice("a1.@-+ 2") for _ in range(rng.randint(0, 24)))
        assert pii.emails(text) == [m.span() for m in email.finditer(text)]
        assert [m.span() for m in pii.IP.finditer(text)] == [m.span() for m in ip.finditer(text)]
    assert pii.base_spans("x" * 200000 + "@") == [] and pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_pii_finds_and_redacts(spark):
    texts = ["mail a.b@c.com or call +1 (212) 555-0123", "card 4111 1111 1111 1111, ip 10.0.0.1", "v 300.1.1.1 4111111111111112", ""]
    docs = _docs(spark, texts)
    model = pii.train(docs)
    assert model.reliability.given["email"][0, 1, 2] > 0.5
    got = {r.doc_id: r for r in pii.redact(docs, model).collect()}
    assert got[0].text == "mail <EMAIL> or call <PHONE>" and got[1].text == "card <CARD>, ip <IP>"
    assert got[2].text == texts[2] and got[4].text is None and got[0].label == "x"
    assert pii.redact(_empty(spark), pii.train(_empty(spark))).count() == 0


def test_loose_candidates_follow_the_votes(spark):
    good = [f"please email me at bob{i} [at] site [dot] org today" for i in range(30)]
    model = pii.train(_docs(spark, good + [f"a{i}@site.org" for i in range(30)]))
    (c,) = [c for c in pii.candidates(good[0])[1]]
    assert not c.base and model.probability([c.key])[0] > 0.5


def test_hints_miss_no_loose_match():
    """A text that a loose pattern matches is always tried, whatever else it holds."""
    for kind, text in (
        ("email", "john@example [dot] com"), ("email", "john@example(dot)org"), ("email", "\u017f@b.com"),
        ("phone", "(555)123-4567"), ("phone", "(030)1234 5678"), ("phone", "(030)\n1234 5678"),
    ):
        assert [text[c.start : c.end] for c in pii.candidates(text)[1] if c.kind == kind] == [text]
    rng = random.Random(9)
    parts = {
        "email": ["a", "b1", "@", " ", "[at]", "(AT)", "{ at }", " (dot) ", "[dot]", ".", "com", "\u017f", "\n"],
        "ip": ["a1:", "0:", "ff:", "0", ":", "g", " ", "12345"],
        "card": ["4111", "4111-", "1234 ", "1234-", "1234", "12", " ", "--", ". "],
        "phone": ["(", ")", "030", "555", "1234", "0", " ", "-", ".", "/", "\n", "+", "("],
    }
    for kind, words in parts.items():
        seen = 0
        for _ in range(20_000):
            text = "".join(rng.choice(words) for _ in range(rng.randint(4, 12)))
            found = pii.LOOSE[kind].search(text)
            seen += bool(found)
            assert not found or pii._HINT[kind].search(text), (kind, text)
        assert seen > 10, (kind, seen)


def _labels(spark, n, column):
    return spark.createDataFrame([(i, int(i % 4 == 0), None) for i in range(n)], f"doc_id long, {column} int, text string")


def test_segments_are_maximal():
    rng = np.random.default_rng(1)
    for _ in range(200):
        gain = rng.integers(-3, 4, rng.integers(1, 25)).astype(float)
        sums = np.concatenate(([0], np.cumsum(gain)))
        found = toxicity.segments(gain, 0.0)
        spans = [(a, b) for a, b, _ in found]
        assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))
        assert all(s == pytest.approx(sums[b] - sums[a]) and s > 0 for a, b, s in found)
        best = max((sums[b] - sums[a] for a in range(len(sums)) for b in range(a + 1, len(sums))), default=0)
        assert max([s for *_, s in found], default=0) == pytest.approx(max(best, 0))


def test_toxicity_learns_and_scores(spark):
    rng = random.Random(8)
    texts = [_words(rng, 60) + (" idiotic idiotish fool" * 3 if i % 4 == 0 else "") for i in range(400)]
    docs = _docs(spark, texts)
    model = toxicity.train(docs, _labels(spark, 300, "toxic"))
    got = {r.doc_id: r.toxicity for r in toxicity.annotate(docs, model).collect()}
    assert all((got[i].score >= 0.7) == (i % 4 == 0) for i in range(300, 400))
    assert all(got[i].passages for i in range(300, 400, 4)) and got[400].score < 0.5
    assert toxicity.annotate(_empty(spark), toxicity.train(_empty(spark), _labels(spark, 0, "toxic"))).count() == 0


def test_quality_rules_compile_to_columns(spark):
    rng = random.Random(9)
    texts = [" ".join(w + ("###" if i % 4 else "") for w in _words(rng, 40).split()) for i in range(300)]
    docs = _docs(spark, texts)
    model = quality.train(docs, _labels(spark, 200, "quality"))
    assert 0 < len(model.rules) < 100
    scored = quality.annotate(docs, model, "score")
    assert all((r.score >= 0.7) == (r.doc_id % 4 == 0) for r in scored.filter("doc_id between 200 and 299").collect())
    assert scored.columns == [*docs.columns, "score"] and 0 <= scored.filter("text is null").first().score <= 1
    assert quality.annotate(_empty(spark), quality.train(_empty(spark), _labels(spark, 0, "quality"))).count() == 0


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((400, 8)).round(1)
    vectors[50:120] = vectors[50]  # a hot vector
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    rows += [(900, None, 0), (901, [0.0] * 8, 0), (902, [float("nan")] * 8, 0), (903, [1.0, None] * 4, 0), (904, [1.0], 0), rows[3]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = {}
    for r in neighbours.nearest(frame, neighbours.F.col("vec_id") % 20 == 0, k=5, confidence=0.9999, part_rows=90).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.score, r.vec_id)
    hits = 0
    for q in range(0, 400, 20):
        d = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        expected = sorted((d[i], i) for i in range(400) if i != q)[:5]
        hits += [i for _, i in expected] == [got[q][n][1] for n in range(1, 6)]
    assert len(got) == 20 and hits >= 19
    assert neighbours.nearest(frame.limit(0), neighbours.F.lit(True)).count() == 0
    assert neighbours.chi_square(18.307, 10) == pytest.approx(0.95, abs=1e-4)


def test_language_model_is_a_distribution(spark):
    """Over every word the model knows and an unknown one, predictions after a context sum to 1."""
    rng = random.Random(2)
    texts = [_words(rng, 30, 12) for _ in range(40)]
    vocabulary = sorted({w for t in texts for w in t.split()})
    probes = ["w1 " + w for w in [*vocabulary, "unheard"]] + ["w1"]
    docs = _docs(spark, texts + probes)
    n = len(texts)
    got = {r.doc_id: r for r in language_model.score(docs, neighbours.F.col("doc_id") < n, bucket_tokens=300).collect()}
    # P(w1 x end) = P(w1) P(x | w1) P(end | x); the ends cancel against probes of x alone
    again = _docs(spark, texts + vocabulary + ["unheard", "w1"])
    alone = {r.doc_id: r for r in language_model.score(again, neighbours.F.col("doc_id") < n, bucket_tokens=300).collect()}
    assert got[0].train_tokens == sum(len(t.split()) + 1 for t in [*texts, texts[0]])
    assert got[n + len(vocabulary)].n_known == 2 and got[n].n_tokens == 3
    held = sum(got[i].score for i in range(n, n + len(vocabulary)))
    assert held > sum(got[i].base_score for i in range(n, n + len(vocabulary)))
    assert all(np.isfinite(r.score) and r.score < 0 for r in [*got.values(), *alone.values()])
    assert language_model.score(_empty(spark)).count() == 0


def test_words_of_equal_low_bits_stay_apart(spark):
    """These two words' hashes agree modulo 2^40 - 1."""
    docs = spark.createDataFrame([(0, "w806203 w806203"), (1, "w1246642")], "doc_id long, text string")
    got = {r.doc_id: r for r in language_model.score(docs, neighbours.F.col("doc_id") == 0).collect()}
    assert got[1].n_known == 1 and got[0].n_known == 3
    assert got[1].base_score == pytest.approx(np.log10(0.1 / 3.3) + np.log10(1.1 / 3.3))


def test_seating_keeps_its_books():
    count = np.array([1, 2, 5, 40, 0, 300])
    place = np.array([0, 0, 1, 1, 1, 0])
    seats = language_model.Seating(
        count, place, np.full(6, 0.1), np.ones(2), language_model.CONTEXT, np.random.default_rng(1)
    )
    mean = seats.run()
    for k, dish in enumerate(seats.open):
        size = seats.size[seats.first[k] : seats.first[k + 1]]
        assert size.sum() == count[dish] and (size > 0).sum() == seats.tables[dish]
    assert np.allclose(seats.at_tables, np.bincount(place, seats.tables, 2))
    assert mean[0] == 1 and mean[4] == 0 and 1 <= mean[1] <= 2 and 1 < mean[5] < 300


def test_sweeps_draw_from_the_posterior():
    """Frequent dishes too: mean tables of many equal restaurants against every pair of table counts, weighed."""
    law, n, c, base = language_model.CONTEXT, 600, (300, 40), (0.02, 0.3)
    d, many = law.discount, 300
    ways = np.full((many + 1, many + 1), -np.inf)
    ways[0, 0] = 0
    with np.errstate(divide="ignore"):
        for i in range(many):
            ways[i + 1, 1:] = np.logaddexp(ways[i, :-1], (ways[i] + np.log(np.maximum(i - d * np.arange(many + 1), 0)))[1:])
    t, u = np.meshgrid(np.arange(1, c[0] + 1), np.arange(1, c[1] + 1), indexing="ij")
    rising = np.concatenate(([0.0], np.cumsum(np.log(law.strength + d * np.arange(sum(c))))))
    weight = ways[c[0], t] + ways[c[1], u] + t * np.log(base[0]) + u * np.log(base[1]) + rising[t + u]
    weight = np.exp(weight - weight.max())
    expected = [(t * weight).sum() / weight.sum(), (u * weight).sum() / weight.sum()]
    place = np.repeat(np.arange(n), 2)
    seats = language_model.Seating(np.tile(c, n), place, np.tile(base, n), np.ones(n), law, np.random.default_rng(4))
    for _ in range(4):
        mean = seats.run().reshape(n, 2).mean(0)
    assert mean == pytest.approx(expected, rel=0.02)


def _kept(tmp_path, parent_kept, as_context, whole=30, count=20):
    """What a pair bucket of one context, 1, with the dishes 2 and 3 keeps in its second pass."""
    steps, counts = language_model._steps, np.array([count, 10], np.int32)
    one = [
        steps(np.array([1])), np.array([2], np.int32), np.array([whole]), steps(np.array([2, 3])),
        np.log([0.1, 0.1]).astype(np.float16), np.array([0, 1], np.uint16), counts,
    ]
    got = language_model._merge_pairs([(7, one)])
    with open(language_model._pairs_file(str(tmp_path), 5), "wb") as f:
        f.write(language_model._pairs_state(got, np.array([8.0])))
    reply = [steps(np.array([1, 2, 3])), np.array([0, *parent_kept], np.float32), np.array([as_context, 0, 0], np.float32)]
    rows = language_model._answer_pairs(5, [(-1, []), (0, reply)], 1, str(tmp_path), (1000.0, 400.0, 1e-3))
    (row,) = [r for r in rows.itertuples() if r.key == 7]
    return language_model._unpack(row.data)[0]


def test_second_pass_takes_the_parent_as_base(tmp_path):
    kept = _kept(tmp_path, [0, 500], 8)
    assert kept[0] > 20 - 0.75 * 3 and kept[1] < 10 - 0.75 * 3


def test_a_hot_pair_takes_no_room():
    import tracemalloc

    count = np.array([14_000_000, 3, 14_000_000])
    tracemalloc.start()
    seats = language_model.Seating(
        count, np.zeros(3, np.int64), np.array([0.05, 1e-6, 0.9]), np.ones(1), language_model.CONTEXT, np.random.default_rng(1)
    )
    mean = seats.run()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20 and 1 < mean[0] < mean[2] < count[2]


def test_parts_of_a_hot_context_count_each_others_tables(tmp_path):
    """A part with few of the context's customers, of which another's hot pair has most."""
    alone, shared = _kept(tmp_path, [100, 100], 8), _kept(tmp_path, [100, 100], 8, whole=10**9)
    assert shared == pytest.approx(alone, abs=3)
    assert _kept(tmp_path, [100, 100], 3000, whole=10**9).sum() < alone.sum()


def test_crc_is_unsigned():
    from emporia.llm.common import crc32

    assert crc32(b"a") == zlib.crc32(b"a") & 0xFFFFFFFF


def test_representatives_lose_no_text(spark):
    """Rows are told apart by their columns: an id with two texts, null ids, equal rows."""
    schema = "doc_id long, text string, lang string"
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"

    def kept(rows):
        return sorted((tuple(r) for r in simhash.representatives(spark.createDataFrame(rows, schema)).collect()), key=repr)

    assert kept([(1, a, "x"), (1, b, "x"), (2, b, "x")]) == sorted([(1, a, "x"), (1, b, "x")])
    assert kept([(None, a, "x"), (None, a, "x"), (None, b, "y")]) == sorted([(None, a, "x"), (None, b, "y")], key=repr)
    assert kept([(5, a, "x"), (5, a, "x"), (None, a, "x"), (7, a, "x")]) == [(5, a, "x")]
    assert kept([(5, a, None), (5, a, "x")]) in ([(5, a, None)], [(5, a, "x")])
    assert kept([]) == []


def test_archives_of_one_name_stay_apart(spark):
    root = fresh_dir(spark, "arc")
    pages = [(i, f"http://x/{i}", "<a>" if i < 3 else f"<b>{i}") for i in range(6)]
    for n, some in enumerate((pages[:3], pages[3:])):
        rows = spark.createDataFrame(some, "page_id long, url string, html string").coalesce(1)
        archives.write_arc(rows, f"{root}/{n}")
    import glob

    found = sorted(glob.glob(f"{root.removeprefix('file:')}/*/*.arc*"))
    assert len({f.rsplit("/", 1)[1] for f in found}) < len(found)
    warc = archives.convert(archives.files_of(spark, found), f"{root}/warc")
    got = {r.page_id: r for r in archives.read_warc(warc).collect()}
    assert sorted(got) == list(range(6)) and [got[i].refers_to for i in range(6)] == [None, 0, 0, None, None, None]
    fields = [f for r in warc.collect() for f, _ in archives.warc_records(archives.open_store(r.file)[0].open_input_file(archives.open_store(r.file)[1]))]
    by_id = {f["warc-record-id"]: f for f in fields}
    for f in fields:
        if f["warc-type"] == "revisit":
            target = by_id[f["warc-refers-to"]]
            assert (target["warc-type"], target["warc-target-uri"], target["warc-date"]) == (
                "response", f["warc-refers-to-target-uri"], f["warc-refers-to-date"],
            )


def _naive_tiles(doc, item, n):
    """Greedy string tiling as published: look for the longest free matches, mark them, look again."""
    free_doc, free_item, tiles = [True] * len(doc), [True] * len(item), []
    while True:
        longest, found = n - 1, []
        for x in range(len(doc)):
            for y in range(len(item)):
                k = 0
                while (
                    x + k < len(doc) and y + k < len(item) and doc[x + k] == item[y + k] and free_doc[x + k] and free_item[y + k]
                ):
                    k += 1
                if k > longest:
                    longest, found = k, []
                if k == longest and k >= n:
                    found.append((x, y))
        if not found:
            return tiles
        for x, y in found:
            if all(free_doc[x : x + longest]) and all(free_item[y : y + longest]):
                tiles.append((x, y, longest))
                free_doc[x : x + longest] = free_item[y : y + longest] = [False] * longest


@pytest.mark.parametrize("pairs", [1 << 19, 3])
def test_tiles_equal_naive_greedy_tiling(monkeypatch, pairs):
    monkeypatch.setattr(tiling, "PAIRS", pairs)
    rng = random.Random(pairs)
    for size in (1, 2, 3, 6):
        for _ in range(60):
            item = [f"w{rng.randrange(size)}" for _ in range(rng.randrange(1, 14))]
            doc = [f"w{rng.randrange(size + 1)}" for _ in range(rng.randrange(0, 40))]
            if rng.random() < 0.5:
                doc[3:3] = item[len(item) // 2 :] + ["x"] + item[: len(item) // 2]
            block = tiling.Block.of([(1, " ".join(item))], 4)
            got = block.matches(" ".join(doc), 0.5)
            n = min(4, len(item))
            tiles = _naive_tiles(doc, item, n) if n == 4 or len(doc) == n else []
            matched = sum(t[2] for t in tiles)
            if matched >= 0.5 * len(item):
                assert [(m["matched"], m["tiles"], m["item_tokens"]) for m in got] == [(matched, len(tiles), len(item))]
            else:
                assert got == []


def test_short_items_and_repeated_words_in_bounded_memory():
    import tracemalloc

    block = tiling.Block.of([(1, "the"), (2, "a b c"), (3, "la " * 500)], 4)
    assert [m["item_id"] for m in block.matches("the end of the road", 0.6)] == []
    assert [m["item_id"] for m in block.matches("The!", 0.6)] == [1] and [m["item_id"] for m in block.matches("a b c", 0.6)] == [2]
    tracemalloc.start()
    got = block.matches("la " * 200_000, 0.6)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(m["item_id"], m["matched"], m["tiles"]) for m in got] == [(3, 500, 1)] and peak < 500 << 20


def test_many_addresses_in_one_text_take_linear_time():
    import time

    text = " ".join(f"user{i}@mail{i % 9}.example.com or user{i} [at] mail.example.org" for i in range(50_000))
    began = time.process_time()
    base, found = pii.candidates(text)
    assert len(base) == 50_000 and len(found) > 50_000 and time.process_time() - began < 20
    some = " ".join(f"a{i}@b.example.com x [at] b.example.com" for i in range(40))
    base, found = pii.candidates(some)
    spans = [(c.start, c.end) for c in found if c.base]
    for c in found:
        if not c.base:
            assert all(c.end <= a or c.start >= b for a, b in spans)


def test_blocks_of_queries_and_recall_as_shipped(spark, monkeypatch):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    asked = neighbours.F.col("vec_id") % 4 == 0
    rows = {r.vec_id: np.array(r.embedding, float) for r in vectors.collect() if r.embedding is not None}
    rows = {i: v for i, v in rows.items() if len(v) and np.isfinite(v).all() and v.any()}
    ids, points = np.array(list(rows)), np.stack(list(rows.values()))
    got = [tuple(r) for r in neighbours.nearest(vectors, asked, part_rows=60).collect()]
    hits = total = 0
    for q in ids[ids % 4 == 0]:
        d = np.sqrt(((points - rows[q]) ** 2).sum(1))
        best = sorted((x, i) for x, i in zip(d, ids) if i != q)[:10]
        hits += len({i for _, i in best} & {r[2] for r in got if r[0] == q})
        total += 10
    assert hits >= 0.9 * total
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 3)
    assert sorted(got) == sorted(tuple(r) for r in neighbours.nearest(vectors, asked, part_rows=60).collect())
