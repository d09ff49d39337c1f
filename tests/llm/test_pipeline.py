"""The pipeline and the registered queries, stage by stage, against plain Python on small tables."""

from __future__ import annotations

import random
import struct
import zlib

import numpy as np
import pytest

import corpus_pipeline
from emporia.llm import packing, pii, registry, simhash, tokens
from emporia.session import fresh_dir

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
CALM, RUDE = [f"calm{i}" for i in range(60)], [f"vile{i}" for i in range(12)]


def _calm(rng, n=60):
    return " ".join(rng.choice(CALM) for _ in range(n))


def _corpus():
    """Rows by what should become of them, labels and benchmark items."""
    rng = random.Random(11)
    clean = {i: _calm(rng) for i in range(120)}
    toxic = {i: " ".join(rng.choice(RUDE) if rng.random() < 0.6 else rng.choice(CALM) for _ in range(50)) for i in range(200, 260)}
    item = " ".join(f"question{i} about topic{i}" for i in range(12))
    pieces = [" ".join(item.split()[i : i + 8]) for i in range(0, 24, 8)]
    leak = {300: f"{_calm(rng, 20)} {item} {_calm(rng, 20)}", 301: f"{pieces[2]} {_calm(rng, 9)} {pieces[0]} {pieces[1]}"}
    copies = {400: clean[5], 401: clean[5] + " calm1"}
    private = {500: f"{_calm(rng, 30)} write to ann.lee@mail.example.com today"}
    labels = [(i, 1, 0) for i in clean] + [(i, 0, 1) for i in toxic]
    return clean, toxic, leak, copies, private, labels, [(1, item), (2, None), (3, "the")]


@pytest.fixture(scope="module")
def corpus(spark):
    clean, toxic, leak, copies, private, labels, items = _corpus()
    texts = clean | toxic | leak | copies | private | {600: "", 601: "the"}
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()]
    rows += [(602, None, None, None, None), (5, clean[5], "en", "s", len(clean[5]))]
    root = fresh_dir(spark, "corpus")
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def _stage(spark, corpus, name, docs):
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, corpus)
    assert out.columns == docs.columns
    return out


def test_stages_decide_what_they_should(spark, corpus):
    clean, toxic, leak, copies, private, *_ = _corpus()
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    left = {r.doc_id for r in _stage(spark, corpus, "toxicity", docs).collect()}
    assert not left & set(toxic) and set(clean) | set(leak) | set(private) | {600, 602} <= left
    kept = [r.doc_id for r in _stage(spark, corpus, "near_dedup", docs).collect()]
    groups = {}
    for i, t in [(r.doc_id, r.text or "") for r in docs.collect()]:
        groups.setdefault(simhash.fingerprint(t.encode(), 4), []).append(i)
    assert sorted(kept) == sorted(set(kept)) and 5 in kept and 400 not in kept and {600, 602} & set(kept) == {600}
    assert set(min(g) for g in groups.values()) >= set(kept)
    clear = {r.doc_id for r in _stage(spark, corpus, "decontamination", docs).collect()}
    assert clear == {r.doc_id for r in docs.collect()} - set(leak) - {601}
    redacted = {r.doc_id: r for r in _stage(spark, corpus, "pii", docs).collect()}
    assert "ann.lee" not in redacted[500].text and redacted[500].n_chars == len(redacted[500].text)
    assert all(redacted[i].text == t for i, t in clean.items()) and redacted[602].text in (None, "")


def test_the_whole_pipeline_packs_what_is_left(spark, corpus):
    clean, toxic, leak, *_ = _corpus()
    out = corpus_pipeline.run(spark, corpus).collect()
    packed = {r.doc_id for r in out}
    assert not packed & (set(toxic) | set(leak) | {400, 601}) and set(clean) - {5} <= packed | {401}
    used = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0)
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= packing.WINDOW
    encoder = tokens.Encoder.of(tokens.default_vocabulary()).tokenizer
    for r in out:
        if r.doc_id in clean:
            ids = encoder.encode(clean[r.doc_id], add_special_tokens=False).ids + [packing.END_ID]
            assert (r.start, r.doc_tokens, r.ids_crc32) == (0, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))


def test_stages_take_empty_tables_and_clashing_columns(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert _stage(spark, corpus, name, docs.limit(0)).count() == 0
    odd = docs.limit(40).selectExpr("*", "1 AS toxicity", "2 AS matches", "3 AS pii", "4 AS __text", "5 AS __h1", "6 AS __n")
    for name, _ in corpus_pipeline.STAGES[1:-1]:
        assert {tuple(r)[5:] for r in _stage(spark, corpus, name, odd).collect()} == {(1, 2, 3, 4, 5, 6)}
    cut = packing.pieces(docs.limit(9), digest=True).selectExpr("*", "7 AS offset", "8 AS sequence_id", "9 AS __rank", "10 AS __bucket")
    got = packing.pack(cut).select("offset", "sequence_id", "__rank", "__bucket", "sequence_id_", "offset_").collect()
    assert {tuple(r)[:4] for r in got} == {(7, 8, 9, 10)} and len({tuple(r)[4:] for r in got}) == len(got) == cut.count()


def test_op3_and_op10_give_the_librarys_ids(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    encoder = tokens.Encoder.of(tokens.default_vocabulary()).tokenizer
    ids = {i: encoder.encode(t, add_special_tokens=False).ids for i, t in docs.items()}
    pieces = registry.QUERIES["op3_packing"](spark, SF).collect()
    seen = {}
    for r in pieces:
        own = ids[r.doc_id] + [1]
        part = own[r.start : r.start + r.length]
        assert r.doc_tokens == len(own) and len(part) == r.length and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        seen.setdefault(r.doc_id, []).append((r.start, r.length))
    for i, spans in seen.items():
        spans.sort()
        assert [a for a, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1]] and sum(n for _, n in spans) == len(ids[i]) + 1
    assert set(seen) == set(docs)
    at = 0
    for r in sorted(registry.QUERIES["op10_token_files"](spark, SF).collect()):
        own = ids[r.doc_id] + [0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        at += len(own)


def test_op4_counts_and_hashes_base_spans(spark):
    import hashlib
    import re

    def luhn(digits):
        total = 0
        for i, d in enumerate(reversed([int(c) for c in digits])):
            total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
        return total % 10 == 0

    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = 0
    for r in registry.QUERIES["op4_pii"](spark, SF).collect():
        spans = {k: [m.span() for m in re.finditer(p, docs[r.doc_id]) if ok(m[0])] for k, (p, ok) in rules.items()}
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(spans[k]) for k in rules]
        text = ",".join(f"{k}:{a}:{b}" for k in rules for a, b in spans[k])
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set((r.spans or "").split(","))
        found += sum(map(len, spans.values()))
    assert found and pii.KINDS == tuple(rules)
