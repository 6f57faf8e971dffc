"""Personal data, ranked search and vector codes against plain versions, and on odd rows."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import orchard, personal, queries, ranked, topk
from tests.llm import brute

ODD = [
    "", "a@b", "@b.c", "a@b.c@d.e", "x.y+z@mail.example.co.uk.", "1.2.3.4.5.6.7.8.9", "256.1.1.1 0255.1.1.1 1.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112",
    "+1 (988) 555-2485", "+1 2", "++49 30 123456789", "+1 (988) 555-2485 4111111111111111", "1 " * 300, "9" * 6000, "@" * 50 + "((((", "1.1.1." + "0" * 5000 + "1",
    "mail a@b.c, a@b.c", "\U0001f600 +1 (988) 555-2485 \U0001f600 a@b.c",
]


def _rows(df):
    return sorted(df.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or ""))


def test_patterns_are_the_written_ones():
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choice("ab1209.@+-() \n") for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    for t in texts:
        assert [(a, personal.KINDS[k], b) for a, k, b in personal.base_spans(t)] == brute.personal_spans(t), t
        personal.nodes_of(t, personal.base_spans(t))


def test_messages_are_those_of_a_plain_version():
    rng = np.random.default_rng(2)
    n = 9
    features = rng.integers(1, 1 << len(personal.FEATURES), n)
    graph = personal.Graph(features, np.array([0] * 6 + [1] * 3), np.array([5, 6, 5, 5, 6, 7, 5, 5, 7]), np.array([0, 1, 1, 0, 1, 0, 1, 0, 1], bool))
    chain, skip = graph.pairs()
    assert list(zip(*chain, strict=True)) == [(0, 1), (1, 2), (3, 4), (7, 8)]  # none between texts
    assert sorted(zip(*(x.tolist() for x in skip), strict=True)) == [(0, 2), (1, 4), (2, 3), (6, 7)]
    field = personal.Field(rng.normal(size=(len(personal.FEATURES), 5)) / 4, rng.normal(size=(5, 5)), personal.prior().skip)
    own = (graph.features @ field.nodes).tolist()
    want = brute.loopy(own, list(zip(*chain, strict=True)), list(zip(*skip, strict=True)), field.chain.tolist(), field.skip.tolist(), 7, 0.5)
    assert np.allclose(personal.chances(graph, field, sweeps=7), want)


def test_slopes_of_the_pseudo_likelihood():
    rng = np.random.default_rng(8)
    graph = personal.Graph(rng.integers(1, 1 << len(personal.FEATURES), 40), np.zeros(40, int), rng.integers(0, 9, 40), np.ones(40, bool))
    labels = rng.integers(1, 5, 40)  # none is unknown
    hidden = np.empty(0, np.int64)

    def cost(field):
        logits = graph.features @ field.nodes
        for (left, right), w in zip(graph.pairs(), (field.chain, field.skip), strict=True):
            logits[right] += w[labels[left]]
            logits[left] += w[:, labels[right]].T
        fit = -np.log(personal._softmax(logits)[np.arange(40), labels]).mean()
        return fit + personal.FIRM / 2 * sum(((a - b) ** 2).sum() for a, b in zip(field, personal.prior(), strict=True))

    found = personal.fitted(graph, labels, hidden, steps=3000)
    assert cost(found) < cost(personal.prior()) - 0.5
    for i in range(3):  # no step in any direction lowers the cost
        for _ in range(20):
            step = [np.zeros_like(w) for w in found]
            step[i] += rng.normal(size=step[i].shape) * 0.01
            if i == 2:
                step[i] = (step[i] + step[i].T) / 2
            assert cost(personal.Field(*(w + s for w, s in zip(found, step, strict=True)))) > cost(found) - 1e-4


def test_personal_data(spark, sample, nothing):
    told = "Call +1 (988) 555-2485 now. " + "Nothing to see here, " * 50 + "then ask for 988-555-2485 again."
    silent = "The parcel 988-555-2485 has come."
    docs = sample.select("doc_id", "text", "lang", F.lit(1).alias("spans"), F.lit(1).alias("base")).unionByName(
        spark.createDataFrame([(8000, told, "en", 1, 1), (8001, silent, "en", 1, 1), *((8100 + i, t, "x", 1, 1) for i, t in enumerate(ODD))], "doc_id bigint, text string, lang string, spans int, base int")
    )
    rows = _rows(docs)
    found = personal.scanned(docs).collect()
    want = Counter((r["doc_id"], *brute.personal_spans(r["text"])) for r in rows)
    assert Counter((r["doc_id"], *((s["start"], s["kind"], s["end"]) for s in r["spans"] if s["base"])) for r in found) == want
    more = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"] if not s["base"]] for r in found}
    at = told.rindex("988-555")
    assert more[8000] == [("phone", at, at + 12)] and not more[8001]
    for r in found:
        spans = [(s["start"], personal.KINDS.index(s["kind"])) for s in r["spans"]]
        assert spans == sorted(spans)
        assert all(s["base"] or s["score"] >= personal.SURE for s in r["spans"])
    assert personal.scanned(nothing).count() == 0
    assert personal.learned(personal.scanned(nothing).selectExpr("array(1) features", "array(2L) keys", "array(true) chained").limit(0)) is not None


def test_personal_query(spark, tmp_path):
    texts = ["a@b.c 1.2.3.4", None, "+1 (988) 555-2485"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in queries.op11_pii(spark, str(tmp_path)).collect()}
    import hashlib

    assert found[0]["spans"] == "email:0:5,ip:6:13" and (found[0]["n_email"], found[0]["n_ip"], found[0]["n_card"], found[0]["n_phone"]) == (1, 1, 0, 0)
    assert found[1]["spans"] == "" and found[1]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert found[2]["base_sha256"] == hashlib.sha256(b"phone:0:17").hexdigest()


def _want_ranks(docs, items, top=20):
    pairs = [(r["doc_id"], r["text"]) for r in docs]
    return Counter((i, k, d, s) for i, t in dict.fromkeys(items) for k, (d, s) in enumerate(brute.best_documents(pairs, t, top), 1))


@pytest.mark.parametrize("bounds", [(4096, 1 << 18, 1 << 17), (7, 50, 10)])
def test_ranked_search(spark, sample, nothing, monkeypatch, bounds):
    for name, value in zip(("DOCS", "POSTINGS", "TERMS"), bounds, strict=True):
        monkeypatch.setattr(ranked, name, value)
    docs = _rows(sample)
    items = [(1, docs[0]["text"][:300]), (2, docs[5]["text"][:80] + " " + docs[40]["text"][:200]), (2, "shared1 shared2 und the the the"), (3, None), (4, "nowherefound"), (5, ""), (None, "near1 NEAR2 first")]
    items += [items[0]]
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id bigint, text string, rank int, h int")
    got = Counter(tuple(r) for r in ranked.ranked(sample, asked).collect())
    assert got == _want_ranks(docs, items)
    assert Counter(tuple(r) for r in ranked.ranked(sample, asked, top=3).collect()) == _want_ranks(docs, items, 3)
    if bounds[0] == 4096:
        assert ranked.ranked(nothing, asked).count() == 0 and ranked.ranked(sample, asked.limit(0)).count() == 0


def test_range_maxima():
    rng = np.random.default_rng(1)
    ends = np.array([1, 4, 4 + 33, 100])
    docs = np.concatenate([np.arange(n) for n in (1, 3, 33, 63)])
    impacts = rng.integers(0, 9, 100)
    block = ranked.Block(np.arange(4), ends, docs, impacts, 70)
    low, high = np.sort(rng.integers(37, 101, (2, 500)), axis=0)
    at = block.maxima(low, high)
    assert all((m == -1) if a == b else (a <= m < b and impacts[m] == impacts[a:b].max()) for a, b, m in zip(low, high, at, strict=True))


def test_orchard_search_finds_the_nearest_with_fewer_distances():
    rng = np.random.default_rng(6)
    for book in (rng.integers(-4, 5, (16, 2)), rng.integers(-4000, 4000, (16, 8)), np.zeros((16, 3), np.int64), rng.integers(-9, 9, (1, 4)), np.repeat(rng.integers(-3, 3, (4, 2)), 4, axis=0)):
        points = np.concatenate([rng.integers(book.min() - 2, book.max() + 3, (500, book.shape[1])), book])
        at, gap = orchard.nearest(points, book)
        assert [(int(a), int(g)) for a, g in zip(at, gap, strict=True)] == [brute.nearest_entry(p, book) for p in points]
    centres = rng.integers(-4000, 4000, (16, 4))
    points = (centres[rng.integers(0, 16, 2000)] + rng.integers(-100, 100, (2000, 4))).astype(np.int64)
    measured: list[int] = []
    orchard.nearest(points, centres, measured)
    assert measured[0] < 16 * len(points) / 3


@pytest.mark.parametrize("rows", [300, 5])
def test_codes(spark, rows):
    rng = np.random.default_rng(rows)
    vectors = rng.normal(0, 0.4, (rows, 16))
    vectors[3] = vectors[1]
    data = [(int(i), [float(x) for x in v], int(i) % 3 if i % 4 else None, 9) for i, v in enumerate(vectors)]
    data += [data[2], (None, data[0][1], 1, 9), (900, None, 1, 9), (901, [1.0, None] * 8, 1, 9), (902, [float("nan")] * 16, 1, 9), (903, [float("-inf")] * 16, None, 9), (904, [1.0, 2.0], 1, 9), (905, [], 1, 9)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>, label int, id int").repartition(3)
    kept = sorted((r for r in data if r[1] and len(r[1]) == 16 and all(x is not None and np.isfinite(x) for x in r[1])), key=lambda r: (r[0] is None, r[0] or 0))
    whole = [[int(np.floor(x * 4096)) for x in r[1]] for r in kept]
    codes, errors, books = brute.codebooks(whole)
    labels = Counter()
    for r, e in zip(kept, errors, strict=True):
        labels[r[2]] += e
    found, model = orchard.compressed(df.withColumn("embedding", topk.quantised(F.col("embedding"), 4096)))
    assert [b.tolist() for b in model.books] == books
    got = Counter((r["id"], tuple(r["codes"]), r["error"], r["label_error"]) for r in found.collect())
    assert got == Counter((r[0], tuple(c), e, labels[r[2]]) for r, c, e in zip(kept, codes, errors, strict=True))
    for v, c, e in zip(whole, codes, errors, strict=True):
        assert sum((a - b) ** 2 for a, b in zip(v, orchard.decoded(c, model), strict=True)) == e
    empty, none = orchard.compressed(df.limit(0))
    assert empty.count() == 0 and none.books == []
