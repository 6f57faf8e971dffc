"""Every operator against a plain version, on real texts and odd cases, and on an empty table."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import licenses, minhash, mixing, packing, quality, sharding, substrings, suffixes, topk, toxicity
from ledgerlens.llm import words as W
from tests.llm import brute


def _rows(sample):
    return sorted(sample.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or ""))


def test_quality_counts_and_untouched_columns(sample, nothing):
    judged = quality.judged(sample)
    assert set(judged.columns) == {*sample.columns, "measures", "base_failed", "failed_rules", "kept"}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = Counter((r["doc_id"], r["text"], *(r["measures"][n] for n in names)) for r in judged.collect())
    assert got == Counter((r["doc_id"], r["text"], *brute.quality_counts(r["text"])) for r in _rows(sample))
    assert all(r["base_failed"] == (r["measures"]["n_words"] < 50 or 100 * r["measures"]["n_repeat_words"] > 50 * r["measures"]["n_words"]) for r in judged.collect())
    assert quality.judged(nothing).count() == 0


def test_clean_documents_are_kept(sample):
    clean = sample.sparkSession.read.parquet("/root/testdata/sf0.01/documents.parquet").join(
        sample.sparkSession.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("quality = 1"), "doc_id"
    )
    judged = quality.judged(clean).filter("NOT kept AND NOT base_failed")
    assert judged.count() == 0


CLEAN = {
    "pl": "Rano poszedł do sklepu i kupił chleb, a potem wrócił do domu, bo na dworze było zimno. Matka czekała na niego w kuchni i robiła herbatę. Nie było już mleka, więc poszedł do sąsiadki, która dała mu szklankę mleka i trochę sera. Wieczorem do domu wrócił ojciec i razem zjedli kolację, a potem poszli spać, bo było już późno.",
    "sv": "Han gick till affären på morgonen och köpte bröd, och sedan gick han hem för att det var kallt ute. Hans mor satt i köket och väntade på honom. Det fanns ingen mjölk kvar, så han gick till grannen som gav honom ett glas mjölk och lite ost. På kvällen kom hans far hem och de åt middag, och sedan gick de och lade sig.",
    "sw": "Asubuhi alikwenda dukani na akanunua mkate na maziwa kwa ajili ya familia yake. Mama yake alikuwa jikoni na alikuwa akipika chai ya asubuhi. Baba alirudi nyumbani jioni na wote walikula chakula cha jioni pamoja. Watoto walicheza nje ya nyumba na baadaye walilala kwa sababu ilikuwa usiku. Siku ya pili walikwenda shule ya kijiji na kurudi nyumbani mchana kwa chakula cha mchana.",
    "ru": "Утром он пошел в магазин и купил хлеб, а потом вернулся домой, потому что на улице было холодно. Мать ждала его на кухне и варила чай. Молока уже не было, и он пошел к соседке, которая дала ему стакан молока и немного сыра. Вечером домой вернулся отец, и они вместе поужинали, а потом легли спать, потому что было уже поздно.",
}


@pytest.mark.parametrize("lang", sorted(CLEAN))
def test_quality_rules_ask_for_no_language(spark, lang):
    text = CLEAN[lang]
    texts = [text, text.upper(), " ".join(w + "!" for w in text.upper().split()), text.replace(". ", "!! ")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    failed = {r["doc_id"]: r["failed_rules"] for r in quality.judged(docs).collect()}
    assert failed[0] == failed[3] == [] and failed[1] == ["shouted words"] and "shouted words" in failed[2]


def test_words_without_function_words_are_rejected(spark):
    rng = random.Random(1)
    salad = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(5, 9))) for _ in range(200))
    docs = spark.createDataFrame([(1, salad)], "doc_id int, text string")
    assert quality.judged(docs).first()["failed_rules"] == ["function words"]


@pytest.mark.parametrize("window", [2, 5, 35])
def test_substring_dedup(sample, nothing, window):
    rows = _rows(sample)
    want = Counter((r["doc_id"], *x[:3]) for r, x in zip(rows, brute.substring_rows([r["text"] for r in rows], window), strict=True))
    got = Counter(tuple(r) for r in substrings.digest(sample, window=window).collect())
    assert got == want
    if window == 35:
        whole = substrings.cleaned(sample)
        assert set(whole.columns) == {*sample.columns, "dedup"}
        texts = Counter((r["doc_id"], r["dedup"]["kept_text"]) for r in whole.collect())
        assert texts == Counter((r["doc_id"], x[3]) for r, x in zip(rows, brute.substring_rows([r["text"] for r in rows]), strict=True))
        assert substrings.digest(nothing).count() == 0


@pytest.mark.parametrize("crowd", [2, 1024])
def test_suffix_dedup(sample, nothing, monkeypatch, crowd):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    rows = [r for r in _rows(sample) if len(r["text"] or "") < 20000]
    some = sample.filter("text IS NULL OR length(text) < 20000")
    want = Counter((r["doc_id"], *x) for r, x in zip(rows, brute.suffix_rows([r["text"] for r in rows]), strict=True))
    assert Counter(tuple(r) for r in suffixes.digest(some).collect()) == want
    assert suffixes.digest(nothing).count() == 0


def test_deep_shallow_order_and_common_prefixes():
    rng = random.Random(3)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.choice([0, 3, 40, 60]))) for _ in range(200)]
    strings += [b"c" * 50 + bytes([x]) for x in range(20)] * 2
    assert [strings[i] for i in suffixes.blind_trie(strings)] == sorted(strings)
    lengths = np.array([len(s) for s in strings])
    table = np.zeros((len(strings), lengths.max()), np.uint8)
    for i, s in enumerate(strings):
        table[i, : len(s)] = list(s)
    order, shared = suffixes.sort_strings(table, lengths, np.zeros(len(strings), np.int64))
    found = [strings[i] for i in order]
    assert found == sorted(strings)
    assert shared[1:].tolist() == [suffixes._common(a, b) for a, b in zip(found, found[1:], strict=False)]


def test_near_classes(sample, nothing):
    rows = _rows(sample)
    first = brute.near_classes([r["text"] for r in rows])
    members = defaultdict(list)
    for r, k in zip(rows, first, strict=True):
        members[k].append(r["doc_id"])
    least = {k: min((i for i in ids if i is not None), default=None) for k, ids in members.items()}
    want = Counter((r["doc_id"], least[k], len(members[k])) for r, k in zip(rows, first, strict=True))
    found = minhash.classes(sample).collect()
    assert Counter((r["doc_id"], r["class_id"], r["class_size"]) for r in found) == want
    kept = minhash.representatives(sample)
    assert kept.columns == sample.columns
    assert Counter(r["doc_id"] for r in kept.collect() if brute.words(r["text"])) == Counter(
        least[k] for k in members if brute.words(rows[k]["text"])
    )
    assert minhash.classes(nothing).count() == 0 and minhash.representatives(nothing).count() == 0


def test_signature_agreement_estimates_weighted_similarity():
    one = [f"w{i}" for i in range(300)]
    other = [w if i % 30 else "x" + w for i, w in enumerate(one)] + one[:40]
    texts = [" ".join(one).encode(), " ".join(other).encode()]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    marks, total = minhash.signatures(*minhash.shingles(data, offsets), 2)
    a, b = (brute.shingles(t.decode()) for t in texts)
    assert total.tolist() == [sum(a.values()), sum(b.values())]
    assert abs((marks[0] == marks[1]).mean() - sum((a & b).values()) / sum((a | b).values())) < 0.12


def test_components_of_a_long_chain(spark):
    links = spark.range(40).selectExpr("id * 3 AS a", "(id + 1) * 3 AS b").unionByName(spark.createDataFrame([(500, 501)], "a bigint, b bigint"))
    found = {r["node"]: r["component"] for r in minhash.components(links).collect()}
    assert found == {**{3 * i: 0 for i in range(41)}, 500: 500, 501: 500}


def test_mixing(sample, nothing):
    rows = _rows(sample)
    sizes = [(r["doc_id"], r["source"], len(brute.words(r["text"]))) for r in rows]
    want = Counter((i, n, n * c) for (i, _, n), c in zip(sizes, brute.mix_copies(sizes), strict=True))
    mix = mixing.mixed(sample)
    got = mix.select("doc_id", "mix.size", "mix.taken", "mix.target", "mix.source_size", "source").collect()
    assert Counter((r["doc_id"], r["size"], r["taken"]) for r in got) == want
    assert all(r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"] for r in got)
    copies = mixing.repeated(mix)
    assert copies.count() == sum(brute.mix_copies(sizes)) and set(copies.columns) == set(sample.columns) - {"mix"}
    assert mixing.mixed(nothing).count() == 0


def test_packing_round_trip(sample, nothing):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    rows = _rows(sample)
    ids = [[*e.ids, 0] for e in tokenizer.encode_batch([r["text"] or "" for r in rows], add_special_tokens=False)]
    want = Counter()
    for r, of in zip(rows, ids, strict=True):
        start = 0
        for n in brute.pieces(len(of)):
            piece = of[start : start + n]
            want[(r["doc_id"], start, n, zlib.crc32(np.array(piece, "<u4").tobytes()), len(of), tuple(piece))] += 1
            start += n
    found = packing.packed(sample).collect()
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"], tuple(r["ids"])) for r in found) == want
    assert sorted(r["sequence_id"] for r in found) == list(range(len(found))) and all(r["offset"] == 0 for r in found)
    by_id = sorted(found, key=lambda r: r["sequence_id"])
    assert [r["length"] for r in by_id] == sorted((r["length"] for r in found), reverse=True)
    assert packing.packed(nothing).count() == 0


def test_packing_gives_the_ids_of_the_whole_tokenizer(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline
    from ledgerlens.llm import queries

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["hello <|endoftext|> world", "<|endoftext|><|endoftext|>", "<|endoftext| >", "plain  text", "a" + " " * 1_100_000 + "b", "\n" * 1_100_000]
    want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert want[0] == [31373, 220, 50256, 995, 0]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    joined = {}
    for r in sorted(corpus_pipeline.packing_stage(spark, docs, "").collect(), key=lambda r: (r["doc_id"], r["start"])):
        joined.setdefault(r["doc_id"], []).extend(r["ids"])
    assert joined == dict(enumerate(want))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in queries.op1_packing(spark, str(tmp_path)).collect())
    assert found == Counter(
        (i, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes()), len(ids))
        for i, ids in enumerate(want)
        for at, n in zip(np.cumsum([0, *brute.pieces(len(ids))]).tolist(), brute.pieces(len(ids)), strict=False)
    )


def test_long_runs_are_seen_wherever_they_stand(monkeypatch):
    monkeypatch.setattr(packing, "LONG_RUN", 7)
    for before in range(20):
        for n in range(1, 12):
            assert packing.has_long_run("x" * before + " \t\n\u3000" * 3 * (n > 10) + " " * n + "y" * 9) == (n >= 7)
    assert not packing.has_long_run("x      x      x      x")


def test_sharding(sample, nothing):
    rows = _rows(sample)
    found = sharding.sharded(sample, shards=4).collect()
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == want
    slots, sizes = defaultdict(list), Counter()
    for r in found:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(4))
    assert max(sizes.values()) < sum(sizes.values()) / 4 + max(r["size"] for r in found)
    assert sharding.sharded(nothing).count() == 0


def test_a_text_that_fills_a_third_of_the_rows_is_cut(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same " * 20).otherwise(F.concat(F.lit("own "), F.repeat(F.col("id").cast("string"), 20))).alias("text"))
    sizes = [r["n"] for r in sharding.sharded(docs).groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(sizes) == 16 and max(sizes) < 1.1 * sum(sizes) / 16 and min(sizes) > 0.9 * sum(sizes) / 16


def test_license_base_places_and_labels(sample, nothing):
    rows = _rows(sample)
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    want = Counter()
    for r in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        at = [(i, label) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        places = [i for i, _ in at]
        want[(r["doc_id"], len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at})))] += 1
    found = licenses.scanned(sample).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in found) == want
    assert all(set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) or not r["base_labels"] for r in found)
    assert all(0 <= r["score"] <= 1 for r in found)
    assert licenses.scanned(nothing).count() == 0


def test_licenses_are_recognised_by_position(spark):
    notice = "Redistribution and use in source and binary forms, with or without modification, are permitted"
    texts = [f"intro {notice} outro", " ".join(reversed(notice.split())), "Licensed under CC BY-NC 4.0.", "source and binary forms"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    labels = {r["doc_id"]: r["labels"] for r in licenses.scanned(docs).collect()}
    assert labels == {0: "bsd", 1: "", 2: "cc-by-nc", 3: ""}


def test_license_labels_scores_and_matches(sample):
    """All labels, scores and places, of whole, broken, cut, mixed and repeated notices among common words."""
    rng = random.Random(6)
    notices = [t.text for t in licenses.TEMPLATES]
    texts = [r["text"] for r in _rows(sample) if len(r["text"] or "") < 20000]
    for notice in notices:
        w = notice.split()
        changed = [rng.choice(["the", "of", x, x, x]) for x in w]
        texts += [f"of the {notice} the of", " ".join(changed), " ".join(w[2:]), " ".join(w[:-2]), f"{notice} {notice}", f"{' '.join(w[:4])} and {' '.join(w[4:])}", notice.upper()]
    texts += [None, "", "the of in and", *(f"{a}. {b}" for a, b in zip(notices, notices[1:]))]
    docs = sample.sparkSession.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r["doc_id"]: r for r in licenses.scanned(docs).collect()}
    for k, (labels, score, matches) in enumerate(brute.license_rows(texts, licenses.TEMPLATES, licenses.BASE_PHRASES)):
        got = found[k]
        assert (got["labels"], round(got["score"], 12)) == (labels, round(score, 12)), texts[k]
        assert [(m["label"], m["place"], m["template"]) for m in got["matches"] or []] == [(a, b, d) for a, b, _, d in matches], texts[k]


def test_a_template_posts_its_rarest_words_only():
    """However many words a template has, it posts a bounded number; common ones only where it has no others."""
    vocabulary = {w for t in licenses.TEMPLATES for w in t.text.split()}
    weight = {w: 5 if w in {"the", "of", "in", "or", "and", "to", "is"} else 5000 for w in vocabulary}
    posted = licenses.postings(weight)
    for number, t in enumerate(licenses.TEMPLATES):
        mine = [p for p in posted if p[1] == number]
        n_rare = sum(weight[w] > 5 for w in t.text.split())
        assert len(mine) == min(licenses.RAREST, len(t.text.split()))
        assert sum(p[3] > 5 for p in mine) == min(licenses.RAREST, n_rare)


def test_every_license_of_a_text_is_found(spark):
    notices = [t.text for t in licenses.TEMPLATES]
    pairs = [f"{a} and also {b}" for a in notices for b in notices]
    whole = " or ".join(notices)
    vocabulary = " ".join(sorted({w for n in notices for w in n.split()}))
    texts = [*pairs, whole, *(f"{n} {vocabulary} {vocabulary}" for n in notices), "prose without any"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r["doc_id"]: r for r in licenses.scanned(docs).collect()}
    labels = [t.label for t in licenses.TEMPLATES]
    for k, text in enumerate(texts):
        held = {label for n, label in zip(notices, labels, strict=True) if n in text}
        assert held <= set(found[k]["labels"].split(",")), (text, found[k]["labels"])
        assert not held or found[k]["score"] == 1.0
    assert {m["template"] for m in found[len(pairs)]["matches"]} == set(range(len(notices)))
    assert found[len(texts) - 1]["labels"] == ""


def test_top_k(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(0, 0.3, (700, 24))
    vectors[100:140] = vectors[7]  # ties
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(vectors)]
    odd = [(1000, None), (1020, [1.0, None] + [0.0] * 22), (1040, [float("nan")] * 24), (1060, [float("inf")] * 24), (None, [1.0] * 24), (1080, [0.5, 0.5]), (1100, [])]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>").withColumn("embedding", topk.quantised(F.col("embedding")))
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, block=128, step=8).collect()}
    whole = np.floor(vectors * 64).astype(np.int64)
    want = {}
    for q in range(0, 700, 20):
        order = sorted((i for i in range(700) if i != q), key=lambda i: (-int(whole[q] @ whole[i]), i))[:20]
        want |= {(q, k): (i, int(whole[q] @ whole[i])) for k, i in enumerate(order, 1)}
    assert got == want
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0


def test_toxicity(spark, sample, nothing):
    rng = random.Random(1)
    vocabulary = ["the", "of", "and"] + [f"w{i}" for i in range(300)]
    marks = ["badword", "vileterm", "rotten"]
    texts = []
    for i in range(900):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(20, 80))]
        if i % 4 == 0:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(marks) + rng.choice(["", ",", "s"]))
        texts.append((i, " ".join(w), int(i % 4 == 0)))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, toxic int")
    labels = docs.select("doc_id", "toxic")
    found = {r["doc_id"]: r for r in toxicity.scored(docs.drop("toxic"), labels).collect()}
    held = [i for i in found if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i in found if found[i]["held_out"]} == set(held)
    right = sum(found[i]["predicted"] == (i % 4 == 0) for i in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    assert toxicity.scored(sample, labels).filter("score IS NULL").count() == 0
    assert toxicity.scored(sample, labels).count() == sample.count()
    assert toxicity.scored(nothing, labels).count() == 0
    assert {r["score"] for r in toxicity.scored(docs, labels.limit(0)).collect()} == {0.0}


def test_odd_sketches_never_overstate_a_difference():
    rng = np.random.default_rng(3)
    for size in (1, 40, 400, 6000):
        words = [f"w{i}" for i in rng.integers(0, max(2, size // 3), size)]
        other = list(words)
        for at in rng.integers(0, size, max(1, size // 25)):
            other[at] = "new"
        texts = pa.array([" ".join(words), " ".join(other)])
        found = minhash.shingles(*W.text_bytes(texts))
        a, b = minhash.sketches(*found, 2)
        bags = [Counter(tuple(t[i : i + 5]) for i in range(max(1, len(t) - 4))) for t in (words, other)]
        differs = ((bags[0] - bags[1]) + (bags[1] - bags[0])).total()
        bound = int(np.bitwise_count(a ^ b).sum())
        assert bound <= differs and (bound > differs // 2 or size == 6000)
