"""The registered queries against their SQL, and the pipeline against a plain version."""

from __future__ import annotations

from collections import Counter

import pytest
import regex

import corpus_pipeline
from ledgerlens.llm import queries
from ledgerlens.llm.quality import STOP_WORDS
from tests.comparison import connect, differences
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"
SQL = queries.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    with connect(SF_DIR) as opened:
        yield opened


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, connection, name):
    assert differences(queries.queries()[name](spark, SF_DIR), connection, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(SQL)))
def test_query_returns_its_whole_table(spark, name):
    found = queries.queries()[name](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert found.select("doc_id").distinct().count() == docs.count()


def _kept(text):
    n, chars, symbols, twice, repeats = brute.quality_counts(text)
    w = brute.words(text)
    lines = [x for x in text.split("\n") if brute.WORD.search(x)]
    short = [x for x in w if regex.fullmatch(r"[\p{L}\p{M}]{1,4}", x)]
    stop = max(sum(x.lower() in STOP_WORDS for x in w), len(short) - len(set(short)))
    shouted = sum(len(x) > 1 and bool(regex.search(r"\p{Lu}", x)) and not regex.search(r"\p{Ll}", x) for x in w)
    return (
        n >= 50 and 100 * repeats <= 50 * n and 150 * n <= 100 * chars <= 1500 * n and 100 * symbols <= 25 * n
        and 4 * n <= 100 * stop and 100 * twice <= 40 * len(lines) and 100 * shouted <= 40 * n
    )


def test_pipeline_against_a_plain_version(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    rows = [(r["doc_id"], r["text"], r["source"]) for r in rows if _kept(r["text"])]
    first = brute.near_classes([t for _, t, _ in rows])
    rows = [r for i, r in enumerate(rows) if first[i] == i]
    cut = brute.substring_rows([t for _, t, _ in rows])
    rows = [(i, x[3] if x[1] else t, s) for (i, t, s), x in zip(rows, cut, strict=True)]
    copies = brute.mix_copies([(i, s, len(brute.words(t))) for i, t, s in rows])
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for (i, t, _), n in zip(rows, copies, strict=True):
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
        start = 0
        for size in brute.pieces(len(ids)):
            want[(i, start, tuple(ids[start : start + size]))] += n
            start += size
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter((r["doc_id"], r["start"], tuple(r["ids"])) for r in found) == +want
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near duplicates", "substrings", "mixing", "packing"]


def test_pipeline_on_odd_rows_and_an_empty_table(spark, sample, nothing, tmp_path):
    nothing.write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    sample.unionByName(sample.filter("doc_id IS NULL OR doc_id % 7 = 0")).write.parquet(f"{tmp_path}/odd/documents.parquet")
    found = corpus_pipeline.run(spark, f"{tmp_path}/odd")
    judged = corpus_pipeline.quality_stage(spark, sample, "")
    assert judged.columns == corpus_pipeline.COLUMNS
    passed = {r["doc_id"] for r in judged.collect()}
    ids = {r["doc_id"] for r in found.select("doc_id").distinct().collect()}
    assert ids and ids <= passed
    assert found.filter("length < 1 OR length > 1024 OR length != size(ids)").count() == 0
