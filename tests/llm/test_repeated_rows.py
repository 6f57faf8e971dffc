"""One table of null ids, triple rows and one text on a third of the rows, through the operators whose contracts name rows."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import minhash, mixing, queries, sharding, substrings, suffixes, topk, toxicity
from tests.comparison import connect, differences
from tests.llm import brute


@pytest.fixture(scope="module")
def repeated(spark, tmp_path_factory):
    """3,000 rows: a third with a null id and one text, a triple id, an id with two texts, rows of their own."""
    same = "the same words stand in a third of all rows here " * 3
    rows = [(None, same, "src0")] * 1000
    rows += [(i, f"{i} own words of row {i} " * (1 + i % 40), f"src{i % 3}") for i in range(1000, 2980)]
    rows += [(7, "a triple row of some words", "src1")] * 3 + [(8, "one text of two", "src1"), (8, "another text of two", "src1")]
    rows += [(None, None, None)] * 5 + [(9, "", "src2")] * 10
    path = tmp_path_factory.mktemp("repeated")
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5).write.parquet(f"{path}/documents.parquet")
    vectors = [(i, [((i * k) % 17 - 8) / 8.0 for k in range(1, 9)], i % 3) for i in range(300)]
    vectors += [vectors[20]] + [vectors[40]] * 2 + [(60, [1.0] * 8, 1), (None, [1.0] * 8, 1)] + [(301, [0.5] * 8, None)] * 150
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet/0")
    return path, rows


def test_shards_stay_even(spark, repeated):
    path, _ = repeated
    found = sharding.sharded(spark.read.parquet(f"{path}/documents.parquet")).collect()
    sizes, slots = Counter(), defaultdict(list)
    for r in found:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    mean = sum(sizes.values()) / 16
    assert len(sizes) == 16 and max(abs(n - mean) for n in sizes.values()) < 0.1 * mean
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_mix_meets_its_targets(spark, repeated):
    path, rows = repeated
    docs = spark.read.parquet(f"{path}/documents.parquet")
    found = mixing.mixed(docs).select("doc_id", "source", "mix.*").collect()
    taken, goal = Counter(), {}
    for r in found:
        taken[r["source"]] += r["taken"]
        goal[r["source"]] = r["target"]
    # Half of the longest document has 120 words.
    assert all(abs(taken[s] - goal[s]) <= 130 for s in goal), (taken, goal)
    sizes = [(i, s, len(brute.words(t))) for i, t, s in rows]
    want = Counter((i, n, n * c) for (i, _, n), c in zip(sizes, brute.mix_copies(sizes), strict=True))
    assert Counter((r["doc_id"], r["size"], r["taken"]) for r in found) == want
    assert Counter(tuple(r) for r in mixing.mixed(docs).select("doc_id", "source", "mix.*").collect()) == Counter(tuple(r) for r in found)


def test_one_row_of_a_class_is_kept(spark, repeated):
    path, rows = repeated
    found = minhash.classes(spark.read.parquet(f"{path}/documents.parquet")).collect()
    assert len(found) == len(rows)
    blank = sum(not brute.words(t) for _, t, _ in rows)
    classes = {(r["class_id"], r["class_size"]) for r in found if r["class_size"] > 1}
    assert sum(r["kept"] for r in found if r["class_size"] > 1) == len(classes)
    assert sum(r["kept"] for r in found) == blank + len(set(brute.near_classes([t for _, t, _ in rows if brute.words(t)])))


def test_substrings_and_bytes(spark, repeated):
    path, rows = repeated
    docs = spark.read.parquet(f"{path}/documents.parquet")
    texts = [t for _, t, _ in rows]
    want = Counter((i, *x[:3]) for (i, _, _), x in zip(rows, brute.substring_rows(texts), strict=True))
    assert Counter(tuple(r) for r in substrings.digest(docs).collect()) == want
    want = Counter((i, *x) for (i, _, _), x in zip(rows, brute.suffix_rows(texts), strict=True))
    assert Counter(tuple(r) for r in suffixes.digest(docs).collect()) == want


@pytest.mark.parametrize("name", ["op3_mixing", "op8_exact_top_k", "op13_orchard"])
def test_queries_against_sql(spark, repeated, name):
    path, _ = repeated
    with connect(str(path)) as connection:
        for table, files in (("documents", "*.parquet"), ("embeddings", "0/*.parquet")):
            connection.execute(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet/{files}'")
        table = spark.read.parquet(f"{path}/embeddings.parquet/0")
        if name == "op3_mixing":
            found = queries.op3_mixing(spark, str(path))
        elif name == "op8_exact_top_k":
            found = topk.top_k(table.withColumn("embedding", topk.quantised(F.col("embedding"))), F.col("vec_id") % 20 == 0)
        else:
            found = _codes(table)
        assert differences(found, connection, queries.oracle_sql()[name]) is None


def _codes(table):
    from ledgerlens.llm import orchard

    codes, model = orchard.compressed(table.withColumn("embedding", topk.quantised(F.col("embedding"), 4096)))
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return codes.select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error", F.lit(model.sha256()).alias("codebooks_sha256"))


def test_what_teaches_does_not_depend_on_the_order(spark, repeated):
    path, _ = repeated
    docs = spark.read.parquet(f"{path}/documents.parquet")
    labels = spark.range(1000, 2980).select(F.col("id").alias("doc_id"), (F.col("id") % 4 == 0).cast("int").alias("toxic"))
    labels = labels.unionByName(spark.createDataFrame([(8, 1), (8, 1), (7, 0), (None, 1)], "doc_id bigint, toxic int"))
    one, other = (toxicity.learned(d, labels, most=400) for d in (docs, docs.repartition(3)))
    assert all((a == b).all() for a, b in zip(one.embeddings, other.embeddings, strict=True)) and one.offset == other.offset
