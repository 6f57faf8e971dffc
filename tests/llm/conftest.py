from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, text_key string, row string, known int, mix int, _row int, h int"


@pytest.fixture(scope="session")
def sample(spark):
    """Documents of the smallest table, and every odd case, with columns whose names the operators use themselves."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    passage = " ".join(f"shared{i}" for i in range(60))
    long_text = " ".join(f"w{i * 7919 % 5003}" for i in range(30000))
    texts = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in rows]
    texts += [
        (9001, None, None, None), (9002, "", "en", "src1"), (9003, " \t\n\x0b\x0c\r ", "en", None), (9004, "one", "en", "src2"),
        (9005, f"first words {passage} tail a", "en", "src0"), (9006, f"other start {passage} tail b", "en", "src0"),
        (9007, passage + " " + passage, None, "src3"), (9008, long_text, "en", "src0"), (9009, "x y   z\u0085w \U0001f600", "en", "src1"),
        (None, "a text without an id " * 12, "en", "src1"), (9010, "Und und und " * 40, "de", "src1"), (9011, texts[3][1], "en", "src9"),
        (9011, texts[3][1], "en", "src9"), (9012, "a" * 5000, "en", "src1"), (9013, "word\x00null \x1f unit", "en", "src1"),
        (9014, "# " * 300, "en", "src1"), (9015, "line\nline\n \nline", "en", "src1"), (9016, "<|endoftext|> The MIT\nLicense, apache-LICENSE.", "en", "src2"),
    ]
    texts += [(9100 + i, " ".join(f"near{k if k != 37 * (i + 1) else -k}" for k in range(400)), "en", "src0") for i in range(6)]
    data = [(i, t, lang, s, len(t or ""), 1, "k", "r", 2, 3, 4, 5) for i, t, lang, s in texts]
    return spark.createDataFrame(data, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
