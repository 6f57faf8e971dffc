"""Packing by power-of-two decomposition: every document is cut into pieces of binary lengths.

A document of T tokens gives T div 1024 pieces of 1024 and one for each set bit of the
rest, longest first. A piece is a sequence of its own in the bucket of its length, so
no sequence crosses documents and nothing is padded.

Ids are those of the ``tokenizers`` file of the vocabulary, and a separator id ends each
document. The file's ranks, which ``tiktoken`` reads, give the same ids faster; texts for
which they do not go through the file itself: those with a run of whitespace of
``LONG_RUN``, which can exhaust tiktoken's stack, and with ``added_tokens`` those that
hold an added token's name, such as <|endoftext|>, which is then one id. Without
``added_tokens`` such a name is plain text (``encode_special_tokens`` of ``tokenizers``);
the registered query and the pipeline ask for them, as the file's own setting does. A null or empty text is the separator alone. Null
or repeated ids are legal, equal rows give equal pieces in sequences of their own, an
empty table gives an empty result, and no other column is read.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.staging import over_batches, staged

MOST = 1024
END_ID = 0
#: Characters of whitespace in a run; tiktoken fails somewhere between 600,000 and 1,000,000.
LONG_RUN = 1 << 16
_RUNS = re.compile(r"\s{2,}")
#: Sequences of one length are numbered in so many groups at once.
GROUPS = 256


def has_long_run(text: str) -> bool:
    """A run that long covers one of the places looked at first."""
    if not any(map(str.isspace, text[LONG_RUN - 1 :: LONG_RUN])):
        return False
    return any(m.end() - m.start() >= LONG_RUN for m in _RUNS.finditer(text))


@lru_cache(maxsize=4)
def encoder(path: str | None, added_tokens: bool) -> Callable[[str], list[int]]:
    """Ids of a text by a ranks file; None: the public 50k byte-level vocabulary where the task runs.

    The ``tokenizers`` file lies beside it, with the ending .json; without one there are no
    added tokens.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    ranks_path = Path(path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    with open(ranks_path, "rb") as ranks_file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks_file)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    whole_path = ranks_path.with_suffix(".json")
    names = []
    if added_tokens and whole_path.exists():
        names = [t["content"] for t in json.loads(whole_path.read_text(encoding="utf-8"))["added_tokens"]]

    @lru_cache(maxsize=1)
    def whole() -> Tokenizer:
        tokenizer = Tokenizer.from_file(str(whole_path))
        tokenizer.encode_special_tokens = not added_tokens
        return tokenizer

    def encode(text: str) -> list[int]:
        if any(name in text for name in names) or has_long_run(text):
            return whole().encode(text, add_special_tokens=False).ids
        return fast(text)

    return encode


def piece_lengths(tokens: int, most: int = MOST) -> list[int]:
    rest = tokens % most
    return [most] * (tokens // most) + [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, with_ids: bool = True, added_tokens: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens and, unless told otherwise, the ids of each piece."""
    picked = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))
    columns = [picked.schema["doc_id"].dataType.simpleString(), "bigint", "bigint", "bigint", "bigint"]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, columns, strict=True)) + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, added_tokens)
        for batch in batches:
            owner, rows, ids_of = [], [], []
            for i, one in enumerate(batch.column("text")):
                ids = np.array([*encode(one.as_py() or ""), END_ID], dtype="<u4")
                start = 0
                for length in piece_lengths(len(ids)):
                    piece = ids[start : start + length]
                    owner.append(i)
                    rows.append((start, length, zlib.crc32(piece.tobytes()), len(ids)))
                    if with_ids:
                        ids_of.append(piece.astype(np.int32))
                    start += length
            out = [batch.column("doc_id").take(pa.array(owner, pa.int64()))]
            out += [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 4)]
            out += [pa.array(ids_of, pa.list_(pa.int32()))] if with_ids else []
            yield pa.RecordBatch.from_arrays(out, names=names + ["ids"] * with_ids)

    return over_batches(picked, cut, schema)


def packed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, with_ids: bool = True, added_tokens: bool = False) -> DataFrame:
    """``pieces`` with sequence_id and offset: sequences are numbered through, the longest bucket first.

    Each bucket is numbered in ``GROUPS`` groups of pieces; what reaches the driver is one
    count for each bucket and group.
    """
    cut = pieces(docs, doc_id, text, tokenizer, with_ids, added_tokens)
    grouped = staged(cut.withColumn("_group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(GROUPS)).cast("int")), "pieces")
    counts = sorted(
        ((r["length"], r["_group"], r["n"]) for r in grouped.groupBy("length", "_group").agg(F.count("*").alias("n")).collect()),
        key=lambda r: (-r[0], r[1]),
    )
    before, firsts = 0, []
    for length, group, n in counts:
        firsts.append((length, group, before))
        before += n
    # Eleven lengths and GROUPS groups bound the broadcast.
    first = docs.sparkSession.createDataFrame(firsts, "length bigint, _group int, _first bigint")
    within = F.row_number().over(Window.partitionBy("length", "_group").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")) - 1
    numbered = grouped.withColumn("_within", within).join(F.broadcast(first), ["length", "_group"])
    return numbered.select(*cut.columns, (F.col("_first") + F.col("_within")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
