"""Toxicity by a convolutional text classifier over hashed word embeddings, trained in numpy.

Words (runs of ASCII letters, digits and non-ASCII bytes, lower-cased) and their first
``STEMS`` bytes, for inflected forms, hash into ``BUCKETS`` embeddings. Filters of ``WIDTHS`` words slide over a text, each keeps its
largest answer, and a logistic unit adds them up. Embeddings start from the log odds of
their bucket, all parameters are then fitted by Adam.

Thresholds are calibrated by language. The language is guessed from function words in
the text itself; no column but the text is an input. A threshold is where the
calibration rows of that language are told apart best, and is moved to 0.5. Languages with fewer than
``FEWEST`` toxic or other rows share one threshold.

The classifier is fitted on the driver on at most ``MOST_ROWS`` labelled rows, the first
by a hash of their id, with whole texts of at most ``LONGEST`` characters; of several texts
with one id the one of least hash teaches. Scoring reads every whole text, a slice at a time.

Null, empty or wordless texts get the score of no filter answering. Labels that are null
teach nothing. Repeated rows are scored alike, ids may be null, an empty table gives an
empty result; without labels of both kinds every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import words as W
from ledgerlens.llm.staging import over_batches

BUCKETS = 1 << 15
STEMS = (4, 5)
SIZE = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
MOST_ROWS = 6000
#: Characters of the longest text that is learned from.
LONGEST = 40000
FEWEST = 20
EPOCHS, BATCH, RATE = 4, 64, 0.003
#: Standard deviations from which the log odds of a bucket are believed at the start.
SURE = 3

# Frequent function words of the languages that are told apart.
FUNCTION_WORDS = {
    "en": ["the", "of", "and", "to", "is", "that", "for", "it", "with", "this"],
    "de": ["der", "die", "und", "den", "von", "zu", "das", "nicht", "mit", "ist"],
    "fr": ["le", "et", "les", "des", "une", "est", "qui", "dans", "pour", "au"],
    "es": ["el", "y", "los", "se", "del", "las", "por", "con", "una", "su"],
}

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_FOLDED = W.BYTE_VALUES.copy()
_FOLDED[0x41:0x5B] = _FOLDED[0x61:0x7B]


class Model(NamedTuple):
    embeddings: np.ndarray
    filters: list[np.ndarray]  # width x SIZE x FILTERS for each width
    biases: np.ndarray
    output: np.ndarray
    offset: float
    thresholds: np.ndarray  # by language, the last for none


def _buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of each word (itself and its stems), the first word of each text, and each text's guessed language."""
    words = W.Words(data, offsets, _IS_WORD)
    h = words.hashes(_FOLDED)
    counts = [np.concatenate([[0], np.cumsum(np.isin(h, marks))]) for marks in _MARKS]
    found = np.array([c[words.bounds[1:]] - c[words.bounds[:-1]] for c in counts])
    language = np.where(found.max(axis=0) > 0, found.argmax(axis=0), len(_MARKS))
    values = _FOLDED[data]
    stems = [
        W.range_hashes(values, words.starts, np.minimum(words.ends, words.starts + size), seed=1) + np.uint64(size) for size in STEMS
    ]
    return (np.stack([h, *stems], axis=1) % np.uint64(BUCKETS)).astype(np.int32), words.bounds, language


def _encoded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


_MARKS = [
    W.Words(*_encoded([" ".join(marks)]), _IS_WORD).hashes(_FOLDED) for marks in FUNCTION_WORDS.values()
]


def _pooled(taps: list[list[np.ndarray]], biases: np.ndarray, buckets: np.ndarray, bounds: np.ndarray, with_places: bool = False):
    """Largest answer of every filter in each text (0 if it has no window), and where it is."""
    n = len(bounds) - 1
    out, places = np.zeros((n, len(taps) * FILTERS), dtype=np.float32), np.full((n, len(taps) * FILTERS), -1)
    for k, tap in enumerate(taps):
        width = len(tap)
        starts = W.window_starts(bounds, width)
        if not len(starts):
            continue
        answers = sum(sum(t[column] for column in buckets.T)[starts + j] for j, t in enumerate(tap))
        room = np.maximum(np.diff(bounds) - width + 1, 0)
        some = np.flatnonzero(room)
        first = np.concatenate([[0], np.cumsum(room[some])[:-1]])
        best = np.maximum.reduceat(answers, first, axis=0)
        columns = slice(k * FILTERS, (k + 1) * FILTERS)
        out[some, columns] = np.maximum(best + biases[columns], 0)
        if with_places:
            row = np.repeat(np.arange(len(some)), room[some])
            for f in range(FILTERS):
                hits = np.flatnonzero(answers[:, f] == best[row, f])
                _, once = np.unique(row[hits], return_index=True)
                places[some, k * FILTERS + f] = starts[hits[once]]
    return (out, places) if with_places else out


def _taps(model: Model) -> list[list[np.ndarray]]:
    """What each bucket adds at each place of each filter."""
    return [[model.embeddings @ f[j] for j in range(len(f))] for f in model.filters]


def _all_buckets(texts: list[str], step: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_buckets`` of many texts, some at a time."""
    parts = [_buckets(*_encoded(texts[i : i + step])) for i in range(0, len(texts), step)]
    words = np.cumsum([0, *(len(b) for b, _, _ in parts)])
    bounds = np.concatenate([[0], *(b[1:] + n for (_, b, _), n in zip(parts, words, strict=False))])
    return np.concatenate([b for b, _, _ in parts]), bounds, np.concatenate([x for _, _, x in parts])


def _adam(parameters: list[np.ndarray]):
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    turn = 0

    def step(gradients: list[np.ndarray]) -> None:
        nonlocal turn
        turn += 1
        for p, g, (m, v) in zip(parameters, gradients, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)

    return step


def train(texts: list[str], labels: np.ndarray, calibrate: np.ndarray) -> Model:
    """A model fitted to the rows outside ``calibrate`` and calibrated on those inside."""
    rng = np.random.default_rng(7)
    buckets, bounds, language = _all_buckets(texts)
    fit = np.flatnonzero(~calibrate)
    seen = np.zeros((2, BUCKETS))
    for i in fit:
        np.add.at(seen[int(labels[i])], np.unique(buckets[bounds[i] : bounds[i + 1]]), 1)
    totals = np.bincount(labels[fit].astype(int), minlength=2)
    odds = np.log((seen[1] + 0.5) / (totals[1] + 1)) - np.log((seen[0] + 0.5) / (totals[0] + 1))
    count, base = seen.sum(axis=0), totals[1] / max(totals.sum(), 1)
    surplus = (seen[1] - count * base) / np.sqrt(count * base * (1 - base) + 1)
    odds[np.abs(surplus) < SURE] = 0  # too rare to tell from chance
    embeddings = rng.normal(0, 0.05, (BUCKETS, SIZE)).astype(np.float32)
    embeddings[:, 0] = np.clip(odds, -3, 5)
    filters = [rng.normal(0, 0.1, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[:, 0, : FILTERS // 2] += 0.5 / len(f)
    biases = np.zeros(len(WIDTHS) * FILTERS, dtype=np.float32)
    output = rng.normal(0, 0.05, len(biases)).astype(np.float32)
    output.reshape(len(WIDTHS), FILTERS)[:, : FILTERS // 2] += 0.2
    offset = np.array([-2.0], dtype=np.float32)
    parameters = [embeddings, *filters, biases, output, offset]
    step = _adam(parameters)
    share = max(float(labels[fit].mean()), 1e-3)
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(fit), max(1, len(fit) // BATCH)):
            words = np.concatenate([buckets[bounds[i] : bounds[i + 1]] for i in rows])
            ends = np.cumsum([0, *(bounds[i + 1] - bounds[i] for i in rows)])
            kinds, local = np.unique(words, return_inverse=True)
            local = local.reshape(words.shape)  # only these embeddings take part
            near = [[embeddings[kinds] @ f[j] for j in range(len(f))] for f in filters]
            pooled, places = _pooled(near, biases, local, ends, with_places=True)
            wrong = 1 / (1 + np.exp(-(pooled @ output + offset))) - labels[rows]
            wrong = (wrong * np.where(labels[rows] > 0, 0.5 / share, 0.5 / (1 - share)) / len(rows)).astype(np.float32)
            back = wrong[:, None] * output[None, :] * (pooled > 0)
            g_embeddings, g_filters = np.zeros_like(embeddings), [np.zeros_like(f) for f in filters]
            for k, f in enumerate(filters):
                for c in range(FILTERS):
                    column = k * FILTERS + c
                    use = np.flatnonzero((back[:, column] != 0) & (places[:, column] >= 0))
                    for j in range(len(f)):
                        for word in words[places[use, column] + j].T:
                            g_filters[k][j, :, c] += back[use, column] @ embeddings[word]
                            np.add.at(g_embeddings, word, back[use, column, None] * f[j, :, c])
            step([g_embeddings, *g_filters, back.sum(axis=0), pooled.T @ wrong, wrong.sum(keepdims=True)])
    model = Model(embeddings, filters, biases, output, float(offset[0]), np.zeros(len(FUNCTION_WORDS) + 1))
    taps, step_size = _taps(model), 200
    pooled = [
        _pooled(taps, biases, buckets[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
        for i, j in ((i, min(i + step_size, len(labels))) for i in range(0, len(labels), step_size))
    ]
    logits = np.concatenate(pooled) @ output + offset[0]
    judged = np.flatnonzero(calibrate) if 0 < labels[calibrate].sum() < calibrate.sum() else fit
    common = _threshold(logits[judged], labels[judged])
    for i in range(len(model.thresholds)):
        mine = judged[language[judged] == i]
        toxic = labels[mine].sum()
        model.thresholds[i] = _threshold(logits[mine], labels[mine]) if min(toxic, len(mine) - toxic) >= FEWEST else common
    return model


def _threshold(logits: np.ndarray, labels: np.ndarray) -> float:
    """Halfway between the neighbours at which the fewest rows fall on the wrong side."""
    order = np.argsort(logits)
    x, y = logits[order], labels[order]
    wrong = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0]])
    best = np.flatnonzero(wrong == wrong.min())
    cut = int(best[len(best) // 2])
    low, high = x[max(cut - 1, 0)], x[min(cut, len(x) - 1)]
    return float((low + high) / 2)


def _score(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taps = _taps(model) if model else []
        for batch in batches:
            data, offsets = W.text_bytes(batch.column("text"))
            scores = [np.zeros(0)]
            for first, last in W.slices(offsets):
                if model is None:
                    scores.append(np.zeros(last - first))
                    continue
                buckets, bounds, language = _buckets(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                logits = _pooled(taps, model.biases, buckets, bounds).astype(np.float64) @ model.output.astype(np.float64) + model.offset
                scores.append(1 / (1 + np.exp(-np.clip(logits - model.thresholds[language], -500, 500))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(scores))], names=["doc_id", "score"])

    return run


def fold(doc_id) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def learned(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", most: int = MOST_ROWS, longest: int = LONGEST) -> Model | None:
    """A model of the labelled rows whose fold is not 0; fold 1 calibrates. None without both kinds."""
    marked = labels.select(labels[doc_id].alias("_id"), labels[label].cast("int").alias("label")).filter("label IN (0, 1)")
    marked = marked.filter(fold(F.col("_id")) != 0).distinct()
    chosen = F.broadcast(marked.orderBy(F.xxhash64("_id"), "_id", "label").limit(most))  # bounded by ``most``
    rows = docs.select(docs[doc_id].alias("_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    short = rows.filter(F.length("text") <= longest)
    first = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    known = short.join(chosen, "_id").groupBy("_id", "label").agg(first)
    known = known.select("text", "label", (fold(F.col("_id")) == 1).alias("calibrate"), F.xxhash64("_id").alias("at")).toPandas()
    known = known.sort_values(["at", "text", "label"])
    if known["label"].nunique() < 2 or known.loc[~known["calibrate"], "label"].nunique() < 2:
        return None
    return train(known["text"].tolist(), known["label"].to_numpy(np.float64), known["calibrate"].to_numpy(bool))


def scored(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", most: int = MOST_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    model = learned(docs, labels, doc_id, text, label, most)
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = over_batches(rows, _score(model), f"doc_id {kind}, score double")
    return found.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
