"""Personal data by a skip-chain conditional random field over the tokens of a document.

Base spans of four kinds come from patterns. Tokens with an ``@`` or four digits are the
nodes of a graph that labels them as one of the kinds or as nothing; all other tokens can
only be nothing and are context. Besides the chain of neighbouring nodes, skip edges tie
repeated and similar tokens, however far apart: each node to the next one of its document
with equal text, case aside, or, for tokens of seven digits and more, with the same digits
(of up to eleven digits, the last seven). A token that a pattern recognises in one place
thus speaks for its like elsewhere, where the pattern fails.

Loopy message passing (sum-product, damped) gives each node its chances; a node that is of
one kind with a chance of ``SURE`` adds a span, unless a base span is there already.
Neighbours of one kind make one span.

Weights are fitted in numpy by penalised pseudo-likelihood, around the stated prior
weights, on at most ``MOST_DOCS`` documents of at most ``MOST_NODES`` nodes, the first by
a hash of their nodes. Labels are the base spans; for every other node the patterns'
verdict is hidden, so that shape, context and edges learn to do without it; tokens like a
recognised one that the patterns missed are no counter-examples and teach nothing. Without
nodes the prior weights stand. Scanning reads every whole text once, without a shuffle;
messages then pass over the nodes alone.

Null and empty texts have no spans; ids may be null or repeated, and each row is scanned
for itself. An empty table gives an empty result; other columns are not looked at. Memory
follows the nodes of the longest text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.staging import over_batches, staged

# Kinds in the order in which spans of one start are listed, and their patterns.
KINDS = ["email", "ip", "card", "phone"]
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_SPACE = r"\x20\x09-\x0D"
_TOKEN = re.compile(rf"(?<![^{_SPACE}])[^{_SPACE}0-9@]*+[0-9@][^{_SPACE}]*+")
_HEAD = re.compile(r"[0-9A-Za-z+(]")
_TAIL = re.compile(r"[0-9A-Za-z)]")
_OTHER = re.compile(r"[^0-9]+")

# Words before a token that speak for a kind, within so many characters and words.
CUES = [
    {"email", "e-mail", "mail", "mailto", "contact", "courriel", "correo"},
    {"ip", "host", "server", "address", "addr", "adresse", "dirección"},
    {"card", "visa", "mastercard", "amex", "credit", "karte", "carte", "tarjeta"},
    {"phone", "tel", "telephone", "call", "fax", "mobile", "telefon", "téléphone", "teléfono"},
]
CUE_CHARS, CUE_WORDS = 60, 3

# Features of a node, by bit.
FEATURES = [
    "always", "at", "domain", "four numbers", "four bytes", "digits 4-6", "digits 7-8", "digits 9-11", "digits 12-19", "digits 20-",
    "checksum", "plus", "bracket", "dash", "letters", "digits only", "point or comma", *(f"cue {k}" for k in KINDS), "after plus", *(f"pattern {k}" for k in KINDS),
]
_BIT = {name: i for i, name in enumerate(FEATURES)}
LABELS = ["none", *KINDS]

MOST_DOCS, MOST_NODES = 4000, 256
STEPS, RATE = 300, 0.05
#: How firmly the prior weights are believed, as a share of the sample's nodes.
FIRM = 0.002
SWEEPS, DAMP = 12, 0.5
SURE = 0.7
#: Nodes that pass messages together (about; a text's nodes stay together).
LOT = 1 << 15


class Field(NamedTuple):
    """Weights: features x labels, neighbours (left x right label), like tokens (symmetric)."""

    nodes: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def prior() -> Field:
    """The weights that stand where nothing was learned."""
    nodes = np.zeros((len(FEATURES), len(LABELS)))
    nodes[_BIT["always"], 0] = 2.0
    for feature, label, weight in [
        ("domain", "email", 2.0), ("four bytes", "ip", 2.0), ("checksum", "card", 2.0), ("plus", "phone", 1.0), ("bracket", "phone", 0.5),
        ("digits 9-11", "phone", 0.5), ("digits 20-", "none", 2.0), ("digits 4-6", "none", 1.0), ("after plus", "phone", 1.0),
    ]:
        nodes[_BIT[feature], LABELS.index(label)] = weight
    for kind in KINDS:
        nodes[_BIT[f"cue {kind}"], LABELS.index(kind)] = 1.0
        nodes[_BIT[f"pattern {kind}"], LABELS.index(kind)] = 5.0
    skip = np.full((len(LABELS), len(LABELS)), -1.0)
    np.fill_diagonal(skip, 3.5)
    skip[0, 0] = 0.0
    return Field(nodes, 0.3 * np.eye(len(LABELS)), skip)


# -- patterns and nodes --------------------------------------------------------------


def _passes_luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with the run of local characters before it, so that no long run is tried at every start."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        done = found.end() if found else at + 1
        if found:
            yield start, done
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all pattern matches, in code points, in order."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 38:
            digits = _OTHER.sub("", m[0])
            if 12 <= len(digits) <= 19 and _passes_luhn(digits):
                out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_OTHER.sub("", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def _features(text: str, start: int, end: int, digits: str) -> int:
    token = text[start:end]
    n = len(digits)
    groups = token.split(".")
    four = len(groups) == 4 and all(g.isascii() and g.isdigit() and len(g) < 4 for g in groups)
    before = text[max(0, start - CUE_CHARS) : start].lower().split()[-CUE_WORDS:]
    bare = [w.strip(".,:;()[]\"'") for w in before]
    held = {
        "always": True, "at": "@" in token, "domain": bool(_DOMAIN.search(token)), "four numbers": four, "four bytes": four and all(int(g) <= 255 for g in groups),
        "digits 4-6": 4 <= n <= 6, "digits 7-8": 7 <= n <= 8, "digits 9-11": 9 <= n <= 11, "digits 12-19": 12 <= n <= 19, "digits 20-": n >= 20,
        "checksum": 12 <= n <= 19 and _passes_luhn(digits), "plus": token[0] == "+", "bracket": "(" in token or ")" in token, "dash": "-" in token,
        "letters": any(c.isalpha() for c in token[:64]), "digits only": n == len(token), "point or comma": "." in token or "," in token,
        "after plus": any(w[0] == "+" and w[1:2].isdigit() for w in before),
    }
    held |= {f"cue {k}": any(w in CUES[i] for w in bare) for i, k in enumerate(KINDS)}
    return sum(1 << _BIT[name] for name, is_so in held.items() if is_so)


class Node(NamedTuple):
    start: int
    end: int
    features: int
    #: Equal for repeated and similar tokens.
    key: int
    #: Whether the node before stands right before this one.
    chained: bool


def nodes_of(text: str, base: list[tuple[int, int, int]]) -> list[Node]:
    """The tokens of a text that can be personal data."""
    out: list[Node] = []
    token_end = -1
    first = 0  # base spans before it end before the token
    for m in _TOKEN.finditer(text):
        if m.end() - m.start() < 4:
            continue
        digits = _OTHER.sub("", m[0])
        if len(digits) < 4 and "@" not in m[0]:
            continue
        head, end = _HEAD.search(text, m.start(), m.end()), m.end()
        while end > m.start() and not _TAIL.match(text[end - 1]):
            end -= 1
        if not head or head.start() >= end:
            continue
        start = head.start()
        features = _features(text, start, end, digits)
        while first < len(base) and base[first][2] <= start:
            first += 1
        k = first
        while k < len(base) and base[k][0] < end:
            if base[k][2] > start:
                features |= 1 << _BIT[f"pattern {KINDS[base[k][1]]}"]
            k += 1
        like = (digits if len(digits) > 11 else digits[-7:]) if len(digits) >= 7 and "@" not in m[0] else text[start:end].lower()
        chained = token_end >= 0 and text[token_end : m.start()].count(" ") == m.start() - token_end
        out.append(Node(start, end, features, xxhash.xxh64_intdigest(like) - (1 << 63), chained))
        token_end = m.end()
    return out


_SCAN = "base array<struct<kind:int,start:int,end:int>>, starts array<int>, ends array<int>, features array<int>, keys array<bigint>, chained array<boolean>"
_SPAN = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            ids, texts = (batch.column(c).slice(first, 256) for c in ("doc_id", "text"))
            base, nodes = [], []
            for text in texts:
                text = text.as_py() or ""
                spans = base_spans(text)
                base.append([{"kind": k, "start": a, "end": b} for a, k, b in spans])
                nodes.append(nodes_of(text, spans))
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.bool_()]
            lists = [pa.array([[n[k] for n in of] for of in nodes], pa.list_(kind)) for k, kind in enumerate(kinds)]
            names = ["doc_id", "base", "starts", "ends", "features", "keys", "chained"]
            yield pa.RecordBatch.from_arrays([ids, pa.array(base, _SPAN), *lists], names=names)


# -- the field -----------------------------------------------------------------------


class Graph:
    """The nodes of some documents: features, and for each node those tied to it (-1: none)."""

    def __init__(self, features: np.ndarray, owner: np.ndarray, keys: np.ndarray, chained: np.ndarray):
        n = len(features)
        self.features = (features[:, None] >> np.arange(len(FEATURES))) & 1
        places = np.arange(n)
        same = np.append(False, owner[1:] == owner[:-1]) if n else np.zeros(0, bool)
        self.chain = places[chained & same]  # right ends of chain edges; the left end is the node before
        order = np.lexsort((places, keys, owner))
        like = (np.diff(owner[order]) == 0) & (np.diff(keys[order]) == 0)
        self.earlier, self.later = order[:-1][like], order[1:][like]
        #: Number of the set of like nodes that a node is in.
        self.alike = np.zeros(n, dtype=np.int64)
        self.alike[order] = np.append(0, np.cumsum(~like)) if n else 0

    def pairs(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Left and right ends of chain and of skip edges. A node is at most once a left and once a right end of each."""
        return [(self.chain - 1, self.chain), (self.earlier, self.later)]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def chances(graph: Graph, field: Field, sweeps: int = SWEEPS, damp: float = DAMP) -> np.ndarray:
    """Chance of each label for each node, by loopy sum-product message passing."""
    own = graph.features @ field.nodes
    # Messages that reach a node from the left and from the right end of its chain and skip edges.
    arrived = np.zeros((4, *own.shape))
    for _ in range(sweeps):
        belief = own + arrived.sum(axis=0)
        fresh = np.zeros_like(arrived)
        for k, ((left, right), weights) in enumerate(zip(graph.pairs(), (field.chain, field.skip), strict=True)):
            for a in range(0, len(left), LOT):
                u, v = left[a : a + LOT], right[a : a + LOT]
                forth = _log_sum((belief[u] - arrived[2 * k + 1, u])[:, :, None] + weights, 1)
                back = _log_sum((belief[v] - arrived[2 * k, v])[:, None, :] + weights, 2)
                fresh[2 * k, v] = forth - forth.max(axis=1, keepdims=True)
                fresh[2 * k + 1, u] = back - back.max(axis=1, keepdims=True)
        arrived = damp * arrived + (1 - damp) * fresh
    return _softmax(own + arrived.sum(axis=0))


def fitted(graph: Graph, labels: np.ndarray, hidden: np.ndarray, start: Field | None = None, steps: int = STEPS) -> Field:
    """Weights that maximise the pseudo-likelihood of the labels, held near the prior ones.

    ``hidden``: nodes that do not see the patterns' verdict. Nodes without a kind that are
    like one with a kind have an unknown label: they are taken for that kind by those tied
    to them, and teach nothing themselves.
    """
    start = start or prior()
    if not len(labels):
        return start
    kind = np.zeros(len(labels), dtype=np.int64)
    np.maximum.at(kind, graph.alike, labels)
    unknown = (labels == 0) & (kind[graph.alike] > 0)
    labels = np.where(unknown, kind[graph.alike], labels)
    inputs = graph.features.astype(np.float64)
    inputs[np.ix_(hidden, [_BIT[f"pattern {k}"] for k in KINDS])] = 0
    known = np.eye(len(LABELS))[labels]
    weights = [w.copy() for w in start]
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    pairs = graph.pairs()
    for step in range(1, steps + 1):
        logits = inputs @ weights[0]
        for (left, right), w in zip(pairs, weights[1:], strict=True):
            logits[right] += w[labels[left]]
            logits[left] += w[:, labels[right]].T
        wrong = np.where(unknown[:, None], 0, _softmax(logits) - known)
        slopes = [inputs.T @ wrong]
        for left, right in pairs:
            slopes.append(known[left].T @ wrong[right] + wrong[left].T @ known[right])
        slopes[2] = (slopes[2] + slopes[2].T) / 2
        for i, (w, w0, slope) in enumerate(zip(weights, start, slopes, strict=True)):
            slope = slope / len(labels) + FIRM * (w - w0)
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.999 * second[i] + 0.001 * slope**2
            w -= RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Field(*weights)


def pattern_labels(features: np.ndarray) -> np.ndarray:
    """The label that patterns give a node; 0 for none, the first kind of several."""
    out = np.zeros(len(features), dtype=np.int64)
    for label in range(len(KINDS), 0, -1):
        out[(features >> _BIT[f"pattern {KINDS[label - 1]}"]) & 1 == 1] = label
    return out


def learned(scans: DataFrame, most: int = MOST_DOCS) -> Field:
    """A field fitted on a bounded sample of scanned documents."""
    some = scans.filter(F.size("features").between(1, MOST_NODES)).select("features", "keys", "chained")
    some = some.withColumn("at", F.xxhash64("features", "keys", "chained"))
    n = some.count()
    share = min(1.0, 2 * most / max(n, 1))  # keeps the sort small; the first ``most`` are in it but for very odd hashes
    rows = some.filter(F.pmod("at", F.lit(1 << 20)) <= int(share * (1 << 20))).orderBy(F.pmod("at", F.lit(1 << 20)), "at").limit(most).collect()
    sizes = [len(r["features"]) for r in rows]
    features, keys, chained = (np.array([x for r in rows for x in r[c]], dtype=kind) for c, kind in (("features", np.int64), ("keys", np.int64), ("chained", bool)))
    graph = Graph(features, np.repeat(np.arange(len(rows)), sizes), keys, chained)
    return fitted(graph, pattern_labels(features), np.arange(1, len(features), 2))


def added_spans(base: list[dict], nodes: list[tuple[int, int, bool]], label: np.ndarray, chance: np.ndarray, sure: float) -> list[dict]:
    """Spans of nodes of a kind that touch no base span; neighbours of one kind are one span."""
    out: list[dict] = []
    previous = 0
    taken = sorted((b["start"], b["end"]) for b in base)
    reach = np.maximum.accumulate([e for _, e in taken]) if taken else np.zeros(0, np.int64)
    starts = np.array([s for s, _ in taken], dtype=np.int64)
    for (start, end, chained), kind, p in zip(nodes, label.tolist(), chance.tolist(), strict=True):
        before = int(np.searchsorted(starts, end))
        free = not before or int(reach[before - 1]) <= start
        if not kind or p < sure or not free:
            previous = 0
            continue
        if chained and previous == kind and out:
            out[-1] = out[-1] | {"end": end, "score": min(out[-1]["score"], p)}
        else:
            out.append({"kind": kind - 1, "start": start, "end": end, "score": p})
        previous = kind
    return out


_FOUND = "spans array<struct<kind:string,start:bigint,end:bigint,base:boolean,score:double>>"


def _label(field: Field, sure: float):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("features").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            reach = np.cumsum(sizes)
            first = 0
            while first < batch.num_rows:
                passed = int(reach[first - 1]) if first else 0
                last = min(max(first + 1, int(np.searchsorted(reach, passed + LOT, side="right"))), first + 2048)
                last = min(last, batch.num_rows)
                part = batch.slice(first, last - first)
                of = {c: part.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("starts", "ends", "features", "keys", "chained")}
                size = sizes[first:last]
                graph = Graph(of["features"].astype(np.int64), np.repeat(np.arange(len(size)), size), of["keys"], of["chained"].astype(bool))
                chance = chances(graph, field)
                label, sureness = chance.argmax(axis=1), chance.max(axis=1) if len(chance) else np.zeros(0)
                nodes = list(zip(of["starts"].tolist(), of["ends"].tolist(), of["chained"].tolist(), strict=True))
                bounds = np.append(0, np.cumsum(size))
                rows = []
                for i, base in enumerate(part.column("base").to_pylist()):
                    a, b = bounds[i], bounds[i + 1]
                    more = added_spans(base, nodes[a:b], label[a:b], sureness[a:b], sure)
                    spans = [s | {"base": True, "score": 1.0} for s in base] + [s | {"base": False} for s in more]
                    spans.sort(key=lambda s: (s["start"], s["kind"]))
                    rows.append([s | {"kind": KINDS[s["kind"]]} for s in spans])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "spans"])
                first = last

    return run


def scanned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sure: float = SURE) -> DataFrame:
    """doc_id, spans (kind, start, end, base, score; code points, by start and kind) of every row."""
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    scans = staged(over_batches(rows, _scan, f"doc_id {kind}, {_SCAN}"), "personal-scans")
    return over_batches(scans, _label(learned(scans), sure), f"doc_id {kind}, {_FOUND}")


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.getField("kind"), s.getField("start").cast("string"), s.getField("end").cast("string"))), ",")
