"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def quality_counts(text):
    w, grams = words(text), defaultdict(list)
    for i in range(len(w) - 2):
        grams[tuple(w[i : i + 3])].append(i)
    covered = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def removed(sequences, window):
    """For each sequence the set of items in windows that start anywhere else too."""
    seen = Counter(tuple(s[i : i + window]) for s in sequences for i in range(len(s) - window + 1))
    return [
        {i + k for i in range(len(s) - window + 1) if seen[tuple(s[i : i + window])] > 1 for k in range(window)} for s in sequences
    ]


def substring_rows(texts, window=35):
    split = [words(t) for t in texts]
    out = []
    for w, gone in zip(split, removed(split, window), strict=True):
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def suffix_rows(texts, window=200):
    raw = [(t or "").encode() for t in texts]
    out = []
    for b, gone in zip(raw, removed(raw, window), strict=True):
        spans = sum(i - 1 not in gone for i in gone)
        out.append((len(b), len(gone), spans, hashlib.sha256(bytes(x for i, x in enumerate(b) if i not in gone)).hexdigest()))
    return out


def shingles(text):
    w = words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] * bool(w))


def near_classes(texts):
    """For each text the first index of its class."""
    bags, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            common = sum((bags[a] & bags[b]).values())
            if common and 5 * common >= 4 * (sum(bags[a].values()) + sum(bags[b].values()) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]


def pieces(n_tokens):
    out = [1024] * (n_tokens // 1024)
    rest, size = n_tokens % 1024, 512
    while size:
        if rest >= size:
            out.append(size)
            rest -= size
        size //= 2
    return out


def mix_targets(size_of):
    """Targets by repeated sharing: whoever is above twice its size stops there."""
    order = sorted((s for s in size_of if s is not None)) + [s for s in size_of if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(size_of.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total >= 2 * size_of[s]}
        if not full:
            return target | {s: left * weight[s] / total for s in open_}
        for s in full:
            target[s] = 2.0 * size_of[s]
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def mix_copies(rows):
    """Copies of each row (doc_id, source, size): Pareto ranks over the whole source."""
    size_of = Counter()
    for _, source, size in rows:
        size_of[source] += size
    goal, copies = mix_targets(size_of), [0] * len(rows)
    for source, total in size_of.items():
        mine = [i for i, r in enumerate(rows) if r[1] == source]
        ratio = goal[source] / total if total else 0.0
        whole, p = math.floor(ratio), ratio - math.floor(ratio)
        for i in mine:
            copies[i] = whole
        if p <= 0:
            continue
        rank = {}
        for i in mine:
            key = f"{'' if rows[i][0] is None else rows[i][0]}:{rows[i][2]}"
            u = (int(hashlib.md5(key.encode()).hexdigest()[:12], 16) + 0.5) / 2**48
            rank[i] = u / (1 - u) / (p / (1 - p))
        upto = 0
        for r in sorted(set(rank.values())):
            for i in (i for i in mine if rank[i] == r):
                if upto + rows[i][2] / 2 <= goal[source] - whole * total:
                    copies[i] += 1
                upto += rows[i][2]
    return copies


def nearest_entry(point, book):
    gaps = [sum((int(a) - int(b)) ** 2 for a, b in zip(point, entry, strict=True)) for entry in book]
    return gaps.index(min(gaps)), min(gaps)


def codebooks(vectors, parts=8, entries=16, rounds=6):
    """Codes, errors and codebooks of integer vectors in order of their ids, one part at a time."""
    size = len(vectors[0])
    codes, errors, books = [[] for _ in vectors], [0] * len(vectors), []
    for p in range(parts):
        cut = [v[size * p // parts : size * (p + 1) // parts] for v in vectors]
        book = [list(x) for x in cut[:entries]]
        for _ in range(rounds):
            at = [nearest_entry(x, book)[0] for x in cut]
            for e in range(len(book)):
                mine = [x for x, k in zip(cut, at, strict=True) if k == e]
                if mine:
                    book[e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
        books.append(book)
        for i, x in enumerate(cut):
            e, gap = nearest_entry(x, book)
            codes[i].append(e)
            errors[i] += gap
    return codes, errors, books


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def best_documents(docs, text, top=20):
    """(doc_id, score) of the best of (doc_id, text) rows for a query text."""
    bags = [Counter(terms(t)) for _, t in docs]
    lengths = [sum(b.values()) for b in bags]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    found = []
    asked = Counter(terms(text))
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in b for b in bags) + 1))) for t in asked}
    for (doc_id, _), bag, length in zip(docs, bags, lengths, strict=True):
        m = 75 + 25 * length * n // total if total else 0
        score = sum(q * weight[t] * (1000000000 * bag[t] // (1000 * bag[t] + 12 * m)) for t, q in asked.items() if t in bag)
        if score > 0:
            found.append((-score, doc_id is None, doc_id or 0))
    return [(None if null else i, -s) for s, null, i in sorted(found)[:top]]


def personal_spans(text):
    """(start, kind, end) by the patterns as they are written."""
    text = text or ""
    kinds = ["email", "ip", "card", "phone"]
    patterns = [
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
    ]
    out = []
    for k, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
            if k == 1 and any(float(x) > 255 for x in m[0].split(".")) or k == 2 and not (12 <= len(digits) <= 19 and sum(doubled) % 10 == 0) or k == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return [(a, kinds[k], b) for a, k, b in sorted(out)]


def loopy(own, chain_edges, skip_edges, chain, skip, sweeps, damp):
    """Chances of each label by message passing, one message at a time."""
    edges = [(u, v, chain) for u, v in chain_edges] + [(u, v, skip) for u, v in skip_edges]
    edges += [(v, u, [list(x) for x in zip(*w, strict=True)]) for u, v, w in edges]
    half, size = len(edges) // 2, len(own[0])
    messages = [[0.0] * size for _ in edges]
    for _ in range(sweeps):
        fresh = []
        for e, (u, _, w) in enumerate(edges):
            back = (e + half) % len(edges)
            total = [own[u][a] + sum(messages[k][a] for k, x in enumerate(edges) if x[1] == u and k != back) for a in range(size)]
            out = [math.log(sum(math.exp(total[a] + w[a][b]) for a in range(size))) for b in range(size)]
            fresh.append([x - max(out) for x in out])
        messages = [[damp * x + (1 - damp) * y for x, y in zip(m, f, strict=True)] for m, f in zip(messages, fresh, strict=True)]
    chances = []
    for i, o in enumerate(own):
        total = [math.exp(o[a] + sum(messages[k][a] for k, x in enumerate(edges) if x[1] == i)) for a in range(size)]
        chances.append([x / sum(total) for x in total])
    return chances


def license_rows(texts, templates, phrases, rarest=12, enough=60):
    """Labels, score and matches (label, place, score, template) of each text by its rarest licence words, place by place."""
    files = [terms(t) for t in texts]
    vocabulary = {w for t in templates for w in t.text.split()}
    held = Counter(w for f in files for w in set(f) & vocabulary)
    weight = {w: 1 + round(1000 * max(0.0, math.log((len(files) + 1) / (held[w] + 1)))) for w in vocabulary}

    def holds(file, phrase):
        p = phrase.split()
        return any(file[i : i + len(p)] == p for i in range(len(file) - len(p) + 1))

    rows = []
    for file in files:
        matches = []
        for number, t in enumerate(templates):
            posted = sorted(enumerate(t.text.split()), key=lambda at: (-weight[at[1]], at[0]))[:rarest]
            if not holds(file, t.must_hold):
                continue
            whole = sum(weight[w] for _, w in posted)
            best = (0.0, 0)
            for shift in range(-len(t.text.split()), len(file)):
                found = sum(weight[w] for at, w in posted if 0 <= shift + at < len(file) and file[shift + at] == w)
                best = max(best, (found / whole, -shift))
            if best[0] * 100 >= enough:
                matches.append((t.label, -best[1], best[0], number))
        labels = {m[0] for m in matches} | {label for p, label in phrases.items() if holds(file, p)}
        rows.append((",".join(sorted(labels)), max((m[2] for m in matches), default=0.0), sorted(matches)))
    return rows
