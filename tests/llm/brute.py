"""Plain versions of the operators, one document after the other, to compare with."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


# Personal data

PII = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def _luhn(digits):
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def pii_spans(text):
    found = []
    for kind, pattern in PII.items():
        for m in pattern.finditer(text or ""):
            digits = "".join(c for c in m.group() if c in "0123456789")
            if (
                kind == "email"
                or kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))
                or kind == "card" and 16 <= len(digits) <= 19 and _luhn(digits)
                or kind == "phone" and 8 <= len(digits) <= 15
            ):
                found.append((kind, m.start(), m.end()))
    return found


def joined(spans):
    return ",".join(f"{k}:{i}:{j}" for k, i, j in spans)


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


# SimHash


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text, size):
    w = words(lower_ascii(text))
    if not w:
        return []
    return [" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))]


def simhash(text, size=4):
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, size)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(docs, bits=4, size=4):
    """docs: (id, text) pairs. The smallest id reachable, per document, in their order."""
    prints = [simhash(text, size) for _, text in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(docs):
        r = root(i)
        if key is not None:
            least[r] = min(least.get(r, key), key)
    return prints, [least.get(root(i)) for i in range(len(docs))]


# Quality rules


def text_rules(text):
    text = text or ""
    w = words(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    n = len(w)
    return {
        "n_words": n,
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": dup,
        "n_repeat_words": len(covered),
        "base_failed": n < 10 or 100 * len(covered) > 20 * n,
    }


def _normal(line):
    return re.sub(r"[\x20\x09\x0B-\x0D]+", " ", line.lower()).strip(" ")


def frequent_lines(docs, min_documents, share):
    """docs: (host, text) pairs. Per host the normalised lines that are frequent there."""
    texts = {}
    for host, text in docs:
        texts.setdefault(host, set()).add(text or "")
    out = {}
    for host, own in texts.items():
        count = Counter(line for t in own for line in {_normal(x) for x in t.split("\n")} - {""})
        out[host] = {line for line, n in count.items() if n > min_documents and n > share * len(own)}
    return out


def quality(docs, min_documents=10, share=0.02, lost_percent=70):
    """docs: (host, text) pairs. (rules, lost words, kept, text left) per document."""
    often = frequent_lines(docs, min_documents, share)
    out = []
    for host, text in docs:
        rules = text_rules(text)
        lines = (text or "").split("\n")
        bad = [_normal(line) in often[host] for line in lines]
        lost = sum(len(words(line)) for line, b in zip(lines, bad) if b)
        kept = not rules["base_failed"] and 100 * lost <= lost_percent * rules["n_words"]
        out.append((rules, lost, kept, "\n".join(line for line, b in zip(lines, bad) if not b)))
    return out


# Secrets

ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def secret_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return [(("assign", "access", "hex")[k], i, j) for i, k, j in sorted(found)]


# Documents in descending order of id, each with the next one's text at its end


def edited_texts(docs):
    """docs: (id, text) pairs with different ids. id -> (edited text, next text)."""
    order = sorted(docs, reverse=True)
    out = {}
    for k, (key, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1] or ""
        text = text or ""
        cut = len(text) // 3
        out[key] = (text[: len(text) - cut] + following[:cut], following)
    return out


def shingle_set(text, size=5):
    w = words((text or "").lower())
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


# Centroid clusters


def clusters(vectors, k, rounds, dims, seed=2, scale=256):
    """Per kept (id, vector): cluster, distance, inertia of the cluster; then the inertia of all and the centroids."""
    kept = [
        (i, [math.floor(scale * float(x)) for x in v])
        for i, v in vectors
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda row: (sha256(f"{seed}:{'null' if row[0] is None else row[0]}"), row[1]))
    centroids = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        for n, rows in members.items():
            centroids[n] = [sum(x) // len(rows) for x in zip(*rows)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, n, d in found:
        inertia[n] += d
    return [(i, n, d, inertia[n]) for i, n, d in found], sum(inertia.values()), centroids


# Repeats


def without_repeats(docs, window):
    """Per (id, text): words, words removed, kept text."""
    least = {}
    place = lambda i: (i is None, i or 0)
    for i, text in docs:
        w = words(text)
        for at in range(len(w) - window + 1):
            key = tuple(w[at : at + window])
            least[key] = min(least.get(key, place(i)), place(i))
    out = []
    for i, text in docs:
        w = words(text)
        gone = set()
        for at in range(len(w) - window + 1):
            if least[tuple(w[at : at + window])] < place(i):
                gone.update(range(at, at + window))
        out.append((i, len(w), len(gone), " ".join(x for at, x in enumerate(w) if at not in gone)))
    return out


# Two tokenizers


def alignment(texts, a, b):
    """Per text: n_a, n_b, n_groups, n_links, n_best, count_sum, groups. `a` and `b` give (id, bytes) of a text."""
    found, counts = [], Counter()
    for text in texts:
        x, y = (a(" " + text), b(text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if not text or b"".join(t for _, t in x) != whole or b"".join(t for _, t in y) != whole:
            found.append(None)
            continue
        spans = []
        for side in (x, y):
            at, out = 0, []
            for number, token in side:
                out.append((number, at, at + len(token)))
                at += len(token)
            spans.append(out)
        links, j = [], 0
        for n, s, e in spans[0]:
            while spans[1][j][2] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < e:
                links.append((n, spans[1][k][0]))
                k += 1
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        start, groups = 0, []
        for end in ends:
            sides = [",".join(str(n) for n, s, e in side if start <= s and e <= end) for side in spans] if len(ends) < 400 else None
            groups.append(sides and "|".join(sides))
            start = end
        found.append((len(x), len(y), len(ends), links, ";".join(groups) if groups and groups[0] else None))
        counts.update(set(links))
    best = {}
    for (n, _), c in counts.items():
        best[n] = max(best.get(n, 0), c)
    return [
        (0, 0, 0, 0, 0, 0, "")
        if f is None
        else (*f[:3], len(f[3]), sum(counts[p] == best[p[0]] for p in f[3]), sum(counts[p] for p in f[3]), f[4])
        for f in found
    ]


# Shards


def uniform(name, seed=42):
    return (int(hashlib.md5(f"{seed}:{name}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def shards(docs, n, seed=42):
    """docs: (id, source, text). id -> (shard, slot), for different ids."""
    groups = {}
    for key, source, text in docs:
        body = (text or "").encode()
        size, crc = len(body) + 1, zlib.crc32(body)
        drawn = uniform(f"{'null' if key is None else key}:{size}:{crc}", seed)
        groups.setdefault("~" if source is None else f"={source}", []).append((drawn, key, crc, size))
    placed = []
    for g, rows in groups.items():
        phase = uniform(g, seed)
        placed += [((i + phase) / len(rows), g, i, row[1]) for i, row in enumerate(sorted(rows))]
    order = [row[-1] for row in sorted(placed)]
    first = [-(-k * len(order) // n) for k in range(n)]
    return {key: (i * n // len(order), i - first[i * n // len(order)]) for i, key in enumerate(order)}


# Sketches


def spark_long(value):
    return value - (1 << 64) if value >> 63 else value


def spark_hash(values):
    """XXH64 of strings or longs one after the other, each seeded by the one before, as Spark takes it."""
    seed = 42
    for value in values:
        data = value.encode() if isinstance(value, str) else (value & (1 << 64) - 1).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def sketch(text, fraction_bits, size=5):
    w = [spark_hash([x]) for x in words((text or "").lower())]
    every = [spark_hash(w[i : i + size]) for i in range(len(w) - size + 1)]
    if 0 < len(w) < size:
        every = [spark_hash(w)]
    low = {x for x in every if x < 1 << (64 - fraction_bits)}
    return sorted(low or ({min(every)} if every else set()))


def likeness(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


# Additive model


def additive_score(model, x):
    """One document: the number of edges at or below each value is its bin; one number for each feature and each pair."""
    total = model.prior
    for value, edges, table in zip(x, model.edges, model.tables):
        total += table[sum(edge <= value for edge in edges)]
    for (i, j), table in model.pairs.items():
        total += table[sum(e <= x[i] for e in model.coarse[i])][sum(e <= x[j] for e in model.coarse[j])]
    return 1 / (1 + math.exp(-total))
