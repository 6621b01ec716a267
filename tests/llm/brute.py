"""Plain versions of the operators, for small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACE = " \t\n\x0b\x0c\r"


def words(text):
    return [w for w in re.split("[ \t\n\x0b\x0c\r]+", text or "") if w]


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text, k=4):
    ws = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words(text)]
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(nodes, links):
    """Smallest node that each node reaches."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def near_duplicates(rows, radius=4):
    """{doc_id: component} of (doc_id, text) rows, by all pairs of fingerprints."""
    prints = {i: fingerprint(t) for i, t in rows}
    ids = sorted(prints)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if (prints[a] ^ prints[b]).bit_count() <= radius
    ]
    return classes(ids, links)


def quality_counts(text):
    text, ws = text or "", words(text)
    windows = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    inside = {i + j for i in range(len(ws) - 2) if windows[tuple(ws[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    failed = len(ws) < 50 or 100 * len(inside) > 50 * len(ws)
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(inside), failed)


def class_counts(text):
    kinds = Counter()
    for c in text or "":
        if "a" <= c <= "z":
            kinds[0] += 1
        elif c in SPACE:
            kinds[1] += 1
        elif "A" <= c <= "Z":
            kinds[2] += 1
        elif "0" <= c <= "9":
            kinds[3] += 1
        elif c in "#*$%&|<>!":
            kinds[4] += 1
        elif "\x21" <= c <= "\x7e":
            kinds[5] += 1
        else:
            kinds[6] += 1
    return np.array([kinds[i] for i in range(7)], float)


def distance(p, q):
    m = (p + q) / 2
    part = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a > 0)
    return math.sqrt(max((part(p) + part(q)) / 2, 0))


def word_cells(text, cells):
    return [signed(xxhash.xxh64_intdigest(w.lower().encode(), 42)) % cells for w in words(text)]


def quality_kept(rows, rules):
    """{doc_id: kept} of (doc_id, text, lang) rows."""
    shares, commons = defaultdict(lambda: np.zeros(7)), defaultdict(Counter)
    used = [(lang or "", text or "") for _, text, lang in rows]
    if rules.distinct_texts:
        used = {(lang, text) for lang, text in used if not quality_counts(text)[-1]}
    for lang, text in used:
        if len(words(text)) >= rules.min_words:
            shares[lang or ""] += class_counts(text)
            commons[lang or ""].update(word_cells(text, rules.cells))
    out = {}
    for doc, text, lang in rows:
        counts, failed = class_counts(text), quality_counts(text)[-1]
        near, known = True, (lang or "") in shares
        if known and len(words(text)) >= rules.min_words and counts.sum() >= rules.min_chars:
            reference = shares[lang or ""] / shares[lang or ""].sum()
            all_cells, total = commons[lang or ""], sum(commons[lang or ""].values())
            common = [c for c in all_cells if all_cells[c] >= rules.common_share * total]
            own = Counter(word_cells(text, rules.cells))
            p = np.array([all_cells[c] / total for c in common])
            q = np.array([own[c] / len(words(text)) for c in common])
            p, q = np.append(p, 1 - p.sum()), np.append(q, max(0, 1 - q.sum()))
            near = (
                distance(reference, counts / counts.sum()) <= rules.max_char_distance
                and distance(p, q) <= rules.max_word_distance
            )
        out[doc] = not failed and near
    return out


def terms(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def leaks(rows, items, overlap=0.7):
    """(doc_id, item_id) whose item has a common subsequence of this share in some stretch of the
    document that is as long as the search looks at."""
    found = set()
    for doc, text in rows:
        ws = terms(text)
        for item, item_text in items:
            own = terms(item_text)
            if not own or len(set(own) & set(ws)) < overlap * len(set(own)) * 0.8:
                continue
            span = 32 + 2 * len(own)
            for start in range(0, max(1, len(ws) - len(own)), 8):
                part = ws[start : start + span]
                if subsequence(own, part) >= overlap * len(own):
                    found.add((doc, item))
                    break
    return found


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            held = row[j + 1]
            row[j + 1] = before + 1 if x == y else max(row[j + 1], row[j])
            before = held
    return row[-1]


def topic(text):
    size, digits = max(len(text), 1), sum(c in "0123456789" for c in text)
    if digits * 50 > size:
        return "numbers"
    if re.search("[#$%&*]{2}", text):
        return "markup"
    return "lists" if len(text.split("\n")) * 120 > size else "prose"


def mixing(rows, mixture):
    """{doc_id: (probability, kept)} of (doc_id, text, source, lang) rows."""
    keys = {d: (s or "", g or "", topic(t or "")) for d, t, s, g in rows}
    tokens = Counter()
    for d, t, _, _ in rows:
        tokens[keys[d]] += len(words(t))
    targets = []
    for axis, name in enumerate(("source", "lang", "topic")):
        sums = Counter()
        for key, n in tokens.items():
            sums[key[axis]] += n
        power = {v: n ** mixture.powers[name] if n else 0.0 for v, n in sums.items()}
        targets.append({v: p / sum(power.values()) for v, p in power.items()})
    weight = {k: float(n) for k, n in tokens.items()}
    for _ in range(mixture.rounds):
        for axis in range(3):
            sums = Counter()
            for key, w in weight.items():
                sums[key[axis]] += w
            weight = {k: w * targets[axis][k[axis]] / sums[k[axis]] if sums[k[axis]] else 0.0
                      for k, w in weight.items()}
    pull = {k: weight[k] / tokens[k] if tokens[k] else 0.0 for k in tokens}
    low, high, budget = 0.0, 1e12, mixture.budget * sum(tokens.values())
    for _ in range(200):
        middle = (low + high) / 2
        if sum(min(1, middle * pull[k]) * tokens[k] for k in tokens) < budget:
            low = middle
        else:
            high = middle
    out = {}
    for d, _, _, _ in rows:
        rate = min(1.0, high * pull[keys[d]])
        draw = int(hashlib.md5(f"{mixture.seed}:{d}".encode()).hexdigest()[:12], 16) / (1 << 48)
        out[d] = (rate, draw < rate)
    return out
