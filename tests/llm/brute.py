"""Plain Python versions of what the operators must return."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").translate(ASCII_LOWER)


def shingles(text, k=5):
    w = WORD.findall(lower(text))
    if len(w) >= k:
        return set(zip(*[w[i:] for i in range(k)]))
    return {tuple(w)} if w else set()


def groups(texts, percent):
    """doc → (set size, least reachable doc)."""
    sets = {d: shingles(t) for d, t in texts.items()}
    holders, shared = defaultdict(list), Counter()
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    for docs in holders.values():
        for i, a in enumerate(docs):
            shared.update((min(a, b), max(a, b)) for b in docs[i + 1 :])
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            up[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def without_repeats(texts, length=100):
    """doc → (bytes, removed, spans, sha256 of the rest)."""
    seen, found = set(), {}
    for d in sorted(texts):
        data = (texts[d] or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        found[d] = (len(data), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return found


def without_shared_words(texts, k=13):
    least, found = {}, {}
    split = {d: WORD.findall(t or "") for d, t in sorted(texts.items())}
    for d, w in split.items():
        for i in range(len(w) - k + 1):
            least.setdefault(tuple(w[i : i + k]), d)
    for d, w in split.items():
        gone = bytearray(len(w))
        for i in range(len(w) - k + 1):
            if least[tuple(w[i : i + k])] < d:
                gone[i : i + k] = b"\1" * k
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        found[d] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return found


def leaks(texts, items, length=10):
    windows = defaultdict(set)
    for item, text in items:
        w = ITEM_WORD.findall(lower(text))
        n = min(length, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i : i + n])].add(str(item))
    found = {}
    for d, text in texts.items():
        w = ITEM_WORD.findall(lower(text))
        hit, names = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if met := windows.get(tuple(w[i : i + n])):
                    names |= met
                    hit.update(range(i, i + n))
        found[d] = (len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit))
    return found


def phrases(rows, least=30, longest=4, top=2000):
    """Rows of (lang, rank, phrase, a, l, r, n, score) for (lang, text) rows."""
    counts, words, found = defaultdict(Counter), Counter(), set()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {
            p[i : i + k] for p, a in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= 80 * candidates[p[i : i + k]]
        }
        order = []
        for p, a in candidates.items():
            if p not in inside:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                order.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(order)[:top], 1):
            found.add((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return found


def features(text):
    w = [x.encode() for x in ITEM_WORD.findall(lower(text))]
    return len(w), [b" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def resampled(texts, items, buckets=10_000):
    """doc → (n_features, weight, score, rank or None)."""
    docs = {d: features(t) for d, t in texts.items()}
    s = Counter(zlib.crc32(f) % buckets for _, fs in docs.values() for f in fs)
    t = Counter(zlib.crc32(f) % buckets for item in items for f in features(item)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (n_s + 10000.0) / ((s[b] + 1.0) * (n_t + 10000.0)))) for b in range(buckets)]
    found = {}
    for d, (n, fs) in docs.items():
        weight = sum(gain[zlib.crc32(f) % buckets] for f in fs)
        h = int(hashlib.sha256(f"42:{d}".encode()).hexdigest()[:8], 16)
        found[d] = (n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
    order = sorted((d for d in found if found[d][0] >= 20), key=lambda d: (-found[d][3], d))
    rank = {d: at for at, d in enumerate(order[: 5 * len(order) // 100], 1)}
    return {d: (*row[1:], rank.get(d)) for d, row in found.items()}


def languages(learned, texts, orders=(4, 3, 2, 1), a=0.5, sharpness=0.25):
    """doc → (language, score): what is learned from (lang, text) rows decides on ``texts``."""

    def split(text):
        return "".join(c if c.isalpha() else " " for c in (text or "").lower()).split(" ")

    counts = {order: defaultdict(Counter) for order in (0, *orders)}
    for lang, text in learned:
        for word in filter(None, split(text)):
            counts[0][lang][word] += 1
            for order in orders:
                counts[order][lang].update(word[i : i + order] for i in range(len(word) - order + 1))
    langs = sorted({lang for c in counts.values() for lang in c})
    kinds = {order: set().union(*c.values()) for order, c in counts.items()}
    logs = {
        (order, lang): (lambda key, c=counts[order][lang], total=counts[order][lang].total() + a * (len(kinds[order]) + 1): math.log((c[key] + a) / total))
        for order in counts
        for lang in langs
    }
    found = {}
    for d, text in texts.items():
        words = list(filter(None, split(text)))
        score = dict.fromkeys(langs, 0.0)
        for word in words:
            for order in (0, *orders):
                keys = [word] if not order else [word[i : i + order] for i in range(len(word) - order + 1)]
                keys = [k for k in keys if k in kinds[order]]
                if keys:
                    for lang in langs:
                        score[lang] += sum(map(logs[order, lang], keys)) / len(keys)
                    break
        if not words or not langs:
            found[d] = ("und", 0.0)
            continue
        best = max(langs, key=lambda lang: (score[lang], [-ord(c) for c in lang]))
        found[d] = (best, 1 / sum(math.exp(sharpness * (score[lang] - score[best])) for lang in langs))
    return found
