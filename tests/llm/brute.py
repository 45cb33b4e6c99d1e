"""Plain versions of the corpus operators, and texts that are awkward for all of them."""

import hashlib
import random
import re
from collections import Counter

LOWER = {i: i + 32 for i in range(65, 91)}
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def corpus(seed=0, n=60, words=40, vocabulary=30):
    """Rows (doc_id, text): random texts, copies, near copies, shared passages, null, empty, one very long and one repeated row."""
    rng = random.Random(seed)
    vocab = [f"w{i}" if i % 7 else f"Ünï{i}" for i in range(vocabulary)]
    text = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    passage = text(25)
    rows = []
    for i in range(n):
        kind = i % 6
        if kind == 0:
            t = text(rng.randrange(1, words * 2))
        elif kind == 1:
            t = f"{text(8)}\n{passage} {text(5)}\nCommon  line. \n{text(3)}"
        elif kind == 2 and rows:
            t = rows[rng.randrange(len(rows))][1]
        elif kind == 3 and rows:
            w = (rows[rng.randrange(len(rows))][1] or "").split(" ")
            w[rng.randrange(len(w))] = "edit"
            t = " ".join(w)
        elif kind == 4:
            t = f"\tCOMMON  LINE.\n{text(words)}\n\n{text(2)}"
        else:
            t = "ab " * rng.randrange(1, 60)
        rows.append((i, t))
    rows += [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, text(6000)), (n + 4, "a" * 3000), (None, text(30)), (None, None)]
    rows.append(rows[3])
    return rows


def frame(spark, rows):
    """The rows as documents, with further columns whose names the operators use themselves."""
    full = [(d, t, "en" if t and len(t) % 2 else None, "s1", None if t is None else len(t), 1, "x", 2.0, 3, "y") for d, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, start int, places string, n double, label long, keep string")


def covered(seqs, window):
    """For each sequence which items windows cover that start more than once."""
    counts = Counter(tuple(s[i : i + window]) for s in seqs for i in range(len(s) - window + 1))
    out = []
    for s in seqs:
        hit = [False] * len(s)
        for i in range(len(s) - window + 1):
            if counts[tuple(s[i : i + window])] > 1:
                hit[i : i + window] = [True] * window
        out.append(hit)
    return out


def passages(rows, window):
    words = [SPACED.findall(t or "") for _, t in rows]
    return [(d, len(w), sum(h), sha(" ".join(x for x, g in zip(w, h) if not g).encode())) for (d, _), w, h in zip(rows, words, covered(words, window))]


def repeats(rows, window):
    data = [(t or "").encode() for _, t in rows]
    return [(d, len(b), sum(h), sum(g and (i == 0 or not h[i - 1]) for i, g in enumerate(h)), sha(bytes(x for x, g in zip(b, h) if not g))) for (d, _), b, h in zip(rows, data, covered(data, window))]


def lines(rows, min_docs):
    key = lambda line: line.strip("\t\n\x0b\x0c\r ").translate(LOWER)
    counts = Counter(k for t in {(d, t) for d, t in rows} for k in {key(x) for x in (t[1] or "").split("\n")})
    out = []
    for d, t in rows:
        every = (t or "").split("\n")
        stay = [x for x in every if not key(x) or counts[key(x)] < min_docs]
        out.append((d, len(every), len(every) - len(stay), sha("\n".join(stay).encode())))
    return out


def shingle_set(text, size):
    w = SPACED.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def jaccard(rows, size, percent):
    sets = [shingle_set(t, size) for _, t in rows]
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]) and find(i) != find(j):
                comp[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def contamination(rows, items, size):
    phrases = {}
    for k, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        for i in range(max(1, len(w) - size + 1) if w else 0):
            phrases.setdefault(tuple(w[i : i + size]), set()).add(str(k))
    out = []
    for d, t in rows:
        w = ALNUM.findall((t or "").translate(LOWER))
        hit, found = [False] * len(w), set()
        for n in {len(p) for p in phrases}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in phrases:
                    hit[i : i + n] = [True] * n
                    found |= phrases[tuple(w[i : i + n])]
        out.append((d, len(w), sum(hit), len(found), sha(",".join(sorted(found)).encode()), any(hit)))
    return out


def sha(data):
    return hashlib.sha256(data).hexdigest()


def byte_repeats(rows, window, base=0x5851F42D4C957F2D):
    """``repeats`` for whole tables: every window's 64-bit polynomial hash in one sorted array; independent of the operators' own hashes."""
    import numpy as np

    data = [np.frombuffer((t or "").encode(), np.uint8) for _, t in rows]
    longest = max((len(b) for b in data), default=0)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(longest + 1, base, np.uint64))
        lift = np.uint64(pow(base, window, 1 << 64))

        def hashes(b):
            if len(b) < window:
                return np.zeros(0, np.uint64)
            # Horner's rule by prefix sums of byte times base^-i is undone by a multiplication with base^i.
            down = np.uint64(pow(base, -1, 1 << 64))
            inverse = np.cumprod(np.full(len(b), down, np.uint64))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * inverse)])
            return (sums[window:] - sums[:-window]) * up[: len(b) - window + 1] * lift

        every = [hashes(b) for b in data]
        flat = np.concatenate(every) if every else np.zeros(0, np.uint64)
        order = np.sort(flat)
        often = np.unique(order[1:][order[1:] == order[:-1]])
    out = []
    for (d, _), b, h in zip(rows, data, every):
        change = np.zeros(len(b) + 1, np.int64)
        if len(h) and len(often):
            at = np.minimum(np.searchsorted(often, h), len(often) - 1)
            hit = np.flatnonzero(often[at] == h)
            np.add.at(change, hit, 1)
            np.add.at(change, hit + window, -1)
        gone = np.cumsum(change[:-1]) > 0
        spans = int(np.count_nonzero(gone & ~np.concatenate([[False], gone[:-1]]))) if len(gone) else 0
        out.append((d, len(b), int(gone.sum()), spans, sha(b[~gone].tobytes())))
    return out
