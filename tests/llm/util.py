"""Awkward rows every operator must take, and brute-force twins of the operators."""

import random
import zlib
from collections import defaultdict

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k_id string, score string, label string, spans string, kept string"


def docs_frame(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "s", None, "x", "y", "z", "w", "v") for i, t in rows], DOC_SCHEMA)


def odd_rows():
    """Null id, null, empty and blank text, repeated rows, very long text, no letters, odd bytes."""
    rnd = random.Random(3)
    long = " ".join(rnd.choice(["the", "of", "thé", "in"]) + str(rnd.randint(0, 9999)) for _ in range(20000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, long), (5, "a"), (5, "a"), (None, "one two three four five six"),
        (6, "one two three four five six"), (7, "x" * 5000), (8, "12 34 -- !!"), (9, "\x00\x01 é 漢字 <|endoftext|> ok"), (None, None),
    ]


def similar_docs(n=60, seed=5):
    """Groups of copies and near copies among unrelated texts, all sharing a passage."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice(["th", "er", "on", "an", "re", "in"]) for _ in range(rnd.randint(1, 4)))
    shared = [word() for _ in range(60)]
    base = [[word() for _ in range(rnd.randint(3, 200))] for _ in range(12)]
    out = []
    for i in range(n):
        words = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2, 5])):
            words[rnd.randrange(len(words))] = word()
        if rnd.random() < 0.3:
            words += shared
        out.append((i, " ".join(words)))
    return out


def remainder(doc_id, mod):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % mod


def brute_components(rows, words=5, similarity=75):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= similarity * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)].append(i)
    out = []
    for k, (i, _) in enumerate(rows):
        c = min(least[root(k)], default=None) if sets[k] else i
        out.append((i, len(sets[k]), c, i == c))
    return sorted(out, key=repr)


def brute_repeats(rows, size, keep):
    raws = [(t or "").encode() for _, t in rows]
    places = defaultdict(list)
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0)):
        for s in range(len(raws[k]) - size + 1):
            places[raws[k][s:s + size]].append((k, s))
    gone = [bytearray(len(r)) for r in raws]
    for found in places.values():
        if len(found) > 1:
            for k, s in found if keep == "none" else found[1:]:
                gone[k][s:s + size] = b"\1" * size
    out = []
    for (i, _), raw, m in zip(rows, raws, gone):
        spans = sum(1 for j in range(len(m)) if m[j] and (not j or not m[j - 1]))
        out.append((i, len(raw), sum(m), spans, bytes(b for b, x in zip(raw, m) if not x)))
    return sorted(out, key=repr)
