import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from routelytics.llm import importance as q

SCHEMA = "doc_id long, text string, weight string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def features(text):
    w = words(text)
    return [zlib.crc32(f.encode()) % 10_000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def brute(docs, bench):
    s, t = [0] * 10_000, [0] * 10_000
    for rows, count in ((docs, s), (bench, t)):
        for _, text in rows:
            for f in features(text):
                count[f] += 1
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in range(10_000)]
    out, may = [], []
    for i, text in docs:
        f = features(text)
        w = math.floor(sum(gain[b] for b in f) / len(f)) if f else 0
        if i is None:
            out.append((i, len(f), w, None, None))
            continue
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        score = w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(f), w, score, None))
        if len(words(text)) >= 20:
            may.append((-score, i, len(f), len(out) - 1))
    for rank, (*_, at) in enumerate(sorted(may)[:25 * len(may) // 100]):
        out[at] = out[at][:4] + (rank + 1,)
    return sorted(out, key=repr)


def corpus(seed, n=200):
    rng = random.Random(seed)
    pool = ["Apple", "pear", "x1", "É", "ééé", "𝒳y", "The", "of", "naïve", "7", "Zoo"] + [f"w{i}" for i in range(300)]
    gaps = [" ", "  ", ", ", "\n", "-", "\x7f", "_", "\x00", ". "]
    make = lambda: "".join(rng.choice(pool) + rng.choice(gaps) for _ in range(rng.randrange(60)))
    docs = [(i, make()) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, " ,. "), (n + 3, "one"), (n + 4, "a" * 5000 + " " + "b" * 70_000 + " c"), (None, make())]
    return docs + [docs[4], docs[4], (5, make())], [(i, make()) for i in range(20)] + [(99, None)]


def run(spark, docs, bench):
    got = q.digest(spark.createDataFrame([(i, t, "x") for i, t in docs], SCHEMA),
                   spark.createDataFrame([(i, t, "x") for i, t in bench], SCHEMA))
    return sorted([tuple(r)[:5] for r in got.collect()], key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    docs, bench = corpus(seed)
    assert run(spark, docs, bench) == brute(docs, bench)


def test_empty_tables(spark):
    docs, bench = corpus(3, 40)
    assert run(spark, [], bench) == []
    assert run(spark, docs, []) == brute(docs, [])


def test_composed_checksums():
    rng = np.random.default_rng(1)
    shift = q.CrcShift()
    pairs = [(rng.bytes(int(rng.integers(1, 90))), rng.bytes(int(rng.integers(1, 200)))) for _ in range(300)] + [(b"a", b"z" * 100_000)]
    a = np.array([zlib.crc32(x) for x, _ in pairs], np.uint32)
    b = np.array([zlib.crc32(y) for _, y in pairs], np.uint32)
    got = shift(a, np.array([len(y) for _, y in pairs])) ^ b
    assert got.tolist() == [zlib.crc32(x + y) for x, y in pairs]


def test_dictionary_finds_every_word_whatever_it_holds():
    """Empty, partly known, and begun anew: payloads are those of all words in order."""
    docs, _ = corpus(4)
    texts = [t or "" for _, t in docs]
    for most in (200_000, 50):
        d = q.WordDictionary(most)
        for lo in range(0, len(texts), 17):
            block = texts[lo:lo + 17]
            crc, length, n = d.payloads(block)
            want = [words(t) for t in block]
            assert n.tolist() == [len(w) for w in want]
            flat = [w.encode() for ws in want for w in ws]
            assert crc.tolist() == [zlib.crc32(w) for w in flat] and length.tolist() == [len(w) for w in flat]
    d = q.WordDictionary(200_000)
    many = [" ".join(f"w{i}" for i in range(1000))]
    d.payloads(many)
    assert len(d.automaton) == 1000 and not d.late
    assert d.payloads(many)[2].tolist() == [1000] and d.size == 1000
