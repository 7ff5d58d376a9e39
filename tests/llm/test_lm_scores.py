import math
import random
from collections import Counter

import pytest

from routelytics.llm import lm_scores as q

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows, target, p):
    """The two models written down with dictionaries."""
    texts = [(i, " ".join((t or "").lower().split()).replace("\0", "�")) for i, t in rows]
    k = p.order
    counts = {"t": Counter(), "b": Counter()}
    for i, t in texts:
        s = "\x01" * (k - 1) + t
        for j in range(len(t)):
            counts["b"][s[j:j + k]] += 1
            if i is not None and i in target:
                counts["t"][s[j:j + k]] += 1
    nb, nt = sum(counts["b"].values()), sum(counts["t"].values())
    chars = len({g[-1] for g in counts["b"]})
    if not nt:
        counts["t"], nt = counts["b"], nb
    scale = {"t": 1.0, "b": nt / max(nb, 1)}
    loss = {}
    for x in "tb":
        sub = {m: Counter() for m in range(1, k + 1)}
        ctx = {m: Counter() for m in range(1, k + 1)}
        for g, n in counts[x].items():
            for m in range(1, k + 1):
                sub[m][g[k - m:]] += n * scale[x]
                ctx[m][g[k - m:-1]] += n * scale[x]

        def prob(g, x=x, sub=sub, ctx=ctx):
            pr = None
            for m in range(k % 2 or 2, k + 1, 2):
                w, c = sub[m][g[k - m:]], ctx[m][g[k - m:-1]]
                if m == 1:
                    pr = (w + p.floor) / (nt + p.floor * chars)
                else:
                    pr = (w + p.smoothing * (1 / chars if pr is None else pr)) / (c + p.smoothing)
            return pr
        loss[x] = {g: -math.log(prob(g)) for g in counts["b"]}
    out = []
    for i, t in texts:
        s = "\x01" * (k - 1) + t
        grams = [s[j:j + k] for j in range(len(t))]
        n = len(grams)
        lt, lb = (sum(loss[x][g] for g in grams) / n if n else None for x in "tb")
        out.append((i, n, lt, lb, lb - lt if n else 0.0))
    return out


def table(spark, rows, target):
    d = spark.createDataFrame([(i, t, "en", "s", 1, 5) for i, t in rows], SCHEMA + ", score int")
    return d, spark.createDataFrame([(i,) for i in target], "doc_id long")


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:2] == w[:2]
        assert all((a is None and b is None) or abs(a - b) < 1e-9 for a, b in zip(g[2:], w[2:]))


def texts(seed):
    rng = random.Random(seed)
    good = ["the", "cat", "sat", "on", "a", "mat", "Über", "日本", "😀x"]
    bad = ["$$$", "|||", "QQQ!!", "zz", "x\0y"]
    rows = [(i, "  ".join(rng.choice(good if i % 3 else bad) for _ in range(rng.randrange(1, 40)))) for i in range(60)]
    return rows + [(None, "no id here"), (61, None), (62, ""), (63, " \n"), (5, rows[5][1]), (64, "the cat " * 5000)]


@pytest.mark.parametrize("order, block", [(5, 3 << 20), (4, 200), (3, 50_000), (5, 400)])
def test_scores_match_dictionaries(spark, order, block):
    p = q.LmParams(order=order, block_chars=block)
    rows, target = texts(order), [i for i in range(60) if i % 3] + [1, 2, 999]
    got = q.score(*table(spark, rows, [*target, None]), p).collect()
    same(got, brute(rows, set(target), p))
    by = {r.doc_id: r.score for r in got}
    assert min(by[i] for i in range(60) if i % 3) > max(by[i] for i in range(60) if i % 3 == 0)


def test_without_target_and_without_documents(spark):
    rows = texts(7)
    got = q.score(*table(spark, rows, [])).collect()
    same(got, brute(rows, set(), q.LmParams()))
    assert all(r.score == 0 for r in got)
    assert q.score(*table(spark, [], [1, 2])).collect() == []


def test_many_different_characters_stay_exact():
    text = "".join(chr(c) for c in range(0x4E00, 0x9FA5)) * 2
    grams, index, size = q.ngrams([text, "", text[:7]], 5)
    assert size.tolist() == [len(text), 0, 7] and len(set(grams)) == len(grams)
    padded = "\x01" * 4 + text
    assert [grams[i] for i in index[:300]] == [padded[j:j + 5] for j in range(300)]
