import random

import numpy as np
import pytest
import xxhash

from cdrflow.llm import simhash as S


def brute_fingerprint(text, words=4):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + words]), 42) for i in range(max(1, len(w) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, tau):
    fps, root = sorted(set(fps)), {}
    for f in fps:
        root[f] = f

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= tau:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def planted(n, rnd):
    """Random fingerprints, chains of close ones, and a dense cloud around one."""
    out = [rnd.getrandbits(64) for _ in range(n)]
    for f in out[:40]:
        for _ in range(4):
            f ^= sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 5)))
            out.append(f)
    return out + [out[-1] ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 3))) for _ in range(300)] + [0, 1, 2**64 - 1]


@pytest.mark.parametrize("text", [None, "", "One", "A b C", "a b c d", "a b c d e é É", "x " * 5000, "\u00a0 \x1c q"])
def test_fingerprint(text):
    assert int(S.fingerprint(S.shingle_hashes(text, 4))) == brute_fingerprint(text)


@pytest.mark.parametrize("thresholds", [None, [0, 0, 0, 0, 0], [1, 1, 0], [2, 1], [-1, 2, 1], [1, 0, 0, 0], [-1, -1, 4]])
def test_components_whatever_the_plan(spark, monkeypatch, thresholds):
    monkeypatch.setattr(S, "BLOCK", 64)
    values = planted(300 if thresholds and max(thresholds) == 4 else 800, random.Random(7))
    if thresholds and max(thresholds) == 4:
        values = values[:200] + values[-120:]
    signed = sorted({int(np.uint64(v).view(np.int64)) for v in values})
    fps = S.materialize(spark.createDataFrame([(v,) for v in signed], "fp long").repartition(4), "t")
    if thresholds is None:
        plan = S.plan_search(fps, 4)
    else:
        n, together = S.bit_counts(fps)
        plan = [S.Partition(g, t) for g, t in zip(S.group_bits(n, together, len(thresholds)), thresholds)]
    assert sorted(b for p in plan for b in p.bits) == list(range(64))
    assert sum(p.threshold + 1 for p in plan) == 5
    got = {r.node: r.root for r in S.components(S.find_links(fps, plan, 4)).collect()}
    expected = brute_components([v & (2**64 - 1) for v in signed], 4)
    groups = {}
    for v in signed:
        groups.setdefault(expected[v & (2**64 - 1)], []).append(v)
    for members in groups.values():
        assert {got.get(v, v) for v in members} == {min(members)}


def test_dynamic_programming_is_optimal():
    import itertools

    rnd = np.random.default_rng(1)
    sizes = [12, 13, 20, 19]
    shares = [np.sort(rnd.dirichlet(np.ones(n + 1))) for n in sizes]
    cost, chosen = S.allocate(10_000, sizes, shares, 5)
    single = [[S.allocate(10_000, [n], [s], u)[0] for u in range(6)] for n, s in zip(sizes, shares)]
    best = min(sum(single[i][u] for i, u in enumerate(us)) for us in itertools.product(range(6), repeat=4) if sum(us) == 5)
    assert sum(t + 1 for t in chosen) == 5 and cost == pytest.approx(best)


def test_documents(spark):
    rnd = random.Random(8)
    base = [" ".join(rnd.choice("abcdefgh") + str(rnd.randint(0, 50)) for _ in range(400)) for _ in range(12)]
    texts = base + [b.upper() for b in base[:4]] + [b + " tail" for b in base[:6]] + [None, "", "  ", "one", "one two"]
    rows = [(100 - i, t) for i, t in enumerate(texts)] + [(None, base[0]), (100, base[0]), (100, base[0])]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, fp int, kept int").repartition(3)
    out = S.near_duplicates(df, words=4, tau=4).collect()
    assert len(out) == len(rows)
    prints = {}
    for i, t in rows:
        prints.setdefault(brute_fingerprint(t), []).append(i)
    root = brute_components(prints, 4)
    ids = {}
    for f, found in prints.items():
        ids.setdefault(root[f], []).extend(i for i in found if i is not None)
    for r in out:
        assert r.component_id == min(ids[root[r.fp & (2**64 - 1)]])
    assert sorted(r.doc_id for r in out if r.kept) == sorted(min(v) for v in ids.values())
    left = S.drop_near_duplicates(df, words=4, tau=4)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == sorted(min(v) for v in ids.values())
    assert S.near_duplicates(df.limit(0)).count() == 0
