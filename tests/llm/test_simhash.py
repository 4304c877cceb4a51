"""SimHash groups against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from kgloom.llm import components, simhash


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(fps, max_bits=4):
    """Smallest member's number of each one's component."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(int(fps[i]) ^ int(fps[j])).count("1") <= max_bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def clustered(seed, n):
    """Distinct fingerprints in tight and loose clusters and alone."""
    draw = random.Random(seed)
    centres = [draw.getrandbits(64) for _ in range(6)]
    found = {draw.getrandbits(64) for _ in range(n // 3)}
    while len(found) < n:
        x = draw.choice(centres)
        for _ in range(draw.randint(0, 7)):
            x ^= 1 << draw.randrange(64 if draw.random() < 0.5 else 12)
        found.add(x)
    return np.array(sorted(found), np.uint64)


@pytest.mark.parametrize("limits", [(8, 512), (2, 4), (3, 20)])
def test_links_have_the_right_components(monkeypatch, limits):
    monkeypatch.setattr(simhash, "SMALL_CELL", limits[0])
    monkeypatch.setattr(simhash, "LARGE_CELL", limits[1])
    fps = clustered(limits[1], 400)
    place = {int(x): i for i, x in enumerate(fps)}
    edges = set()
    for i, mask in enumerate(simhash.block_masks()):
        cells = simhash.mixed((simhash.embedded(fps) & np.uint64(mask)) + np.uint64(i))
        for a, b in simhash.group_links(cells, fps):
            edges |= {(place[int(x)], place[int(y)]) for x, y in zip(a, b)}
    assert all(bin(int(fps[a]) ^ int(fps[b])).count("1") <= 4 for a, b in edges)
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(fps))] == roots(fps)


def test_embedding_bounds_the_distance():
    draw = random.Random(1)
    a, b = (np.array([draw.getrandbits(64) for _ in range(2000)], np.uint64) for _ in range(2))
    counts = lambda x: np.array([[bin(int(v) >> s & 3).count("1") for s in range(0, 64, 2)] for v in x])
    packed = np.array([[int(v) >> s & 3 for s in range(0, 64, 2)] for v in simhash.embedded(a)])
    assert (packed == counts(a)).all()
    assert (np.abs(counts(a) - counts(b)).sum(1) <= np.bitwise_count(a ^ b)).all()


def test_components_of_a_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(60)]
    hub = [(1000, i) for i in range(2000, 2300)] + [(5000, 5000), (7, 7), (3, 2)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(chain + hub, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 61)}, **{i: 1000 for i in range(2000, 2300)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_copies(prose):
    draw = random.Random(5)
    rows = []
    for g in range(12):
        base = prose(g, 300).split()
        for _ in range(draw.randint(1, 6)):
            words = list(base)
            for _ in range(draw.randint(0, 2)):
                words[draw.randrange(len(words))] = "changed"
            rows.append((len(rows) * 7 % 1000 + 10, " ".join(words), "en", "s", 1))
    return rows


def test_groups(spark, edge_docs, clashing_docs, no_docs, prose):
    rows = [tuple(r) for r in edge_docs.collect()] + near_copies(prose)
    docs = spark.createDataFrame(rows, edge_docs.schema)
    prints = [fingerprint(r[1]) for r in rows]
    root = roots(prints)
    low = {}
    for r, g in zip(rows, root):
        if r[0] is not None:
            low[g] = min(low.get(g, r[0]), r[0])
    want = Counter((r[0], p, low.get(g)) for r, p, g in zip(rows, prints, root))
    got = Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_groups(docs.repartition(3)).collect())
    assert got == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(low.get(g) for g in set(root))
    assert simhash.one_of_each(clashing_docs).columns == clashing_docs.columns
    assert simhash.one_of_each(clashing_docs).count() == len(set(roots([fingerprint(r.text) for r in edge_docs.collect()])))
    assert simhash.near_groups(no_docs).count() == 0
