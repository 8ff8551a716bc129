import numpy as np
import pytest
from pyspark.sql import functions as F

from jobloom.llm import simhash
from jobloom.llm.components import components


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in pairs:
        a, b = find(i), find(j)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def near(values, budget=2):
    v = np.array(values, np.uint64)
    return [(i, i + 1 + int(j)) for i in range(len(v))
            for j in np.flatnonzero(np.bitwise_count(v[i + 1:] ^ v[i]) <= budget)]


def clustered(seed, clusters, each, flips):
    rng = np.random.default_rng(seed)
    out = []
    for c in rng.integers(0, 2**64, clusters, dtype=np.uint64):
        for _ in range(each):
            x = int(c)
            for b in rng.integers(0, 64, rng.integers(0, flips + 1)):
                x ^= 1 << int(b)
            out.append(x)
    return sorted(set(out))


@pytest.mark.parametrize("seed,clusters,each,flips", [(1, 40, 5, 3), (2, 1, 200, 4), (3, 5, 60, 2)])
def test_walk_finds_every_pair_once(seed, clusters, each, flips):
    values = clustered(seed, clusters, each, flips)
    one = np.array([0]), np.array([len(values)]), np.array([len(values)])
    prints = np.array(values, np.uint64)
    # One root node for all: depth 1 on each half, and the pair of the two halves.
    half = int(np.searchsorted(prints, np.uint64(1 << 63)))
    lo, mid, hi = np.array([0, half, 0]), np.array([half, one[2][0], half]), np.array(
        [half, one[2][0], one[2][0]])
    i, j = simhash.walk(prints, lo, mid, hi, np.array([1, 1, 1]), 2)
    got = sorted((min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist()))
    assert got == near(values)


@pytest.mark.parametrize("cell", [4, 4096])
def test_links_give_the_brute_force_components(spark, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL_ROWS", cell)
    values = clustered(7, 30, 6, 3) + [0, 1, 3, 7, 15, 2**64 - 1]
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 2**63))
    # Many prints that share one block, as a hot bucket.
    values = sorted({*values, *(base ^ int(x) for x in rng.integers(0, 2**12, 300))})
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    df = spark.createDataFrame(signed, "fp long")
    links = simhash.near_links(df).collect()
    at = {s[0]: i for i, s in enumerate(signed)}
    got = roots(len(values), [(at[r.u], at[r.v]) for r in links])
    assert got == roots(len(values), near(values))


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.root for r in components(
        spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    want = {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def plain_fingerprint(text):
    import re

    import xxhash

    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


TEXTS = ["", None, " \n\t", "One", "one two", "ONE TWO", "a b c", "a b c d", "É é x y　z",
         "the same line " * 400, "x " * 5000 + "y", "one two"]


def test_groups_of_odd_rows(spark):
    rows = [(i, t, "clash", 1.5) for i, t in enumerate(TEXTS)] + [(5, "ONE TWO", "again", 0.0),
                                                                 (None, "solo text here", "n", 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, fp double")
    got = simhash.simhash_groups(df).collect()
    assert len(got) == len(rows)
    prints = {i: f"{plain_fingerprint(t):016x}" for i, t, *_ in rows}
    assert all(r.fingerprint == prints[r.doc_id] for r in got)
    group = {r.doc_id: r.component_id for r in got}
    assert group[0] == group[1] == group[2] == 0 and group[5] == group[11] == group[4] == 4
    assert group[None] is None
    kept = simhash.drop_near_copies(df)
    assert kept.columns == df.columns
    near = kept.filter(F.col("doc_id").isin(0, 1, 2, 4, 5, 11))
    assert sorted(r.doc_id for r in near.collect()) == [0, 4]
    empty = simhash.simhash_groups(df.limit(0))
    assert empty.count() == 0 and empty.columns[:3] == ["doc_id", "fingerprint", "component_id"]
