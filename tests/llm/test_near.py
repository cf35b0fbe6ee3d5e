import random

import numpy as np
import xxhash

from cartlake.llm import simhash
from cartlake.llm.components import components


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """Least id of each component of {id: fingerprint}, all pairs compared."""
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 3 and label[a] > label[b]:
                    label[a], changed = label[b], True
    return label


def test_as_brute_force(docs, rows):
    prints = {r[0]: fingerprint(r[1]) for r in rows}
    label = groups(prints)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.digest(docs).collect()}
    assert got == {i: (format(prints[i], "016x"), label[i]) for i in prints}
    assert len(set(label.values())) < len(rows) - 5


def test_tree_finds_every_link(spark):
    rng = random.Random(2)
    points = [rng.getrandbits(64) for _ in range(600)]
    for p in list(points[:150]):
        for _ in range(3):
            q = p
            for _ in range(rng.randint(1, 4)):
                q ^= 1 << rng.randrange(64)
            points.append(q)
    points = sorted({p - (1 << 64) if p >> 63 else p for p in points})
    label = groups({p: p & ((1 << 64) - 1) for p in points})
    table = spark.createDataFrame([(p,) for p in points], "fp long")
    found = simhash.links(table, shard_points=40)
    root = {r["a"]: r["b"] for r in components(found).collect()}
    together = {}
    for p in points:
        together.setdefault(label[p], set()).add(root.get(p, p))
    assert all(len(s) == 1 for s in together.values())
    assert len({root.get(p, p) for p in points}) == len(together)


def test_components_of_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 140)] + [(120, 120), (101, 100)]
    got = {r["a"]: r["b"] for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 140)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_many_links_in_a_leaf():
    rng = np.random.default_rng(3)
    near = np.unique(np.uint64(1) << rng.integers(0, 20, 200, dtype=np.uint64))
    points = np.concatenate([near, rng.integers(1 << 40, 1 << 62, 100, dtype=np.uint64)])
    every = np.arange(len(points))
    label = simhash.near_links(points, every, every, 3)
    assert (label[: len(near)] == 0).all() and len(set(label)) == 101


def test_odd_rows_and_no_rows(odd, empty):
    got = simhash.digest(odd).collect()
    assert len(got) == 5
    assert {r["component_id"] for r in got if r["doc_id"] == 4} == {4}
    assert [r["component_id"] for r in got if r["doc_id"] is None and r["fingerprint"] != "0" * 16] == [None]
    assert simhash.digest(empty).collect() == []
