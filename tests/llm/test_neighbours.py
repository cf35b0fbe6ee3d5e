import numpy as np

from cartlake.llm import hnsw

SCHEMA = "vec_id long, embedding array<float>, label int, key long, score double"


def vectors():
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(12, 16))
    v = middle[rng.integers(0, 12, 900)] + 0.6 * rng.normal(size=(900, 16))
    v[200:340] = v[200]  # one very common vector
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v.astype(np.float32))]
    rows += [(1000, None), (1050, [0.0] * 16), (1100, [1.0, None] + [0.0] * 14), (1150, [float("nan")] + [1.0] * 15), (1200, [float("inf")] + [1.0] * 15), (1250, [])]
    rows += [(1300, [2.0, 1.0]), (1301, [1.0, 2.0]), (None, [1.0] * 16)]
    return rows


def test_recall_and_exact_scores(spark):
    rows = vectors()
    table = spark.createDataFrame([(*r, 1, 2, 0.5) for r in rows + rows[:3]], SCHEMA).repartition(3)
    usable = hnsw.usable(table)
    found = hnsw.search(usable, usable.filter("vec_id % 50 = 0").select(usable.vec_id.alias("query_id"), "v").distinct(), shard_rows=200)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    good = {i: np.array(v, np.float64) for i, v in rows if i is not None and i < 1000}
    hits = total = 0
    for q in [i for i in good if i % 50 == 0]:
        exact = sorted(((float(good[q] @ v / np.sqrt((good[q] @ good[q]) * (v @ v))), i) for i, v in good.items() if i != q), key=lambda s: (-round(s[0], 12), s[1]))[:5]
        assert [r for r, _, _ in got[q]] == [1, 2, 3, 4, 5]
        for _, i, score in got[q]:
            assert i != q and abs(score - float(good[q] @ good[i] / np.sqrt((good[q] @ good[q]) * (good[i] @ good[i])))) < 1e-12
        hits += len({i for _, i, _ in got[q]} & {i for _, i in exact})
        total += 5
    assert hits / total >= 0.9
    assert [i for _, i, _ in got[200]] == [201, 202, 203, 204, 205]
    assert [i for _, i, _ in got[1300]] == [1301]
    assert not set(got) & {1000, 1050, 1100, 1150, 1200, 1250}


def test_no_rows(spark):
    assert hnsw.digest(spark.createDataFrame([], SCHEMA)).collect() == []
    assert hnsw.digest(spark.createDataFrame([(50, [1.0], 1, 1, 1.0)], SCHEMA)).collect() == []
