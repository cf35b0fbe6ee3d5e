import math
import random
import zlib

import numpy as np
import pytest

from cartlake.llm import quality, registry

SF = "/root/testdata/sf0.001"


def words(rng, n):
    return " ".join("".join(rng.choice(["ta", "re", "on", "li", "sta"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus(rng, n):
    """Sentences are good; shouted, ruled or repeated texts are not."""
    for i in range(n):
        text = ". ".join(words(rng, 12) for _ in range(rng.randint(2, 9))) + "."
        bad = i % 4 == 0
        if bad:
            text = [text.upper() + "!!", text.replace(" ", " | "), (text[:40] + "\n") * 9][i // 4 % 3]
        yield i, text, int(not bad)


@pytest.fixture(scope="module")
def labelled(spark):
    rows = list(corpus(random.Random(4), 800))
    docs = spark.createDataFrame([(i, t, "x", 0.5, [1.0]) for i, t, _ in rows], "doc_id long, text string, row string, score double, x array<double>")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows], "doc_id long, quality int, toxic int")
    return docs.repartition(4), labels, {i: y for i, _, y in rows}


def test_held_out_accuracy(labelled):
    docs, labels, want = labelled
    out = quality.digest(docs, labels).collect()
    assert len(out) == len(want)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    held = [r for r in out if r["held_out"]]
    assert sum(r["predicted"] == want[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_held_out_labels_teach_nothing(labelled):
    docs, labels, _ = labelled
    turned = labels.withColumn("quality", quality.F.when(quality.held_out(quality.F.col("doc_id")), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality")))
    a, b = ({r["doc_id"]: r["score"] for r in quality.digest(docs, x).collect()} for x in (labels, turned))
    assert a.keys() == b.keys() and all(math.isclose(a[k], b[k], rel_tol=1e-6, abs_tol=1e-9) for k in a)


def test_sums_and_margin_by_hand(labelled):
    """Spark's sums equal numpy's, and margins those of densities with inverted matrices."""
    docs, labels, _ = labelled
    rows = quality.stage(quality.learned_from(quality.measured(docs), labels), "rows")
    got, held = quality.sums(rows), rows.toPandas()
    for (fold, label), (n, total, products) in got.items():
        x = np.array(held[(held.fold == fold) & (held.label == label)].x.tolist())
        assert n == len(x)
        assert np.allclose(total, x.sum(axis=0)) and np.allclose(products, x.T @ x)
    by_label = {y: quality.add([v for (_, z), v in got.items() if z == y]) for y in (0, 1)}
    model = quality.discriminant(by_label, 0.3, 0.05)
    cov, means, n = [], [], []
    for y in (0, 1):
        x = np.array(held[held.label == y].x.tolist())
        means.append(x.mean(axis=0))
        cov.append(np.cov(x.T, bias=True))
        n.append(len(x))
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / sum(n)
    x, density = np.array(held.x.tolist())[:50], []
    for y in (0, 1):
        c = 0.7 * cov[y] + 0.3 * pooled
        c = 0.95 * c + 0.05 * np.diag(np.diag(c)) + np.diag(1e-4 + 1e-3 * np.diag(pooled))
        d = x - means[y]
        density.append(math.log(n[y] / sum(n)) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d))
    assert np.allclose(model.margin(x), (density[1] - density[0]) / math.sqrt(x.shape[1]), rtol=1e-6, atol=1e-6)


def test_odd_rows(labelled, docs, odd, empty, rows):
    _, labels, _ = labelled
    assert quality.digest(empty, labels).count() == 0
    assert len(quality.digest(docs, labels).collect()) == len(rows)
    out = quality.digest(odd, labels.limit(0)).collect()
    assert sorted((r["score"], r["predicted"]) for r in out) == [(0.5, 1)] * 5
    assert all(r["held_out"] is False for r in out if r["doc_id"] is None)


def test_few_labels_give_their_share(spark, labelled):
    docs, _, _ = labelled
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 3 != 1][:4]
    labels = spark.createDataFrame([(i, int(k > 0)) for k, i in enumerate(ids)] + [(ids[0], None), (None, 1), (ids[1], 7)], "doc_id long, quality int")
    assert {r["score"] for r in quality.digest(docs, labels).collect()} == {0.75}


def test_query_reads_whole_table(spark):
    out = registry.queries()["op12_quality_classifier"](spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = out[out.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.9
