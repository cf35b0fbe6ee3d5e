import random

import numpy as np
import pytest

from cartlake.llm import mixing
from cartlake.llm import blocks as B

LABELS = "doc_id long, quality int, toxic int"


def table(spark):
    rng = random.Random(7)
    stock = {0: ["%%%", "###", "$$"], 1: ["the", "of", "and", "tion"], 2: ["grob", "vile", "foul"]}
    docs, labels = [], []
    for i in range(900):
        domain = 0 if i % 4 == 0 else 2 if i % 10 == 1 else 1
        docs.append((i, " ".join(rng.choice(stock[domain] + ["common"]) for _ in range(rng.randint(5, 120)))))
        if i % 2 or i % 8 == 0:
            labels.append((i, int(domain == 1), int(domain == 2)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels + [(3, None, 1), (None, 1, 0)], LABELS)


@pytest.mark.parametrize("floor", [0.0, 1.0])
def test_expected_totals_meet_targets(spark, floor):
    docs, labels = table(spark)
    classifier = mixing.learn(docs, mixing.domain_labels(labels), 3)
    members = mixing.memberships(docs, classifier)
    done, wanted, totals = mixing.mix(members, [0.2, 0.7, 0.1], floor, 1.0 + 0.3 * floor)
    rows = done.select("row.doc_id", "n_tokens", "posterior", "rate", "copies").collect()
    again = np.sum([r["rate"] * r["n_tokens"] * np.array(r["posterior"]) for r in rows], axis=0)
    assert np.allclose(again, totals, rtol=1e-6)
    assert np.allclose(totals, wanted, rtol=0.03)
    assert min(r["rate"] for r in rows) >= floor and all(r["copies"] in (int(r["rate"]), int(r["rate"]) + 1) for r in rows)
    right = sum(np.argmax(r["posterior"]) == (0 if r["doc_id"] % 4 == 0 else 2 if r["doc_id"] % 10 == 1 else 1) for r in rows)
    assert right / len(rows) > 0.95


def test_words_of_texts():
    texts = [b"One two  one", b"", b" ", b"a\x0bONE", b"two"]
    owner, bucket = mixing.word_buckets(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts]))
    assert owner.tolist() == [0, 0, 0, 3, 3, 4]
    assert bucket[0] == bucket[2] == bucket[4] and bucket[1] == bucket[5] and len(set(bucket.tolist())) == 3
    owner, _ = mixing.word_buckets(np.frombuffer(b"  x", np.uint8), np.array([2, 1]))
    assert owner.tolist() == [1]
    assert B.flat  # texts arrive as these bytes


def test_resampled_keeps_every_document(spark):
    docs, labels = table(spark)
    got = mixing.resampled(docs, labels)
    assert got.columns == docs.columns
    assert {r["doc_id"] for r in got.collect()} == set(range(900))


def test_odd_rows_and_no_rows(spark, odd, empty):
    labels = spark.createDataFrame([], LABELS)
    assert mixing.mixed(odd, labels).count() == 5
    assert mixing.mixed(empty, labels).collect() == []
    assert mixing.resampled(empty, labels).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(mixing.memberships(odd, mixing.learn(odd, mixing.domain_labels(labels), 3)), [0.5, 0.6, 0.1])


def members_of(spark, rows):
    """(doc_id, n_tokens, posterior) as memberships gives them."""
    return spark.createDataFrame([((i,), n, p) for i, n, p in rows], "row struct<doc_id:long>, n_tokens long, posterior array<double>")


def plain_steps(rows, wanted, steps=20_000):
    """The least squares of the same totals by short steps on single rates."""
    n, p = np.array([r[1] for r in rows], float), np.array([r[2] for r in rows])
    made = p * n[:, None] / wanted
    rates, length = np.ones(len(rows)), 1 / np.linalg.norm(made, 2) ** 2
    for _ in range(steps):
        rates = np.maximum(0, rates - length * made @ (made.T @ rates - 1))
    return (n * rates) @ p


def test_soft_domains_meet_the_production_targets(spark):
    rng = np.random.default_rng(4)
    targets = [mixing.TARGETS[d] for d in mixing.DOMAINS]
    rows = [(i, int(rng.integers(1, 400)), rng.dirichlet([(4, 1, 0.2), (0.3, 5, 0.3), (0.2, 2, 3)][i % 10 // 4]).tolist()) for i in range(400)]
    done, wanted, totals = mixing.mix(members_of(spark, rows), targets)
    assert np.allclose(totals, wanted, rtol=mixing.NEAR)
    assert np.allclose(plain_steps(rows, np.array(wanted)), wanted, rtol=0.01)
    got = done.select("n_tokens", "posterior", "rate").collect()
    assert np.allclose(np.sum([r[0] * r[2] * np.array(r[1]) for r in got], axis=0), wanted, rtol=mixing.NEAR)
    assert min(r[2] for r in got) == 0


def test_targets_out_of_reach_are_named(spark, caplog):
    rows = [(i, 100, [0.5, 0.4, 0.1]) for i in range(20)]
    _, wanted, totals = mixing.mix(members_of(spark, rows), [0.1, 0.88, 0.02])
    assert "off by" in caplog.text and abs(totals[2] / wanted[2] - 1) > mixing.NEAR
    caplog.clear()
    # A floor of 1 keeps the first domain at 1,000 tokens of 2,100 at most.
    rows = [(i, 100, [1.0, 0.0, 0.0]) for i in range(10)] + [(10, 300, [0.0, 1.0, 0.0]), (11, 100, [0.0, 0.0, 1.0])]
    done, wanted, totals = mixing.mix(members_of(spark, rows), [0.1, 0.8, 0.1], 1.0, None)
    assert "off by" in caplog.text and sum(wanted) == pytest.approx(1.5 * 1400)
    assert min(r["copies"] for r in done.collect()) >= 1


def test_growth_lowers_no_domain(spark):
    rows = [(i, 100, [1.0, 0.0]) for i in range(60)] + [(60 + i, 100, [0.0, 1.0]) for i in range(40)]
    done, wanted, totals = mixing.mix(members_of(spark, rows), [0.5, 0.5], 1.0, None)
    assert np.allclose(wanted, [6000, 6000]) and np.allclose(totals, wanted, rtol=mixing.NEAR)
    assert min(r["copies"] for r in done.collect()) >= 1


def test_repeated_rows_round_independently(spark):
    rows = [(7, 10, [1.0, 0.0])] * 1001 + [(8, 10, [0.0, 1.0])] * 400
    done, wanted, _ = mixing.mix(members_of(spark, rows), [0.2, 0.8])
    got = done.filter("row.doc_id = 7").collect()
    rate = got[0]["rate"]
    assert 0.2 < rate < 0.4 and abs(sum(r["copies"] for r in got) - 1001 * rate) < 70
