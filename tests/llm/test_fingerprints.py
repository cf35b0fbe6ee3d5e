import hashlib

from pyspark.sql import functions as F

from cartlake.llm import multiset


def test_edits(docs, rows):
    got = {r["doc_id"]: r for r in multiset.edits(docs).collect()}
    order = sorted(((r[0], r[1] or "") for r in rows), reverse=True)
    prints = {}
    for (doc_id, text), (_, after) in zip(order, order[1:] + order[:1]):
        n = len(text) // 2
        edited = text[: len(text) - n] + after[:n]
        r = got[doc_id]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        if edited == text:
            assert r["near_edited"] == 1.0 and r["edited_fingerprint"] == r["fingerprint"]
    assert len(got) == len(rows)


def prints(spark, *texts):
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return multiset.with_fingerprint(table, "t", "p")


def test_order_insertion_and_deletion(spark):
    table = prints(spark, "One here.\nTwo here.\nThree", "Three\nTwo here.\nOne here.", "One here.\nTwo here.", "Three", "\n".join(f"line {i % 700}" for i in range(70_000)))
    a, b, c, d, e = (r["p"] for r in table.orderBy("i").collect())
    assert a == b and e["n"] == 70_000
    pair = table.filter("i = 2").select(F.col("p").alias("x")).crossJoin(table.filter("i = 3").select(F.col("p").alias("y")))
    assert pair.select(multiset.combined(F.col("x"), F.col("y")).alias("z")).first()["z"] == a
    pair = table.filter("i = 0").select(F.col("p").alias("x")).crossJoin(table.filter("i = 3").select(F.col("p").alias("y")))
    assert pair.select(multiset.combined(F.col("x"), F.col("y"), -1).alias("z")).first()["z"] == c


def test_likeness_follows_common_paragraphs(spark):
    lines = [f"paragraph {i} of {i * 7}" for i in range(80)]
    table = prints(spark, "\n".join(lines), "\n".join(lines[:40] + [f"new {i}" for i in range(40)]), "\n".join(f"other {i}" for i in range(80)))
    first = table.filter("i = 0").select(F.col("p").alias("x"))
    near = [r["v"] for r in first.join(table, F.lit(True)).orderBy("i").select(multiset.likeness(F.col("x"), F.col("p")).alias("v")).collect()]
    assert near[0] == 1.0 and 0.3 < near[1] < 0.7 and near[2] < 0.25


def test_likeness_of_more_paragraphs_than_a_written_component_holds(spark):
    many, other = ("\n".join(f"{w} {i}" for i in range(200_000)) for w in ("line", "other"))
    half = "\n".join(f"{'line' if i % 2 else 'new'} {i}" for i in range(200_000))
    table = prints(spark, many, other, half, "again\n" * 70_000, "twice\n" * 70_000, "again\n" * 70_001).repartition(6).cache()

    def near(i, j):
        pair = table.filter(f"i = {i}").select(F.col("p").alias("x")).crossJoin(table.filter(f"i = {j}").select(F.col("p").alias("y")))
        return pair.select(multiset.likeness(F.col("x"), F.col("y")).alias("v")).first()["v"]

    assert near(0, 0) == 1.0 and near(0, 1) < 0.4 and 0.3 < near(0, 2) < 0.7
    assert near(3, 4) < 0.4 and near(3, 5) > 0.99


def test_odd_rows_and_no_rows(spark, odd, empty):
    got = multiset.edits(odd).collect()
    assert len(got) == 5
    assert multiset.edits(empty).collect() == []
    one = multiset.edits(spark.createDataFrame([(3, "abcd")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
