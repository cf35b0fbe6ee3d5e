import random
import zlib

from cartlake.llm import toxicity


def sentence(rng, n):
    return " ".join("".join(rng.choice(["ban", "tor", "eli", "mus", "ver"]) for _ in range(rng.randint(2, 4))) for _ in range(n))


def table(spark):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        words = sentence(rng, rng.randint(5, 60)).split()
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["Gr0bian", "grobіanus", "GROBIAN", "sch|ump", "schlump"]))
        docs.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, 1, int(toxic)))
    docs += [(600 + i, docs[0][1]) for i in range(40)]  # copies must not teach their own words
    labels += [(600 + i, 1, 1) for i in range(40)] + [(None, 1, 1), (5, None, None)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = table(spark)
    got = {r["doc_id"]: r for r in toxicity.digest(docs, labels).collect()}
    assert len(got) == 640
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [i for i in range(600) if got[i]["held_out"]]
    assert sum(got[i]["predicted"] == (i % 5 == 0) for i in held) / len(held) > 0.97


def test_folding():
    assert toxicity.fold("ＨＥ11Ο, wörld!") == toxicity.fold("hello WORLD")
    assert toxicity.fold("") == toxicity.fold("!!") == "  "


def test_exceptions_and_longest_term():
    lexicon = toxicity.Lexicon({toxicity.fold("trash"): 3.0, toxicity.fold("grob")[:-1]: 1.0, toxicity.fold("grobian")[:-1]: 2.0})
    assert lexicon.found(toxicity.fold("Trash! grobians")) == 5.0
    assert lexicon.found(toxicity.fold("the tr4sh can")) == 0.0
    assert lexicon.found(toxicity.fold("trashing")) == 0.0
    assert toxicity.Lexicon({}, ()).found(toxicity.fold("trash")) == 0.0
    assert lexicon.score("trash") > lexicon.score("")


def test_a_common_passage_is_no_copy(spark):
    rng = random.Random(8)
    passage = " ".join(f"gemeinsames{i:03d}" for i in range(150))  # its least hash is nearly every text's
    rows = []
    for i in range(240):
        words = sentence(rng, 120).split()
        if i % 4 == 0:
            words.insert(60, "grobian")
        rows.append((i, f"{passage} {' '.join(words)}"))
    near = rows[0][1].split()
    rows += [(1000 + i, " ".join(near[:250] + [f"word{i}"] + near[251:])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0 or i >= 1000)) for i, _ in rows], "doc_id long, quality int, toxic int")
    lexicon = toxicity.learn(docs, labels)
    free = sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(240))
    assert free <= lexicon.rows <= free + 3
    assert lexicon.found(toxicity.fold("grobian")) > 0 and lexicon.found(toxicity.fold(passage)) == 0


def test_odd_rows_and_no_rows(spark, odd, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.digest(odd, labels).collect()
    assert len(got) == 5 and len({r["score"] for r in got}) == 1
    assert not any(r["held_out"] for r in got if r["doc_id"] is None)
    assert toxicity.digest(empty, labels).collect() == []


def test_held_out_labels_change_nothing(spark):
    docs, labels = table(spark)
    held = toxicity.held_out(labels.doc_id)
    turned = labels.withColumn("toxic", toxicity.F.when(held, 1 - labels.toxic).otherwise(labels.toxic))
    one, other = toxicity.learn(docs, labels), toxicity.learn(docs, turned)
    assert one == other and one.terms


def test_bytes_that_are_no_text(spark):
    docs, labels = table(spark)
    broken = docs.withColumn("text", toxicity.F.expr("cast(concat(cast(text as binary), X'20FF20C3') as string)"))
    whole = {r["doc_id"]: r["predicted"] for r in toxicity.digest(docs, labels).collect()}
    assert {r["doc_id"]: r["predicted"] for r in toxicity.digest(broken, labels).collect()} == whole
