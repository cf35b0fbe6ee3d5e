import corpus_pipeline
from cartlake.llm import simhash, suffix, toxicity


def test_stages_on_a_small_folder(spark, rows, tmp_path):
    d = str(tmp_path)
    insults = [(9000 + i, f"you {w} grobian and vile grobian {w} {i}", "en", "src0", 30) for i, w in enumerate(["ox", "ass", "elk", "hen", "ram"] * 12)]
    every = rows + insults
    docs = spark.createDataFrame(every, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{d}/documents.parquet")
    labels = [(r[0], 1, 0) for r in rows] + [(r[0], 1, 1) for r in insults]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")

    texts = {r[0]: r[1] or "" for r in every}
    seen = docs
    for i, (name, function) in enumerate(corpus_pipeline.STAGES):
        out = function(spark, seen, d)
        out.write.parquet(f"{d}/{i}")
        kept = spark.read.parquet(f"{d}/{i}")
        ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
        before = {r["doc_id"] for r in seen.select("doc_id").collect()}
        if name != "bpe_encoding":
            assert sorted(kept.columns) == sorted(docs.columns)
        if name == "toxicity":
            assert len(ids & {r[0] for r in insults}) < 20 and len(ids) >= len(rows) * 0.9
        elif name == "simhash_near_dedup":
            groups = {r["doc_id"]: r["component_id"] for r in simhash.digest(seen).collect()}
            assert ids == {c for c in groups.values()}
        elif name == "suffix_array_dedup":
            whole = {r["doc_id"]: r for r in suffix.digest(seen).collect()}
            assert ids == {k for k, r in whole.items() if not (r["n_removed"] and r["n_removed"] == r["n_bytes"])}
            for r in kept.collect():
                if not whole[r["doc_id"]]["n_removed"]:
                    assert (r["text"] or "") == texts[r["doc_id"]]
        else:
            assert ids == before
        seen = kept
    assert toxicity.THRESHOLD == 0.3


def test_run_gives_the_last_stage(spark, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([(1, "alone", "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    got = corpus_pipeline.run(spark, d).collect()
    assert [(r["doc_id"], r["n_tokens"]) for r in got] == [(1, len(bytes(got[0]["ids"])) // 4)]


NAMES = "doc_id long, text string, lang string, source string, n_chars long, _text string, _hash long, row string, score double"


def folder(spark, d, rows):
    spark.createDataFrame(rows, NAMES).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return spark.read.parquet(f"{d}/documents.parquet")


def test_rows_of_one_id_are_judged_by_their_own_groups(spark, tmp_path):
    extra = ("en", "s", 5, "own", 7, "r", 0.5)
    rows = [(1, "a text that stands twice", *extra), (5, "a text that stands twice", *extra), (5, "this one is alone here", *extra)]
    rows += [(8, "twice the same row", *extra)] * 2 + [(None, "a text that stands twice", *extra)]
    docs = folder(spark, str(tmp_path), rows)
    kept = corpus_pipeline.one_of_near_copies(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == sorted((r[0] or 0, r[1]) for r in rows if r[:2] != (5, "a text that stands twice"))


def test_nulls_repeated_rows_and_clashing_names_in_every_stage(spark, tmp_path):
    blank = (None,) * 7
    rows = [(None, None, *blank), (None, "some text of ours", *blank), (4, "same row here", *blank), (4, "same row here", *blank), (4, None, *blank)]
    rows += [(6, "", "en", "s", 0, "own", 7, "r", 0.5), (7, "é" * 70_000, "en", "s", 70_000, "own", 7, "r", 0.5)]
    d = str(tmp_path)
    seen = folder(spark, d, rows)
    for i, (name, function) in enumerate(corpus_pipeline.STAGES):
        out = function(spark, seen, d)
        if name != "bpe_encoding":
            assert out.columns == seen.columns
        out.write.parquet(f"{d}/{i}")
        seen = spark.read.parquet(f"{d}/{i}")
        if name == "mixing":
            assert {r["_text"] for r in seen.filter("doc_id = 7").collect()} == {"own"}
    assert {r["doc_id"] for r in seen.collect()} == {None, 4, 7}


def test_an_empty_table_gives_an_empty_corpus(spark, tmp_path):
    d = str(tmp_path)
    seen = folder(spark, d, [])
    for i, (_, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, seen, d).write.parquet(f"{d}/{i}")
        seen = spark.read.parquet(f"{d}/{i}")
    assert seen.count() == 0
