import hashlib
import random
import zlib

from cartlake.llm import periodic, registry

SF = "/root/testdata/sf0.001"



def brute_runs(words):
    """Every period over every stretch."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    dropped = {i for s, e, q in found for i in range(s + q, e)}
    top = min(found, key=lambda r: (r[0] - r[1], r[0], r[2])) if found else None
    shown = (top[0], top[1] - top[0], top[2], 1000 * (top[1] - top[0]) // top[2]) if top else (None,) * 4
    runs = "".join(f"{s},{e - s},{q}\n" for s, e, q in found).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(found), *shown, hashlib.sha256(runs).hexdigest(), hashlib.sha256(kept).hexdigest())


def made_up(rng):
    out = []
    for _ in range(rng.randint(0, 5)):
        base = [b"abcdefgh"[x : x + 1] for x in (rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(1, 12)))]
        if rng.random() < 0.4:
            base = base * rng.randint(1, 5) + [rng.choice([b"x", b"a"])]
        out += (base * 8)[: rng.randint(1, len(base) * 8)]
    return out


def test_runs_of_nested_periods():
    rng = random.Random(1)
    for _ in range(800):
        documents = [made_up(rng) for _ in range(rng.randint(1, 5))]
        assert periodic.of_batch(documents) == [brute_runs(d) for d in documents]


def test_long_words_of_two_letters():
    words = [b"a", b"ab"]
    for _ in range(12):
        words.append(words[-1] + words[-2])
    letters = [words[-1][i : i + 1] for i in range(len(words[-1]))]
    assert periodic.of_batch([letters, letters * 5, [b"a"] * 3000]) == [brute_runs(letters), brute_runs(letters * 5), [(0, 3000, 1)]]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_documents(spark, docs, rows):
    want = ordered(brute(r[0], r[1]) for r in rows)
    assert ordered(periodic.digest(docs).collect()) == want
    assert ordered(periodic.digest(docs, limit=20).collect()) == want


def test_odd_rows(spark, odd, empty):
    assert ordered(periodic.digest(odd).collect()) == ordered(brute(r["doc_id"], r["text"]) for r in odd.collect())
    assert periodic.digest(empty).count() == 0
    spaces = spark.createDataFrame([(1, "a b a b\va b\fa b\ra b a b c"), (2, "a " * 5)], "doc_id long, text string")
    assert ordered(periodic.digest(spaces).collect()) == ordered(brute(r[0], r[1]) for r in spaces.collect())


def test_query_reads_whole_table(spark):
    got = ordered(registry.queries()["op13_periodic_runs"](spark, SF).collect())
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got == ordered(brute(*r) for r in rows)


