import hashlib

import numpy as np
import pytest

from cartlake.llm import suffix
from cartlake.llm import blocks as B


def brute(rows):
    first, out = {}, {}
    for doc_id, text in sorted((r[0], (r[1] or "").encode()) for r in rows):
        gone = bytearray(len(text))
        for p in range(len(text) - 49):
            if first.setdefault(text[p : p + 50], doc_id) < doc_id:
                gone[p : p + 50] = b"\1" * 50
        spans = sum(1 for p in range(len(text)) if gone[p] and (p == 0 or not gone[p - 1]))
        kept = bytes(x for x, g in zip(text, gone) if not g)
        out[doc_id] = (len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("ranges", [1, 3, 8])
def test_as_brute_force(docs, rows, ranges):
    done = suffix.dedup_passages(docs, ranges=ranges, shard_bytes=1000).collect()
    got = {r["row"]["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in done}
    assert len(done) == len(rows)
    assert got == brute(rows)


def test_digest_and_kept_columns(docs, rows):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix.digest(docs).collect()}
    assert got == brute(rows)
    kept = suffix.dedup_passages(docs, keep=docs.columns).select("row.*", "kept")
    assert set(docs.columns) - {"text"} | {"kept"} == set(kept.columns)
    assert kept.count() == len(rows)


def test_odd_rows_and_no_rows(odd, empty):
    got = suffix.digest(odd).collect()
    assert len(got) == 5 and all(r["n_removed"] == 0 for r in got)
    assert suffix.digest(empty).collect() == []


def test_family_levels_have_distinct_ranks():
    family, everything = suffix.Family(), []
    rng = np.random.default_rng(1)
    for n in range(1, 14):
        keys = np.unique(rng.integers(0, 1 << 40, 50, dtype=np.uint64))
        family.add(keys)
        everything.append(keys)
        ranks = [rank for rank, _ in family.levels]
        assert ranks == [i for i in reversed(range(5)) if n >> i & 1]
    assert family.holds(np.sort(np.concatenate(everything))).all()
    assert not family.holds(np.array([1 << 50], np.uint64)).any()


def test_window_hashes_cross_chunks(monkeypatch):
    data = np.frombuffer(np.random.default_rng(2).bytes(3000), np.uint8)
    whole = suffix.window_hashes(data), suffix.minimizers(data)
    monkeypatch.setattr(suffix, "CHUNK", 64)
    assert (suffix.window_hashes(data) == whole[0]).all() and (suffix.minimizers(data) == whole[1]).all()
    assert (suffix.window_hashes(data[7:107]) == whole[0][7:58]).all()


def test_squeeze_round_trip():
    parts = B.unsqueeze(B.squeeze(np.arange(5), b"abc", np.zeros(0, np.uint8)))
    assert list(B.array(parts[0], np.int64)) == [0, 1, 2, 3, 4] and bytes(parts[1]) == b"abc" and len(parts[2]) == 0


def test_hashes_at_places_are_those_of_all_windows():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 3 * suffix.CHUNK + 77, dtype=np.uint8)
    whole = suffix.window_hashes(data)
    edges = [0, suffix.CHUNK - 1, suffix.CHUNK, 2 * suffix.CHUNK, len(whole) - 1]
    places = np.concatenate([rng.integers(0, len(whole), 500), edges])
    assert (suffix.hashes_at(data, places) == whole[places]).all()
    assert len(suffix.hashes_at(data[:60], np.zeros(0, np.int64))) == 0
