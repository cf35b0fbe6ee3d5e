"""Periodic runs of words, by internal pattern matching.

A run of period q holds an aligned block of 2^k words, 2^k <= q < 2^(k+1), near its start, and the
block occurs again q words later. So, per batch of whole documents: a suffix array of word numbers
(prefix doubling; it gives every block its interval), a wavelet tree over the array, and for every
block that occurs twice the successors of its place among the occurrences in the next 2^k places.
Occurrences of a block in so small a window are one arithmetic progression: one or two give their
distances as candidates; of more, with difference d, only the distance between the ends of the two
d-periodic stretches can be the period of a longer one. Candidates are extended word by word and
kept if they are long enough; of equal stretches the least period stays.

Documents are independent: Spark deals them, and a task holds ``BATCH_WORDS`` words, or one longer
document. Separators between documents equal no word and one another.

Cases: a null text has no words; a row without doc_id is left as it is; each repeated row gives
a row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartlake.llm import blocks as B

#: A run has at least ``LEAST`` words and ``TIMES`` periods.
LEAST, TIMES = 6, 4
BATCH_WORDS = 1 << 16


# --- suffix array -----------------------------------------------------------


def aligned(level: int) -> int:
    """Every such place has a block of the level; a run has one before its first 2^k + 1 words, or,
    where its window can hold no progression, early enough to be followed by a period and itself."""
    return 4 if level < 2 else 1 << level


def suffixes(words: np.ndarray, longest: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """The suffix array by prefix doubling, and by level the blocks (place, interval's begin and end)
    that occur more than once.

    ``first[i]`` is the first place in the array of the suffixes that begin as suffix i does. Only
    suffixes that are not alone are sorted again."""
    n = len(words)
    array = np.argsort(words, kind="stable").astype(np.int64)
    new = np.ones(n, bool)
    new[1:] = words[array[1:]] != words[array[:-1]]
    starts = np.flatnonzero(new)
    first = np.empty(n, np.int64)
    first[array] = np.repeat(starts, np.diff(np.append(starts, n)))
    blocks = []
    level = 0
    while True:
        # Groups of more than one: their size by their first place.
        size = np.bincount(first, minlength=n)
        places = np.arange(0, n, aligned(level))
        begin = first[places]
        twice = size[begin] > 1
        blocks.append((places[twice], begin[twice], begin[twice] + size[begin[twice]]))
        width = 1 << level
        level += 1
        alone = size[first[array]] == 1
        again = np.flatnonzero(~alone)
        if not len(again) or width * TIMES > longest:
            break
        # ``again`` lists whole groups, one after the other, so sorting by (group, next) stays inside them.
        held = array[again]
        after = held + width
        following = np.where(after < n, first[np.minimum(after, n - 1)], -1)
        order = np.argsort(first[held] * (n + 1) + following + 1, kind="stable")
        held, following = held[order], following[order]
        array[again] = held
        split = np.ones(len(held), bool)
        split[1:] = (first[held[1:]] != first[held[:-1]]) | (following[1:] != following[:-1])
        heads = np.flatnonzero(split)
        first[held] = np.repeat(again[heads], np.diff(np.append(heads, len(held))))
    return array, blocks


class WaveletTree:
    """A wavelet tree of a permutation, level by level in one row each: of its value ``bits``, from
    the highest, a level has the number of zeros before each place; zeros move to the left."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.bits = max(1, int(n - 1).bit_length())
        self.zeros: list[np.ndarray] = []
        values = values.astype(np.int32)
        for bit in range(self.bits - 1, -1, -1):
            zero = (values >> bit) & 1 == 0
            before = np.zeros(n + 1, np.int32)
            np.cumsum(zero, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate([values[zero], values[~zero]])

    def below(self, begin: np.ndarray, end: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many values of array[begin:end] are less than ``limit``."""
        count = np.zeros(len(begin), np.int64)
        for level, before in enumerate(self.zeros):
            one = (limit >> (self.bits - 1 - level)) & 1 == 1
            a, b = before[begin], before[end]
            count += np.where(one, b - a, 0)
            begin = np.where(one, begin - a + before[-1], a)
            end = np.where(one, end - b + before[-1], b)
        return count

    def smallest(self, begin: np.ndarray, end: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of array[begin:end] that ``rank`` others are less than."""
        value = np.zeros(len(begin), np.int64)
        for level, before in enumerate(self.zeros):
            a, b = before[begin], before[end]
            one = rank >= b - a
            rank = np.where(one, rank - (b - a), rank)
            value = value * 2 + one
            begin = np.where(one, begin - a + before[-1], a)
            end = np.where(one, end - b + before[-1], b)
        return value


def candidates(words: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first distance, progression's difference or 0) of blocks that occur again in their window.

    Blocks with two occurrences there give two rows without a progression."""
    array, blocks = suffixes(words, longest)
    place = np.concatenate([b[0] for b in blocks])
    begin, end = (np.concatenate([b[i] for b in blocks]) for i in (1, 2))
    width = np.concatenate([np.full(len(b[0]), 1 << k, np.int64) for k, b in enumerate(blocks)])
    tree = WaveletTree(array)
    n = len(words)
    low, high = np.minimum(place + width, n), np.minimum(place + 2 * width, n)
    limit = (1 << tree.bits) - 1
    under = tree.below(begin, end, np.minimum(low, limit))
    # All values are below n, so a limit past the last value counts them all.
    under = np.where(low > limit, end - begin, under)
    some = under < end - begin
    place, begin, end, high, under = (v[some] for v in (place, begin, end, high, under))
    one = tree.smallest(begin, end, under)
    some = one < high
    place, begin, end, high, under, one = (v[some] for v in (place, begin, end, high, under, one))
    two = np.where(under + 1 < end - begin, tree.smallest(begin, end, np.minimum(under + 1, end - begin - 1)), n)
    three = np.where(under + 2 < end - begin, tree.smallest(begin, end, np.minimum(under + 2, end - begin - 1)), n)
    pair = two < high
    many = three < high
    single = ~many
    at = np.concatenate([place[single], place[pair & single], place[many]])
    distance = np.concatenate([(one - place)[single], (two - place)[pair & single], (one - place)[many]])
    step = np.concatenate([np.zeros(single.sum() + (pair & single).sum(), np.int64), (two - one)[many]])
    return at, distance, step


# --- runs -------------------------------------------------------------------


def equal_ahead(words: np.ndarray, i: int, j: int) -> int:
    """How many words from i and from j (behind i) on are equal."""
    done, n, width = 0, len(words), 16
    while j + done < n:
        take = min(width, n - j - done)
        differ = words[i + done : i + done + take] != words[j + done : j + done + take]
        if differ.any():
            return done + int(differ.argmax())
        done += take
        width *= 2
    return done


def equal_before(words: np.ndarray, i: int, j: int) -> int:
    """How many words before i and before j (behind i) are equal."""
    done, width = 0, 16
    while i - done > 0:
        take = min(width, i - done)
        differ = words[i - done - take : i - done] != words[j - done - take : j - done]
        if differ.any():
            return done + int(differ[::-1].argmax())
        done += take
        width *= 2
    return done


def runs(words: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """All runs (start, end, period) of the word numbers, by start, then period."""
    if longest < LEAST:
        return []
    at, distance, step = candidates(words, longest)
    found: dict[tuple[int, int], int] = {}
    stretch: dict[int, tuple[int, int]] = {}

    def end_of(i: int, d: int) -> int:
        """Where the stretch of period d that holds i and i + d ends."""
        begin, end = stretch.get(d, (0, 0))
        if not begin <= i <= end - d:
            begin, end = i, i + d + equal_ahead(words, i, i + d)
            stretch[d] = begin, end
        return end

    many = step > 0
    extra = []
    if many.any():
        order = np.argsort(at[many], kind="stable")
        for i, f, d in zip(*(v[many][order].tolist() for v in (at, distance, step))):
            q = end_of(i + f, d) - end_of(i, d)
            if q > 0:
                extra.append((i, q))
    at, distance = at[~many], distance[~many]
    # A block lies so early in its run that a period more agrees after its next place; most
    # candidates differ within a few words.
    for t in range(1, 9):
        far = at + distance + np.minimum(t, distance)
        at, distance = (v[(far < len(words)) & (words[np.minimum(far, len(words) - 1)] == words[np.minimum(far - distance, len(words) - 1)])] for v in (at, distance))
    pairs = sorted({(q, i) for i, q in extra} | set(zip(distance.tolist(), at.tolist())))
    covered = (0, 0)
    for q, i in pairs:
        if covered[0] == q and i + q < covered[1]:
            continue
        start = i - equal_before(words, i, i + q)
        end = i + q + equal_ahead(words, i, i + q)
        covered = q, end
        if end - start >= max(LEAST, TIMES * q):
            found[start, end] = min(q, found.get((start, end), q))
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


# --- documents --------------------------------------------------------------


def rotated(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's edit: in a tenth of the documents words repeat from some place on."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def of_batch(documents: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs (start, end, period) of each document, its words numbered from 0."""
    numbers: dict[bytes, int] = {}
    flat = []
    offsets = []
    for k, words in enumerate(documents):
        offsets.append(len(flat))
        flat.extend(numbers.setdefault(w, len(numbers)) for w in words)
        flat.append(-1 - k)
    found = runs(np.array(flat, np.int64), max(map(len, documents)))
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    owner = np.searchsorted(offsets, [s for s, _, _ in found], side="right") - 1
    for (s, e, q), k in zip(found, owner):
        out[k].append((s - offsets[k], e - offsets[k], q))
    return out


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those behind the first period of a run."""
    if not found:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for s, e, q in found:
        edges[s + q] += 1
        edges[e] -= 1
    return [w for w, inside in zip(words, np.cumsum(edges).tolist()) if not inside]


SCHEMA = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def described(words: list[bytes], found: list[tuple[int, int, int]]) -> dict:
    listing = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
    row = {"n_runs": len(found), "start": None, "length": None, "period": None, "exponent_milli": None}
    if found:
        s, e, q = min(found, key=lambda r: (r[0] - r[1], r[0], r[2]))
        row |= {"start": s, "length": e - s, "period": q, "exponent_milli": 1000 * (e - s) // q}
    row["runs_sha256"] = hashlib.sha256(listing.encode()).hexdigest()
    row["collapsed_sha256"] = hashlib.sha256(b" ".join(collapsed(words, found))).hexdigest()
    return row


def grouped(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[int, list[list[bytes]], list]]:
    """Consecutive rows with ``limit`` words in all, or one longer document: (first row, words, rows)."""
    held, size, first = [], 0, 0
    for i, (row, text) in enumerate(zip(batch.column("row"), batch.column("text"))):
        words = text.as_buffer().to_pybytes().split()
        if held and size + len(words) > limit:
            yield first, held
            held, size, first = [], 0, i
        doc_id = row.as_py()["doc_id"]
        held.append(rotated(words, doc_id))
        size += len(words)
    if held:
        yield first, held


def digest(docs: DataFrame, limit: int = BATCH_WORDS) -> DataFrame:
    rows = B.with_text(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in B.pieces(whole):
                for first, documents in grouped(batch, limit):
                    said = [described(w, f) for w, f in zip(documents, of_batch(documents))]
                    columns = pa.RecordBatch.from_pylist(said, ARROW)
                    yield pa.record_batch([batch.column("row").slice(first, len(documents)), *columns.columns], names=["row", *columns.schema.names])

    kind = rows.select("row").schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, {SCHEMA}").select("row.doc_id", *[c.split()[0] for c in SCHEMA.split(", ")])


ARROW = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in SCHEMA.split(", ")])
