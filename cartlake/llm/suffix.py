"""Removal of long passages that stand in an earlier document, by suffix arrays.

The suffixes of a text that matter here are told apart by their first ``width`` bytes (50).
Sorting every one of them costs more than reading the corpus many times, so a sparse
sample of them decides which are looked at: each ``width``-byte string has a minimizer,
the least hash of its 24-byte strings, and equal strings have equal minimizers.

1. Documents are packed into blocks (``blocks``), split by ranges of doc_id: the batches.
2. Blocks send their distinct minimizers to shards; a shard returns to each block those
   that another block has too.
3. Blocks send the text around shared minimizers to shards. Equal stretches inside a block
   are sent once, for the smallest doc_id; the others are known to repeat it. So a passage
   that a third of all documents share reaches a shard once per block, not per document.
4. A shard keeps a logarithmic family of suffix arrays. Each batch, in order of doc_id,
   gets its own sorted array, is scanned for repeats inside the batch, is merge-scanned
   against every level, and becomes a new level of what is new; levels of equal rank merge
   into one of the next rank, so n batches leave at most log2(n) + 1 levels.
5. Blocks join the matched stretches and drop the covered bytes.

Arrays are ordered by a 64-bit hash of the first 50 bytes instead of by the bytes: equal
prefixes meet just the same, and no more than that is asked of the order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlake.llm import blocks as B
from cartlake.session import stage

WIDTH, GRAM = 50, 24
RANGES = 8
SHARD_BYTES = 24 << 20
CHUNK = 1 << 17
LOW = np.uint64(0xFFFFFFFF)
MULTIPLIER = 0x9E3779B97F4A7C15
TABLE = np.random.default_rng(50).integers(1, 1 << 63, 256, dtype=np.uint64)


def power(n: int) -> np.uint64:
    return np.uint64(pow(MULTIPLIER, n, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def doubled(h: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hashes of 2n bytes from those of n bytes."""
    return h[:-n] * power(n) + h[n:]


def rolled(data: np.ndarray, top: int = 32) -> dict[int, np.ndarray]:
    h = {1: TABLE[data]}
    n = 1
    while n < top and len(h[n]) > n:
        h[2 * n] = doubled(h[n], n)
        n *= 2
    return h


def window_hashes(data: np.ndarray) -> np.ndarray:
    """The hash of every WIDTH bytes; WIDTH = 32 + 16 + 2."""
    count = max(0, len(data) - WIDTH + 1)
    out = np.empty(count, np.uint64)
    for at in range(0, count, CHUNK):
        n = min(CHUNK, count - at)
        h = rolled(data[at : at + n + WIDTH - 1])
        out[at : at + n] = mix(h[32][:n] * power(18) + h[16][32 : 32 + n] * power(2) + h[2][48 : 48 + n])
    return out


def hashes_at(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """``window_hashes(data)[places]``, never holding more hashes than those of a chunk."""
    out = np.empty(len(places), np.uint64)
    order = np.argsort(places, kind="stable")
    edges = np.searchsorted(places[order], np.arange(0, len(data) + CHUNK, CHUNK))
    for at, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        if b > a:
            mine, begin = order[a:b], at * CHUNK
            out[mine] = window_hashes(data[begin : begin + CHUNK + WIDTH - 1])[places[mine] - begin]
    return out


def minimizers(data: np.ndarray) -> np.ndarray:
    """For every WIDTH bytes the least hash of their GRAM-byte strings."""
    count = max(0, len(data) - WIDTH + 1)
    out = np.empty(count, np.uint64)
    span = WIDTH - GRAM + 1
    for at in range(0, count, CHUNK):
        n = min(CHUNK, count - at)
        h = rolled(data[at : at + n + WIDTH - 1], 16)
        low, have = mix(h[16][: n + span - 1] * power(8) + h[8][16 : 16 + n + span - 1]), 1  # GRAM = 16 + 8
        while have * 2 <= span:
            low, have = np.minimum(low[:-have], low[have:]), have * 2
        rest = span - have
        out[at : at + n] = np.minimum(low[:n], low[rest : rest + n])
    return out


def runs(data: np.ndarray, lengths: np.ndarray):
    """Stretches of window starts inside one document with one minimizer, WIDTH at most.

    Returns the first start, the number of starts, the minimizer, the document's ordinal."""
    ends = np.cumsum(lengths)
    low = minimizers(data)
    if not len(low):
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    edge = np.zeros(len(data) + 1, np.int8)
    long = lengths >= WIDTH
    np.add.at(edge, (ends - lengths)[long], 1)
    np.add.at(edge, (ends - WIDTH + 1)[long], -1)
    valid = np.cumsum(edge[: len(low)], dtype=np.int8).astype(bool)
    begin = valid.copy()
    begin[1:] &= ~valid[:-1] | (low[1:] != low[:-1])
    start = np.flatnonzero(begin)
    owner = np.searchsorted(ends, start, side="right")
    stop = np.minimum(np.append(start[1:], len(low)), ends[owner] - WIDTH + 1)
    count = stop - start
    cut = -(-count // WIDTH)  # a stretch of more than WIDTH starts is cut
    if cut.max(initial=0) > 1:
        nth = np.arange(cut.sum()) - np.repeat(np.cumsum(cut) - cut, cut)
        start, stop, owner = np.repeat(start, cut) + nth * WIDTH, np.repeat(stop, cut), np.repeat(owner, cut)
        count = np.minimum(stop - start, WIDTH)
    return start, count, low[start], owner


def gather(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    at = np.repeat(start - (np.cumsum(length) - length), length)
    return data[at + np.arange(len(at))]


def by_shard(low: np.ndarray, shards: int) -> np.ndarray:
    return ((low >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def groups(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each group of equal keys starts."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1]))


def make_blocks(docs: DataFrame, keep: list[str] | None, cuts: list[int]) -> DataFrame:
    bounds = np.array(cuts, np.int64)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            B.trim()
            ids = whole.column("id")
            part = np.searchsorted(bounds, ids.fill_null(0).to_numpy(zero_copy_only=False), side="left")
            part = np.where(ids.is_null().to_numpy(zero_copy_only=False), -1, part)
            for p in np.unique(part):
                for batch in B.pieces(whole.take(pa.array(np.flatnonzero(part == p)))):
                    data, lengths = B.flat(batch.column("text"))
                    doc_ids = batch.column("id").fill_null(0).to_numpy(zero_copy_only=False)
                    body = B.squeeze(lengths, doc_ids.astype(np.int64), data, B.pack_rows(batch.column("row")))
                    yield pa.record_batch(
                        [[B.new_block()], pa.array([int(p)], pa.int32()), [len(data)], [body]],
                        names=["block", "part", "n_bytes", "body"],
                    )

    rows = B.with_text(docs, keep).withColumn("id", F.lit(None).cast("long") if "doc_id" not in docs.columns else F.col("row.doc_id").cast("long"))
    return rows.mapInArrow(build, "block long, part int, n_bytes long, body binary")


def opened(body: bytes):
    lengths, ids, data, rows = B.unsqueeze(body)
    return B.array(lengths, np.int64), B.array(ids, np.int64), B.array(data, np.uint8), rows


def batch_of(schema: str, columns: list[list]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


SENT = "shard int, block long, low binary"


def sent_minimizers(shards: int):
    def send(batches):
        for batch in batches:
            B.trim()
            for block, part, body in zip(*(batch.column(c).to_pylist() for c in ("block", "part", "body"))):
                if part < 0:
                    continue
                lengths, _, data, _ = opened(body)
                low = np.unique(runs(data, lengths)[2])
                shard = by_shard(low, shards)
                order = np.argsort(shard, kind="stable")
                low, shard = low[order] & LOW, shard[order]
                cuts = np.append(groups(shard), len(shard))
                out = [
                    (int(shard[a]), block, B.squeeze(np.diff(np.sort(low[a:b]), prepend=np.uint64(0)).astype(np.uint32)))
                    for a, b in zip(cuts[:-1], cuts[1:])
                ]
                if out:
                    yield batch_of(SENT, list(map(list, zip(*out))))

    return send


SHARED = "block long, shard int, low binary"


def shared_minimizers(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Of one shard: to each block the minimizers that another block has as well."""
    owners, values = table.column("block").to_pylist(), []
    for low in table.column("low").to_pylist():
        values.append(np.cumsum(B.array(B.unsqueeze(low)[0], np.uint32), dtype=np.uint64).astype(np.uint32))
    size = np.array([len(v) for v in values])
    owner, value = np.repeat(np.arange(len(values)), size), np.concatenate(values)
    order = np.argsort(value, kind="stable")
    owner, value = owner[order], value[order]
    first = groups(value)
    many = np.repeat(np.diff(np.append(first, len(value))) > 1, np.diff(np.append(first, len(value))))
    owner, value = owner[many], value[many]
    order = np.argsort(owner, kind="stable")
    owner, value = owner[order], value[order]
    cuts = np.append(groups(owner), len(owner))
    out = [
        (owners[owner[a]], key[0].as_py(), B.squeeze(np.diff(value[a:b].astype(np.uint64), prepend=np.uint64(0)).astype(np.uint32)))
        for a, b in zip(cuts[:-1], cuts[1:])
    ]
    return pa.Table.from_batches([batch_of(SHARED, list(map(list, zip(*out))) if out else [[], [], []])])


#: kind 0: text for a shard (target); kind 1: known repeats in a block (target).
TEXTS = "kind int, target long, part int, block long, body binary"


def texts_and_repeats(shards: int):
    def send(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        B.trim()
        out = []
        known = [
            (np.uint64(s) << np.uint64(32))
            | np.cumsum(B.array(B.unsqueeze(low)[0], np.uint32), dtype=np.uint64)
            for s, low in zip(replies.column("shard").to_pylist(), replies.column("low").to_pylist())
        ]
        known = np.sort(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        for block, part, body in zip(*(blocks.column(c).to_pylist() for c in ("block", "part", "body"))):
            if part < 0:
                continue
            lengths, ids, data, _ = opened(body)
            start, count, low, owner = runs(data, lengths)
            shard = by_shard(low, shards)
            key = (shard.astype(np.uint64) << np.uint64(32)) | (low & LOW)
            at = np.minimum(np.searchsorted(known, key), max(0, len(known) - 1))
            seen = known[at] == key if len(known) else np.zeros(len(key), bool)
            doc = ids[owner]
            order = np.argsort(low, kind="stable")
            first = groups(low[order])
            if len(first):
                sizes = np.diff(np.append(first, len(order)))
                several = np.minimum.reduceat(doc[order], first) != np.maximum.reduceat(doc[order], first)
                seen[order] |= np.repeat(several, sizes)
            pick = np.flatnonzero(seen)
            if not len(pick):
                continue
            start, count, low, owner, doc, shard = (x[pick] for x in (start, count, low, owner, doc, shard))
            whole = mix(
                hashes_at(data, start) * np.uint64(3) + hashes_at(data, start + count - 1) * np.uint64(5) + count.astype(np.uint64)
            )
            order = np.lexsort((doc, whole))
            first = groups(whole[order])
            least = np.repeat(doc[order][first], np.diff(np.append(first, len(order))))
            repeat = np.zeros(len(order), bool)
            repeat[order] = doc[order] > least
            base = (np.cumsum(lengths) - lengths)[owner]
            if repeat.any():
                hit = intervals(owner[repeat], (start - base)[repeat], count[repeat])
                out.append((1, block, part, block, B.squeeze(*hit)))
            rest = np.flatnonzero(~repeat)
            rest = rest[np.argsort(shard[rest], kind="stable")]
            cuts = np.append(groups(shard[rest]), len(rest))
            for a, b in zip(cuts[:-1], cuts[1:]):
                r = rest[a:b]
                out.append((
                    0, int(shard[r[0]]), part, block,
                    B.squeeze(
                        doc[r], owner[r].astype(np.int32), (start - base)[r].astype(np.int32),
                        count[r].astype(np.uint8), gather(data, start[r], count[r] + WIDTH - 1),
                    ),
                ))
        return pa.Table.from_batches([batch_of(TEXTS, list(map(list, zip(*out))) if out else [[]] * 5)])

    return send


def intervals(owner: np.ndarray, start: np.ndarray, count: np.ndarray) -> list[np.ndarray]:
    """Covered bytes [start, end) of consecutive stretches, merged where they follow each other."""
    new = np.append(True, (owner[1:] != owner[:-1]) | (start[1:] != (start + count)[:-1]))
    last = np.append(np.flatnonzero(new)[1:] - 1, len(owner) - 1)
    return [
        owner[new].astype(np.int32),
        start[new].astype(np.int32),
        (start[last] + count[last] + WIDTH - 1).astype(np.int32),
    ]


class Family:
    """Suffix arrays whose ranks are distinct: adding one of rank 0 merges like a binary counter."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, np.ndarray]] = []

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Merge scan of sorted keys against every level."""
        found = np.zeros(len(keys), bool)
        for _, level in self.levels:
            if len(level) and len(keys):
                at = np.minimum(np.searchsorted(level, keys), len(level) - 1)
                found |= level[at] == keys
        return found

    def add(self, keys: np.ndarray) -> None:
        rank = 0
        while self.levels and self.levels[-1][0] == rank:
            keys = np.concatenate([self.levels.pop()[1], keys])
            keys.sort(kind="stable")  # two sorted runs: one merge
            rank += 1
        self.levels.append((rank, keys))


HITS = "target long, body binary"


def matched(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Of one shard: per block, the stretches whose bytes stand in a smaller doc_id."""
    B.trim()
    parts = table.column("part").to_numpy()
    bodies, owners = table.column("body").to_pylist(), table.column("block").to_pylist()
    family, out = Family(), []
    for part in np.unique(parts):
        rows = np.flatnonzero(parts == part)
        opened_rows = [B.unsqueeze(bodies[r]) for r in rows]
        doc, ordinal, start, count, text = (
            np.concatenate([B.array(o[i], kind) for o in opened_rows])
            for i, kind in enumerate((np.int64, np.int32, np.int32, np.uint8, np.uint8))
        )
        block = np.repeat(rows, [len(B.array(o[0], np.int64)) for o in opened_rows])
        count = count.astype(np.int64)
        length = count + WIDTH - 1
        first = np.cumsum(length) - length
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        keys = window_hashes(text)[np.repeat(first, count) + nth]
        run = np.repeat(np.arange(len(count)), count)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        lead = groups(keys)
        sizes = np.diff(np.append(lead, len(keys)))
        docs = doc[run[order]]
        least = np.minimum.reduceat(docs, lead)
        old = family.holds(keys[lead])
        hit = np.zeros(len(keys), bool)
        hit[order] = np.repeat(old, sizes) | (docs > np.repeat(least, sizes))
        family.add(keys[lead][~old])
        run, nth = run[hit], nth[hit]
        if not len(run):
            continue
        position = start[run].astype(np.int64) + nth
        cut = np.append(True, (run[1:] != run[:-1]) | (position[1:] != position[:-1] + 1))
        begin = np.flatnonzero(cut)
        size = np.diff(np.append(begin, len(run)))
        run, position = run[begin], position[begin]
        cuts = np.append(groups(block[run]), len(run))
        for a, b in zip(cuts[:-1], cuts[1:]):
            r = run[a:b]
            out.append((owners[block[r[0]]], B.squeeze(*intervals(ordinal[r], position[a:b], size[a:b]))))
    return pa.Table.from_batches([batch_of(HITS, list(map(list, zip(*out))) if out else [[], []])])


def cleaned(blocks: pa.Table, hits: pa.Table) -> pa.Table:
    """Of one block: its documents without the matched stretches."""
    B.trim()
    names = ["row", "n_bytes", "n_removed", "n_spans", "kept"]
    out = []
    found = [B.unsqueeze(x) for x in hits.column("body").to_pylist()]
    owner, start, end = (
        np.concatenate([B.array(f[i], np.int32) for f in found] or [np.zeros(0, np.int32)]).astype(np.int64)
        for i in range(3)
    )
    for body in blocks.column("body").to_pylist():
        lengths, _, data, rows = opened(body)
        first = np.cumsum(lengths) - lengths
        edge = np.zeros(len(data) + 1, np.int32)
        np.add.at(edge, first[owner] + start, 1)
        np.add.at(edge, first[owner] + end, -1)
        gone = np.cumsum(edge[: len(data)]) > 0
        rise = gone.copy()
        rise[1:] &= ~gone[:-1]
        inner = first[lengths > 0]
        rise[inner] = gone[inner]
        sums = [np.append(0, np.cumsum(x)) for x in (gone, rise)]
        removed, spans = (s[first + lengths] - s[first] for s in sums)
        kept = data[~gone].tobytes()
        ends = np.cumsum(lengths - removed)
        texts = [kept[a:b] for a, b in zip(np.append(0, ends[:-1]), ends)]
        out.append(pa.record_batch(
            [B.unpack_rows(rows), pa.array(lengths), pa.array(removed), pa.array(spans), pa.array(texts, pa.binary())],
            names=names,
        ))
    return pa.Table.from_batches(out)


def dedup_passages(docs: DataFrame, keep: list[str] | None = None, ranges: int = RANGES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per document: ``row`` (the kept columns, doc_id by default), n_bytes, n_removed,
    n_spans and ``kept``, the bytes that are left.

    A byte goes if a WIDTH-byte string over it also starts in a document with a smaller
    doc_id. Texts are UTF-8 bytes; a null text is empty. Repeats inside a document, or
    among rows with one doc_id, stay. Rows without doc_id stay whole and remove nothing.
    Texts under WIDTH bytes stay. An empty table gives an empty result. Other columns
    are not read unless kept. ``ranges``: number of batches; ``shard_bytes``: text per shard.
    """
    spark = docs.sparkSession
    share = [i / ranges for i in range(1, ranges)]
    cuts = docs.select(F.percentile_approx(F.col("doc_id").cast("long"), share, 10_000)).first()[0] or []
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = B.write_bucketed(make_blocks(docs, keep, sorted(set(cuts))), "passages", "block", partitions)
    total = made.agg(F.sum("n_bytes")).first()[0] or 0
    shards = max(partitions, -(-total // shard_bytes))
    shared = (
        made.mapInArrow(sent_minimizers(shards), SENT).groupBy("shard").applyInArrow(shared_minimizers, SHARED)
    )
    texts = stage(
        made.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(texts_and_repeats(shards), TEXTS),
        "passage-texts",
    )
    hits = (
        texts.filter("kind = 0").groupBy("target").applyInArrow(matched, HITS)
        .unionByName(texts.filter("kind = 1").select("target", "body"))
    )
    schema = T.StructType([B.with_text(docs, keep).schema["row"]])
    for name, kind in (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept", "binary")):
        schema = schema.add(name, kind)
    return (
        made.groupBy("block").cogroup(hits.groupBy("target")).applyInArrow(cleaned, schema)
    )


def digest(docs: DataFrame) -> DataFrame:
    done = dedup_passages(docs)
    return done.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

