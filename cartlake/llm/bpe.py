"""Byte-level BPE over the distinct words of the whole corpus.

1. Documents are packed into blocks; each text is cut into pre-tokens by the pattern, and
   a block keeps its distinct pre-tokens and, per document, their numbers by position.
2. The distinct pre-tokens of all blocks are shuffled by their hash, so equal ones meet:
   each is merged into ids once, and the ids go back to every block that has it. A word
   that stands everywhere arrives once per block, not once per occurrence.
3. Blocks join the ids, put them together by position, and decode them by a join with
   the table of token bytes. That table has one row per rank of the vocabulary file, so
   its size is fixed, and each task reads it from the file.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlake.llm import blocks as B

VOCABULARY = "byte_bpe_50k.tiktoken"
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 32 << 20
#: Longer pre-tokens are merged with a heap.
SHORT = 64


@functools.cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


@functools.cache
def token_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table: all bytes, and by id where a token starts and its length."""
    by_id = sorted((i, t) for t, i in ranks(path).items())
    length = np.zeros(by_id[-1][0] + 1, np.int64)
    length[[i for i, _ in by_id]] = [len(t) for _, t in by_id]
    return np.frombuffer(b"".join(t for _, t in by_id), np.uint8), np.cumsum(length) - length, length


def merge(word: bytes, rank: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: the adjacent pair of least rank, leftmost first, merges."""
    if (whole := rank.get(word)) is not None:
        return [whole]
    if len(word) > SHORT:
        return merge_long(word, rank)
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [rank.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
    while pairs:
        least = min(pairs)
        if least == NEVER:
            break
        i = pairs.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = rank.get(parts[i] + parts[i + 1], NEVER)
        if i:
            pairs[i - 1] = rank.get(parts[i - 1] + parts[i], NEVER)
    return [rank[p] for p in parts]


NEVER = 1 << 60


def merge_long(word: bytes, rank: dict[bytes, int]) -> list[int]:
    n = len(word)
    end = list(range(1, n + 1))  # of the part that starts here; 0 where none does
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue  # one of the two has changed since
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := rank.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (j := before[i]) >= 0 and (r := rank.get(word[j:stop])) is not None:
            heapq.heappush(heap, (r, j, stop))
    out, i = [], 0
    while i < n:
        out.append(rank[word[i : end[i]]])
        i = end[i]
    return out


BLOCKS = "block long, n_bytes long, words binary, body binary"


def split_blocks(pattern: str):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        for whole in batches:
            B.trim()
            for batch in B.pieces(whole, BLOCK_BYTES):
                data, lengths = B.flat(batch.column("text"))
                number, places, counts, at = {}, [], [], 0
                for n in lengths.tolist():
                    # Bytes that are no UTF-8 become single marks, and the same bytes again below.
                    found = find(data[at : at + n].tobytes().decode(errors="surrogateescape"))
                    at += n
                    places.append(np.fromiter((number.setdefault(w, len(number)) for w in found), np.uint32, len(found)))
                    counts.append(len(found))
                found = None
                body = B.squeeze(
                    np.array(counts, np.int64), np.concatenate([np.zeros(0, np.uint32), *places]), B.pack_rows(batch.column("row"))
                )
                places = None
                words = [w.encode(errors="surrogateescape") for w in number]
                number = None
                sizes = np.array([len(w) for w in words], np.uint32)
                yield pa.record_batch(
                    [[B.new_block()], [len(data)], [B.squeeze(sizes, b"".join(words))], [body]],
                    names=["block", "n_bytes", "words", "body"],
                )

    return split


SENT = "shard int, block long, words binary"


def words_of(value: bytes) -> list[bytes]:
    sizes, text = B.unsqueeze(value)
    ends = np.cumsum(B.array(sizes, np.uint32), dtype=np.int64).tolist()
    return [bytes(text[a:b]) for a, b in zip([0, *ends], ends)]


def shard_of(words: list[bytes], shards: int) -> np.ndarray:
    return np.fromiter((hash_of(w) for w in words), np.uint64, len(words)) % np.uint64(shards)


def hash_of(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word)


def in_shards(words: list[bytes], shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """The places of a block's words, by shard; the same each time."""
    shard = shard_of(words, shards)
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.unique(shard))
    for a, b in zip(cuts, [*cuts[1:], len(order)]):
        yield int(shard[order[a]]), order[a:b]


def send_words(shards: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, value in zip(batch.column("block").to_pylist(), batch.column("words").to_pylist()):
                words, out = words_of(value), []
                for shard, places in in_shards(words, shards):
                    own = [words[i] for i in places]
                    out.append((shard, block, B.squeeze(np.array([len(w) for w in own], np.uint32), b"".join(own))))
                if out:
                    shard, owner, values = zip(*out)
                    yield pa.record_batch(
                        [pa.array(shard, pa.int32()), pa.array(owner), pa.array(values, pa.binary())],
                        names=["shard", "block", "words"],
                    )

    return send


IDS = "block long, shard int, ids binary"


def encode_words(path: str):
    def encode(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        B.trim()
        """Of one shard: each distinct word is merged once; the ids go to its blocks."""
        rank, number, ids, sizes, out = ranks(path), {}, [], [], []
        for block, value in zip(table.column("block").to_pylist(), table.column("words").to_pylist()):
            places = []
            for word in words_of(value):
                if (place := number.get(word)) is None:
                    place = number[word] = len(number)
                    new = merge(word, rank)
                    ids.append(new)
                    sizes.append(len(new))
                places.append(place)
            own = [ids[p] for p in places]
            out.append((block, B.squeeze(np.array([sizes[p] for p in places], np.uint32), np.array([i for x in own for i in x], np.uint32))))
        block, values = zip(*out)
        return pa.table([pa.array(block), pa.array([key[0].as_py()] * len(out), pa.int32()), pa.array(values, pa.binary())], names=["block", "shard", "ids"])

    return encode


def spread(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The values of stretches, one after the other."""
    at = np.repeat(start - (np.cumsum(length) - length), length)
    return values[at + np.arange(len(at))]


def join_ids(path: str, shards: int):
    def join(blocks: pa.Table, encoded: pa.Table) -> pa.Table:
        B.trim()
        table, token_start, token_size = token_table(path)
        back = dict(zip(encoded.column("shard").to_pylist(), encoded.column("ids").to_pylist()))
        out = []
        for value, body in zip(blocks.column("words").to_pylist(), blocks.column("body").to_pylist()):
            words = words_of(value)
            size = np.zeros(len(words), np.int64)
            order, parts = [], []
            for shard, places in in_shards(words, shards):
                sizes, ids = B.unsqueeze(back[shard])
                size[places] = B.array(sizes, np.uint32)
                order.append(places)
                parts.append(B.array(ids, np.uint32))
            del words
            order = np.concatenate([np.zeros(0, np.int64), *order])
            parts = np.concatenate([np.zeros(0, np.uint32), *parts])
            start = np.zeros(len(size), np.int64)
            start[order] = np.cumsum(size[order]) - size[order]
            counts, places, rows = B.unsqueeze(body)
            counts, places = B.array(counts, np.int64), B.array(places, np.uint32)
            ends = np.cumsum(counts)
            ids_of, decoded = [], []
            for a, b in zip(ends - counts, ends):
                own = places[a:b]
                ids = spread(parts, start[own], size[own])
                ids_of.append(ids.astype("<u4").tobytes())
                decoded.append(spread(table, token_start[ids], token_size[ids]).tobytes())
            out.append(pa.record_batch(
                [B.unpack_rows(rows), pa.array([len(x) // 4 for x in ids_of], pa.int64()), pa.array(ids_of, pa.binary()), pa.array(decoded, pa.binary())],
                names=["row", "n_tokens", "ids", "decoded"],
            ))
        return pa.Table.from_batches(out)

    return join


def encode(
    docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN,
    keep: list[str] | None = None, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Per row: ``row`` (the kept columns, doc_id by default), n_tokens, ``ids`` (little-endian
    unsigned 32-bit integers) and ``decoded``, the bytes that the ids stand for.

    Each match of ``pattern`` is encoded by itself, without special tokens. A null text is
    empty and has no ids. Repeated rows and rows without doc_id each give a row. An empty
    table gives an empty result. Other columns are not read unless kept.
    ``path``: a vocabulary of ranks, to be found under the same name on every machine.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = B.write_bucketed(B.with_text(docs, keep).mapInArrow(split_blocks(pattern), BLOCKS), "words", "block", partitions)
    total = made.agg(F.sum("n_bytes")).first()[0] or 0
    shards = max(partitions, -(-total // shard_bytes))
    encoded = (
        made.select("block", "words").mapInArrow(send_words(shards), SENT)
        .groupBy("shard").applyInArrow(encode_words(path), IDS)
    )
    schema = T.StructType([B.with_text(docs, keep).schema["row"]])
    for name, kind in (("n_tokens", "long"), ("ids", "binary"), ("decoded", "binary")):
        schema = schema.add(name, kind)
    return made.groupBy("block").cogroup(encoded.groupBy("block")).applyInArrow(join_ids(path, shards), schema)


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """Per key: the bytes of its ids (key, position, id), by a join with the token-byte table.

    Unknown or null ids are left out; the table of tokens is broadcast, as its size is that
    of the vocabulary file. The ids of one key must fit in a task, as its text must.
    """
    rank = ranks(path or public_tokenizers.path(VOCABULARY))
    table = tokens.sparkSession.createDataFrame(
        [(i, bytearray(t)) for t, i in rank.items()], "id long, bytes binary"
    )
    joined = tokens.join(F.broadcast(table), "id")
    parts = F.array_sort(F.collect_list(F.struct("position", "bytes")))
    return joined.groupBy("key").agg(
        F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["bytes"])).alias("bytes")
    )


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    done = encode(docs, path)
    return done.select(
        "row.doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
