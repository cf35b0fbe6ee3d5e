"""Near-duplicates by SimHash: fingerprints within a Hamming distance, by vantage-point trees.

Equal fingerprints are merged first. A tree over the distinct ones is planted from a
bounded sample: a node has a vantage point and a radius, points within the radius go to
one side and the rest to the other. Its leaves are the shards. A point has one home shard,
and asks every shard that its ball may reach: by the triangle inequality a side can only
hold neighbours if the point's distance to the vantage point is within the radius give or
take ``distance``. In a shard the tree goes on by the same rule, down to small leaves that
are compared exactly. A shard reports each point's least connected partner, not its pairs, so
a group of near copies gives as many links as it has members.

The shards that a point asks multiply by about 1.55 a level while the shards double, which
is the price of a radius of 3 on 64 bits: work grows as the number of distinct
fingerprints to the power 1.6.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.llm import blocks as B
from cartlake.llm.components import components
from cartlake.session import stage

SHINGLE, SEED, DISTANCE = 3, 42, 3
SHARD_POINTS = 4096
#: Fingerprints that the upper tree is planted from, and its depth, at most.
SAMPLE, DEPTH = 40_000, 12
LEAF, PAIRS = 48, 1 << 21


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> list[int]:
    words = text.lower().split()  # bytes: only A-Z, and ASCII white space
    if not words:
        return []
    if len(words) < shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(size) - 1
    starts = ends - size + 1
    return [digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())]


def majority(hashes: list[int]) -> int:
    """A bit is 1 if it is in over half the hashes."""
    if not hashes:
        return 0
    value, total = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), np.zeros(64, np.int64)
    for at in range(0, len(value), 1 << 14):
        total += np.unpackbits(value[at : at + (1 << 14)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * total > len(value), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Per document: ``row`` (the kept columns) and ``fp``, the 64 bits as a signed long."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, lengths = B.flat(batch.column("text"))
            raw, at, out = data.tobytes(), 0, []
            for n in lengths.tolist():
                out.append(majority(shingle_hashes(raw[at : at + n])))
                at += n
            yield pa.record_batch([batch.column("row"), pa.array(out, pa.int64())], names=["row", "fp"])

    rows = B.with_text(docs, keep)
    return rows.mapInArrow(make, rows.select("row", F.lit(0).cast("long").alias("fp")).schema)


def far(points: np.ndarray, other: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ other).astype(np.int16)


def plant(sample: np.ndarray, depth: int) -> list[tuple[int, int, int, int]]:
    """Nodes (vantage point, radius, near child, far child); a child below 0 is shard -1 - child."""
    nodes: list[tuple[int, int, int, int]] = []
    shards = 0

    def grow(points: np.ndarray, left: int) -> int:
        nonlocal shards
        if left == 0 or len(points) < 4:
            shards += 1
            return -shards
        away = far(points, points[0])
        radius = int(np.median(away))
        place = len(nodes)
        nodes.append((0, 0, 0, 0))
        near = grow(points[away <= radius][1:], left - 1)
        beyond = grow(points[away > radius], left - 1)
        nodes[place] = (int(points[0]), radius, near, beyond)
        return place

    root = grow(sample, depth)
    return nodes if root >= 0 else []


def route(nodes: list[tuple[int, int, int, int]], points: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray]]:
    """Shards and the places of the points that belong (reach 0) or must ask there."""
    if not nodes:
        yield 0, np.arange(len(points))
        return
    todo = [(0, np.arange(len(points)))]
    while todo:
        node, place = todo.pop()
        if not len(place):
            continue
        if node < 0:
            yield -1 - node, place
            continue
        vantage, radius, near, beyond = nodes[node]
        away = far(points[place], np.uint64(vantage))
        todo.append((near, place[away - reach <= radius]))
        todo.append((beyond, place[away + reach > radius]))


def united(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links a-b: each the least label that it can reach."""
    while True:
        least = np.minimum(label[a], label[b])
        if (label[a] == least).all() and (label[b] == least).all():
            return label
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        while (nxt := label[label]).tobytes() != label.tobytes():
            label = nxt


def near_links(points: np.ndarray, home: np.ndarray, ask: np.ndarray, distance: int) -> np.ndarray:
    """Labels of ``points`` after linking what is near: home (places that are held here)
    and ask (places that may have neighbours here)."""
    label = np.arange(len(points))
    todo = [(home, ask)]
    while todo:
        held, asking = todo.pop()
        if not len(held) or not len(asking):
            continue
        if len(held) > LEAF:
            vantage = points[held[0]]
            to_held, to_asking = far(points[held], vantage), far(points[asking], vantage)
            radius = np.median(to_held)
            inside = to_held <= radius
            if not inside.all():
                todo.append((held[inside], asking[to_asking - distance <= radius]))
                todo.append((held[~inside], asking[to_asking + distance > radius]))
                continue
        step = max(1, PAIRS // len(held))
        for at in range(0, len(asking), step):
            part = asking[at : at + step]
            close = np.bitwise_count(points[part][:, None] ^ points[held][None, :]) <= distance
            a, b = np.nonzero(close)
            a, b = part[a], held[b]
            apart = a != b
            if apart.any():
                label = united(label, a[apart], b[apart])
    return label


LINKS = "a long, b long"


def links(prints: DataFrame, distance: int = DISTANCE, shard_points: int = SHARD_POINTS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that join every two within ``distance``."""
    count = prints.count()
    depth = min(DEPTH, max(0, math.ceil(math.log2(max(1, count) / shard_points))))
    sample = prints.orderBy(F.xxhash64("fp", F.lit("sample")), "fp").limit(SAMPLE).toPandas()["fp"] if depth else []
    nodes = plant(np.array(sample, np.int64).view(np.uint64), depth)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            points = fp.view(np.uint64)
            for held, reach in ((True, 0), (False, distance)):
                for shard, place in route(nodes, points, reach):
                    yield pa.record_batch(
                        [pa.array(np.full(len(place), shard, np.int32)), pa.array(fp[place]), pa.array([held] * len(place))],
                        names=["shard", "fp", "held"],
                    )

    def compare(table: pa.Table) -> pa.Table:
        fp, held = table.column("fp").to_numpy(), table.column("held").to_numpy()
        points, place = np.unique(fp, return_inverse=True)
        label = near_links(points.view(np.uint64), np.unique(place[held]), np.unique(place[~held]), distance)
        linked = np.flatnonzero(label != np.arange(len(label)))
        return pa.table([pa.array(points[linked]), pa.array(points[label[linked]])], names=["a", "b"])

    return prints.select("fp").mapInArrow(send, "shard int, fp long, held boolean").groupBy("shard").applyInArrow(compare, LINKS)


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, keep: list[str] | None = None) -> DataFrame:
    """Per document: ``row`` (the kept columns, doc_id by default), fingerprint (16 lowercase
    hex digits) and component_id, the least doc_id reachable over links of ``distance`` bits.

    Words are split at ASCII white space after lower-casing A-Z; texts of one or two words
    are one shingle; empty and null texts have the fingerprint zero and link as any other.
    Rows that repeat, or share a doc_id, each give a row. Rows without doc_id give a row,
    take part in links, and never name a component; where no member has an id it is null.
    An empty table gives an empty result.
    """
    made = stage(fingerprints(docs, keep or ["doc_id"]), "fingerprints")
    distinct = made.groupBy("fp").agg(F.min("row.doc_id").alias("least"))
    distinct = stage(distinct, "distinct-fingerprints")
    found = components(links(distinct, distance))
    members = distinct.join(found.withColumnRenamed("a", "fp"), "fp", "left").withColumn("root", F.coalesce("b", "fp"))
    roots = members.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = members.join(roots, "root").select("fp", "component_id")
    return made.join(labels, "fp", "left").select(
        "row", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("row.doc_id", "fingerprint", "component_id")
