"""Nearest neighbours by cosine: a hierarchical navigable small-world graph per shard.

Equal vectors are indexed once, by their six least ids: five neighbours and the query
itself never need more. The distinct vectors are dealt to shards by hash, so a dense
region cannot fill one shard. A shard builds its graph in flat arrays of neighbour
numbers, one per level, and answers every query; the shards' best are merged, and scores
are computed in double precision from the original vectors.

Every query goes to every shard, so the work of asking grows as queries times shards; a
shard's time to ask grows as the logarithm of its size.
"""

from __future__ import annotations

from heapq import heappop, heappush, heapreplace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartlake.session import stage

SHARD_ROWS = 8192
LINKS, BUILD, SEARCH, TOP = 14, 72, 96, 5


class Graph:
    """Levels of flat neighbour arrays; level 0 has all points and twice the links."""

    def __init__(self, vectors: np.ndarray, links: int = LINKS, build: int = BUILD, seed: int = 7) -> None:
        self.vectors, self.links, self.build = vectors, links, build
        n = len(vectors)
        draw = np.random.default_rng(seed).random(n)
        self.top = np.minimum(8, (-np.log(np.maximum(draw, 1e-12)) / np.log(links)).astype(int))
        self.neighbours = [np.full((n, links * (2 if level == 0 else 1)), -1, np.int32) for level in range(int(self.top.max(initial=0)) + 1)]
        self.count = [np.zeros(n, np.int32) for _ in self.neighbours]
        self.seen = np.zeros(n, np.int32)
        self.stamp = 0
        self.entry = 0
        for i in range(1, n):
            self._insert(i)

    def _search(self, q: np.ndarray, starts: list[int], width: int, level: int) -> list[tuple[float, int]]:
        """The best ``width`` points found from ``starts``, as (similarity, point), in no order."""
        self.stamp += 1
        seen, stamp, table, count, vectors = self.seen, self.stamp, self.neighbours[level], self.count[level], self.vectors
        near = (vectors[starts] @ q).tolist()
        seen[starts] = stamp
        best, todo = [], []
        for s, i in zip(near, starts):
            heappush(best, (s, i))
            heappush(todo, (-s, i))
        while len(best) > width:
            heappop(best)
        while todo:
            s, i = heappop(todo)
            if -s < best[0][0] and len(best) >= width:
                break
            around = table[i, : count[i]]
            around = around[seen[around] != stamp]
            if not len(around):
                continue
            seen[around] = stamp
            for s, j in zip((vectors[around] @ q).tolist(), around.tolist()):
                if len(best) < width:
                    heappush(best, (s, j))
                    heappush(todo, (-s, j))
                elif s > best[0][0]:
                    heapreplace(best, (s, j))
                    heappush(todo, (-s, j))
        return best

    def _select(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours in different directions: nearer to the point than to one taken before; then the nearest of the rest."""
        found = sorted(found, key=lambda f: (-f[0], f[1]))
        if len(found) <= most:
            return [i for _, i in found]
        points = np.array([i for _, i in found])
        own = self.vectors[points]
        between = own @ own.T
        taken: list[int] = []
        spare: list[int] = []
        for k, (s, _) in enumerate(found):
            if len(taken) >= most:
                break
            if taken and between[k, taken].max() > s:
                spare.append(k)
            else:
                taken.append(k)
        taken += spare[: most - len(taken)]
        return points[taken].tolist()

    def _insert(self, i: int) -> None:
        q, level = self.vectors[i], int(self.top[i])
        entry = [self.entry]
        highest = int(self.top[self.entry])
        for at in range(highest, level, -1):
            entry = [max(self._search(q, entry, 1, at))[1]]
        for at in range(min(level, highest), -1, -1):
            found = self._search(q, entry, self.build, at)
            entry = [j for _, j in found]
            table, count = self.neighbours[at], self.count[at]
            chosen = self._select(found, self.links)
            table[i, : len(chosen)] = chosen
            count[i] = len(chosen)
            for j in chosen:
                if count[j] < table.shape[1]:
                    table[j, count[j]] = i
                    count[j] += 1
                else:
                    around = np.append(table[j], i)
                    kept = self._select(list(zip((self.vectors[around] @ self.vectors[j]).tolist(), around.tolist())), table.shape[1])
                    table[j, : len(kept)] = kept
                    count[j] = len(kept)
        if level > highest:
            self.entry = i

    def nearest(self, q: np.ndarray, top: int, width: int = SEARCH) -> list[int]:
        entry = [self.entry]
        for at in range(int(self.top[self.entry]), 0, -1):
            entry = [max(self._search(q, entry, 1, at))[1]]
        found = self._search(q, entry, max(width, top), 0)
        return [i for _, i in sorted(found, key=lambda f: (-f[0], f[1]))[:top]]


def usable(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, v): ids and vectors of doubles that are not null, not zero, and finite in every component."""
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = embeddings.filter("vec_id is not null").select("vec_id", F.col(vector).cast("array<double>").alias("v"))
    return rows.filter(F.col("v").isNotNull() & F.coalesce(good, F.lit(False)))


def unit(vectors: list) -> np.ndarray:
    v = np.array([np.asarray(x, np.float64) for x in vectors])
    v /= np.abs(v).max(axis=1, keepdims=True)  # so that no square overflows
    return (v / np.sqrt((v * v).sum(axis=1, keepdims=True))).astype(np.float32)


FOUND = "query_id long, key long, ids array<long>, score double"


def search(embeddings: DataFrame, queries: DataFrame, top: int = TOP, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """For each query (query_id, v): rank, vec_id and score of the ``top`` nearest found, the
    query's own id left out; ties go to the smaller id.

    ``embeddings``: vec_id and v, as ``usable`` gives them; vectors of another length than
    the query's are not compared. Ids are unique; a repeated row counts once. Fewer
    candidates give fewer rows, no candidates none; an empty table gives an empty result.
    """
    few = Window.partitionBy("key", "v").orderBy("vec_id")
    keyed = embeddings.select("vec_id", "v", F.xxhash64("v").alias("key")).distinct()
    least = keyed.withColumn("nth", F.row_number().over(few)).filter(F.col("nth") <= top + 1)
    points = stage(least.groupBy("key", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "vectors")
    shards = max(1, -(-points.count() // shard_rows))
    asked = stage(queries.select("query_id", "v"), "queries")
    spread = points.select(F.pmod("key", F.lit(shards)).cast("int").alias("shard"), "key", "v", "ids")
    every = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def answer(key: tuple, held: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        for size, part in held.groupby(held["v"].map(len)):
            mine = queries[queries["v"].map(len) == size]
            if mine.empty:
                continue
            part = part.sort_values("key", kind="stable").reset_index(drop=True)
            graph = Graph(unit(part["v"].tolist()))
            exact, raw = np.array(part["v"].tolist(), np.float64), np.array(mine["v"].tolist(), np.float64)
            for query_id, q, raw_q in zip(mine["query_id"], unit(mine["v"].tolist()), raw):
                for i in graph.nearest(q, top + 1):
                    score = cosine(raw_q, exact[i])
                    out.append((query_id, part["key"][i], part["ids"][i], score))
        return pd.DataFrame(out, columns=["query_id", "key", "ids", "score"])

    found = every.groupBy("shard")
    answers = spread.groupBy("shard").cogroup(found).applyInPandas(answer, FOUND)
    each = answers.select("query_id", F.explode("ids").alias("vec_id"), "score").filter("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """In double precision, each scaled by its largest component so that no square overflows."""
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


def digest(embeddings: DataFrame) -> DataFrame:
    """Queries: ids divisible by 50; candidates: every row but the query's own."""
    vectors = usable(embeddings)
    return search(vectors, vectors.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "v"))


#: The exact result from DuckDB; the tool measures recall against it.
EXACT_SQL = """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
SELECT query_id, rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS score,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(q.v, c.v) DESC, c.vec_id)::INTEGER AS rank
  FROM e q JOIN e c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
WHERE rank <= 5
"""
