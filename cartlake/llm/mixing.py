"""Mixing documents to target weights of domains that are only known softly.

1. A classifier (softmax regression on hashed beginnings of words) learns the domains from a
   labelled table: a bounded sample of ``ROWS`` labelled rows, those of least hash.
2. Every document gets its posterior over the domains and its number of tokens. With rate
   r_d, document d counts r_d * tokens_d * posterior_dk tokens of domain k.
3. Nonnegative rates come from least squares: the squared distance of the expected totals from
   the targets, by projected gradients from rate 1. Totals are measured by the inverse of the
   domains' token products over the documents above the floor, so a step of length 1 lands on the
   targets but for what the floor cuts off, and a few steps reach them. A step needs one set of
   sums over all documents; a document's rate follows from the gradients so far, so no state is
   kept and a lost task is just redone.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.llm import blocks as B
from cartlake.session import stage

log = logging.getLogger(__name__)

ROWS, BUCKETS = 6_000, 2048
#: Bytes of a word that count. Texts in a call to the classifier.
BEGINNING, TEXTS = 5, 256
#: Steps end when every domain is this near its target, or after ``PATIENCE`` steps that come no nearer.
NEAR, PATIENCE = 0.002, 8
#: Wanted shares of tokens.
DOMAINS = ("poor", "good", "toxic")
TARGETS = {"poor": 0.1, "good": 0.88, "toxic": 0.02}
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
ODD = np.uint64(0x9E3779B97F4A7C15)
#: Bytes as the classifier reads them: lower case, digits and signs as the letters they stand for.
READ_AS = np.arange(256)
READ_AS[65:91] += 32
READ_AS[list(b"013457@$l|")] = list(b"oieastasii")


def domain_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, domain): 2 toxic, else 1 good, else 0 poor; rows with a null are left out, and
    of several labels of a document the greatest counts."""
    known = labels.filter("doc_id is not null and quality is not null and toxic is not null")
    return known.groupBy("doc_id").agg(F.max(F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 1).otherwise(0)).alias("domain"))


def word_buckets(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every word of the texts: the text's ordinal, and the bucket of its beginning."""
    ends = np.cumsum(lengths)
    first = np.zeros(len(data) + 1, bool)
    first[(ends - lengths)] = True
    space = SPACES[data]
    begin = ~space
    begin[1:] &= space[:-1] | first[1:-1]
    start = np.flatnonzero(begin)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.arange(len(data), dtype=np.int64) - start[np.maximum(np.cumsum(begin) - 1, 0)]
    value = (READ_AS[data].astype(np.uint64) + np.uint64(1)) * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * ODD
    value ^= value >> np.uint64(29)
    value[space | (place >= BEGINNING)] = 0
    word = np.add.reduceat(value, start) * ODD
    return np.searchsorted(ends, start, side="right"), ((word >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int64)


def features(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: square roots of the shares of word buckets and of byte values, and the number of words."""
    n = len(lengths)
    owner, bucket = word_buckets(data, lengths)
    count = np.bincount(owner * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS)
    byte_owner = np.repeat(np.arange(n), lengths)
    byte = np.bincount(byte_owner * 256 + data, minlength=n * 256).reshape(n, 256)
    tokens = count.sum(axis=1)
    parts = [np.sqrt(c / np.maximum(1, c.sum(axis=1, keepdims=True))) for c in (count, byte)]
    return np.hstack([*parts, np.ones((n, 1))]).astype(np.float32), tokens


@dataclass
class Classifier:
    weights: np.ndarray

    def posterior(self, x: np.ndarray) -> np.ndarray:
        z = (x @ self.weights).astype(np.float64)
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def fit(x: np.ndarray, domain: np.ndarray, domains: int, rounds: int = 150) -> Classifier:
    """Softmax regression by full-batch Adam steps from zero, with a small ridge."""
    weights = np.zeros((x.shape[1], domains), np.float32)
    wanted = np.eye(domains, dtype=np.float32)[domain]
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, rounds + 1):
        p = Classifier(weights).posterior(x).astype(np.float32)
        g = x.T @ (p - wanted) / len(x) + 1e-4 * weights
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        weights -= 0.3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
    return Classifier(weights)


def learn(docs: DataFrame, labelled: DataFrame, domains: int, rows: int = ROWS) -> Classifier:
    """From ``rows`` labelled documents at most; without any, every domain is as likely."""
    picked = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text")).join(F.broadcast(picked), "doc_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in B.pieces(whole, 1 << 20):
                x = np.concatenate([features(*B.flat(batch.column("text").slice(at, TEXTS)))[0] for at in range(0, batch.num_rows, TEXTS)])
                yield pa.record_batch(
                    [batch.column("doc_id"), batch.column("domain"), pa.array([r.tobytes() for r in x.astype(np.float16)], pa.binary())],
                    names=["doc_id", "domain", "x"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = sample.select("doc_id", F.col("domain").cast("int").alias("domain"), "text").mapInArrow(measure, f"doc_id {kind}, domain int, x binary")
    got = got.orderBy("doc_id", "x").limit(2 * rows).toPandas()
    if got.empty:
        return Classifier(np.zeros((BUCKETS + 257, domains), np.float32))
    x = np.frombuffer(b"".join(got["x"]), np.float16).reshape(len(got), -1).astype(np.float32)
    return fit(x, got["domain"].to_numpy(), domains)


def memberships(docs: DataFrame, classifier: Classifier, keep: list[str] | None = None) -> DataFrame:
    """Per row: ``row`` (the kept columns), n_tokens (words between ASCII white space) and
    ``posterior``, an array over the domains. Null texts are empty and have no tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in B.pieces(whole, 1 << 20):
                for at in range(0, batch.num_rows, TEXTS):
                    part = batch.slice(at, TEXTS)
                    x, tokens = features(*B.flat(part.column("text")))
                    p = classifier.posterior(x)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * p.shape[1], pa.int32()), pa.array(p.ravel()))
                    yield pa.record_batch([part.column("row"), pa.array(tokens, pa.int64()), lists], names=["row", "n_tokens", "posterior"])

    rows = B.with_text(docs, keep)
    schema = rows.select("row", F.lit(0).cast("long").alias("n_tokens"), F.array(F.lit(0.0)).alias("posterior")).schema
    return rows.mapInArrow(run, schema)


def rate(gradients: list[list[float]], floor: float) -> Column:
    """A document's rate after all steps so far, from its posterior alone.

    Every step moves it against the gradient and back above ``floor``."""
    start = F.lit(max(1.0, floor))
    if not gradients:
        return start

    def move(r: Column, g: Column) -> Column:
        pull = F.aggregate(F.zip_with("posterior", g, lambda p, x: p * x), F.lit(0.0), lambda a, x: a + x)
        return F.greatest(F.lit(floor), r - pull)

    return F.aggregate(F.array(*[F.array(*map(F.lit, g)) for g in gradients]), start, move)


def sums(members: DataFrame, now: Column, domains: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens by domain at rates ``now``, and the tokens' products by pairs of domains
    over the documents above the floor (all of them at the first step)."""
    at = [F.get("posterior", F.lit(i)) for i in range(domains)]
    pairs = [(i, j) for i in range(domains) for j in range(i, domains)]
    free = F.when((F.col("r") > floor) | (F.col("r") == max(1.0, floor)), F.col("n_tokens")).otherwise(0)
    row = members.withColumn("r", now).agg(
        *[F.sum(F.col("r") * F.col("n_tokens") * p) for p in at], *[F.sum(free * at[i] * at[j]) for i, j in pairs]
    ).first()
    totals = np.array([x or 0.0 for x in row[:domains]])
    products = np.zeros((domains, domains))
    for (i, j), value in zip(pairs, row[domains:]):
        products[i, j] = products[j, i] = value or 0.0
    return totals, products


def mix(
    members: DataFrame, targets: list[float], floor: float = 0.0, growth: float | None = 1.0, most: float = 1.5,
) -> tuple[DataFrame, list[float], list[float]]:
    """``members`` with ``rate`` and ``copies``, the wanted tokens and the expected ones by domain.

    ``targets``: shares of ``growth`` times all tokens; they must be positive and sum to 1. A
    growth of None is the least that lowers no domain, ``most`` at most. No rate goes below
    ``floor``. Where no rates meet the targets (a floor that keeps a domain over its target, a
    domain that no document has enough of), the nearest mix of all steps is taken, and a
    warning names the domains' distances. ``copies`` is the rate rounded up or down by a hash
    of the row's place in the written table, so repeated rows round independently and the mean
    of copies is the rate. A table without tokens keeps rate 1, or ``floor``.
    """
    if abs(sum(targets) - 1) > 1e-6 or min(targets) <= 0:
        raise ValueError("targets must be positive shares that sum to 1")
    k = len(targets)
    members = stage(members, "memberships")
    have, _ = sums(members, F.lit(1.0), k, floor)
    total = have.sum()
    if not total:
        even = members.withColumn("rate", F.lit(max(1.0, floor))).withColumn("copies", F.ceil("rate").cast("int"))
        return even, [0.0] * k, [0.0] * k
    shares = np.array(targets)
    if growth is None:
        growth = min(most, max(1.0, float((have / total / shares).max())))
    wanted = growth * total * shares
    gradients: list[list[float]] = []
    best: tuple[float, int, np.ndarray] | None = None
    length, last = 1.0, np.inf
    while True:
        totals, products = sums(members, rate(gradients, floor), k, floor)
        off = (totals - wanted) / wanted
        worst = float(np.abs(off).max())
        if best is None or worst < best[0]:
            best = worst, len(gradients), totals
        if worst <= NEAR or len(gradients) - best[1] >= PATIENCE:
            break
        # A step that overshot is followed by shorter ones.
        length = min(1.0, 2 * length) if worst < last else length / 2
        last = worst
        metric = products + 1e-9 * max(np.trace(products), 1e-9 * total) * np.eye(k)
        gradients.append([float(g) for g in length * np.linalg.solve(metric, totals - wanted)])
    worst, steps, totals = best
    log.info("rates after %d steps, at most %.4f off the targets", steps, worst)
    if worst > NEAR:
        log.warning("no mix on the targets was found: with rates from %s on the expected tokens of the domains are off by %s", floor, np.round((totals - wanted) / wanted, 4).tolist())
    place = (F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1), F.col("_metadata.row_index"))
    salt = F.pmod(F.xxhash64(*place), F.lit(1 << 30)) / float(1 << 30)
    done = members.withColumn("salt", salt).withColumn("rate", rate(gradients[:steps], floor))
    return done.withColumn("copies", F.floor(F.col("rate") + F.col("salt")).cast("int")).drop("salt"), wanted.tolist(), totals.tolist()


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, floor: float = 0.0) -> DataFrame:
    """Per row: doc_id, n_tokens, a posterior column for each domain, rate, copies and, the same in
    all rows, ``off``: by domain the expected tokens over the wanted ones, less 1.

    Repeated rows, and rows without doc_id, each give a row; an empty table gives an empty
    result; other columns are not read.
    """
    targets = targets or TARGETS
    classifier = learn(docs, domain_labels(labels), len(DOMAINS))
    done, wanted, totals = mix(memberships(docs, classifier), [targets[d] for d in DOMAINS], floor)
    off = [F.lit(t / w - 1 if w else 0.0).alias(d) for d, w, t in zip(DOMAINS, wanted, totals)]
    return done.select(
        "row.doc_id", "n_tokens", *[F.get("posterior", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(DOMAINS)], "rate", "copies",
        F.struct(*off).alias("off"),
    )


def resampled(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, floor: float = 1.0, growth: float | None = None,
) -> DataFrame:
    """The documents themselves, each as often as its copies say."""
    targets = targets or TARGETS
    classifier = learn(docs, domain_labels(labels), len(DOMAINS))
    names = docs.columns
    whole = B.free_name(names, "_text")
    members = memberships(docs.withColumn(whole, F.col("text")), classifier, [c for c in names if c != "text"] + [whole])
    done, _, _ = mix(members, [targets[d] for d in DOMAINS], floor, growth)
    repeated = done.withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1))))) if floor >= 1 else (
        done.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    )
    return repeated.select(*[F.col(f"row.{whole}").alias("text") if c == "text" else F.col(f"row.{c}") for c in names])
