"""Document quality by a regularised quadratic discriminant over transformed statistics.

Every text gives ``len(NAMES)`` numbers, each brought near a bell shape by a logarithm, a square
root of a share or a logit. Per class, their mean and covariance come from sums over all labelled
rows that may be learned from: Spark adds them up, and only the sums of the folds reach the
driver. A class's covariance is shrunk towards the common one, then towards a diagonal; both
shares are chosen by cross-validation over the same rows. The score is a logistic curve of the
difference of the classes' log densities (Mahalanobis distances by Cholesky factors, which are
made once and sent along), with a slope and a shift that the held-back folds fit.

Cases: null and empty texts have the statistics of no words and are scored like any other; each
repeated row gives a row; an empty table gives an empty result; other columns are not read. Of
several labels of a document the greatest counts; labels other than 0 and 1 are left out. If one
class has fewer than ``LEAST`` rows, every score is the share of label 1 (0.5 without any).
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.llm import blocks as B
from cartlake.session import stage

#: Folds of the cross-validation, and the fewest rows of a class to learn from.
FOLDS, LEAST = 4, 8
#: Shares of the common covariance, and of the diagonal, that are tried.
COMMON, DIAGONAL = (0.02, 0.1, 0.3, 0.6, 0.9), (0.001, 0.01, 0.05, 0.2)
THRESHOLD = 0.5
CHUNK = 1 << 20

NAMES = (
    "bytes", "words", "word_length", "letters", "beyond_ascii", "digits", "marks", "upper", "lines", "line_length",
    "new_words", "top_word", "new_lines", "new_pairs", "stopped_lines", "marked_words", "upper_words", "long_words",
    "byte_entropy", "packed", "rare_marks", "stops",
)


@functools.cache
def byte_kinds() -> dict[str, np.ndarray]:
    codes = np.arange(256)
    upper, lower = (codes >= 65) & (codes <= 90), (codes >= 97) & (codes <= 122)
    digits, beyond = (codes >= 48) & (codes <= 57), codes >= 128
    marks = (codes > 32) & (codes < 127) & ~(upper | lower | digits)
    stops = np.isin(codes, [ord(c) for c in ".,;:?!'\"-()"])
    return {"upper": upper, "lower": lower, "digits": digits, "beyond": beyond, "marks": marks, "rare": marks & ~stops, "stops": np.isin(codes, [ord(c) for c in ".!?"])}


def counts(text: bytes) -> np.ndarray:
    found = np.zeros(256, np.int64)
    for at in range(0, len(text), CHUNK):
        found += np.bincount(np.frombuffer(text, np.uint8, min(CHUNK, len(text) - at), at), minlength=256)
    return found


def packed_size(text: bytes) -> int:
    packer, size = zlib.compressobj(1), 0
    for at in range(0, len(text), CHUNK):
        size += len(packer.compress(text[at : at + CHUNK]))
    return size + len(packer.flush())


def root(part: float, whole: float) -> float:
    return math.sqrt(part / whole) if whole else 0.0


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one text, in the order of NAMES."""
    kinds, found = byte_kinds(), counts(text)
    total = {k: int(found[v].sum()) for k, v in kinds.items()}
    words = text.split()
    n, size = len(words), len(text)
    lines = [line for line in text.splitlines() if line.strip()]
    letters = total["upper"] + total["lower"] + total["beyond"]
    distinct: dict[bytes, int] = {}
    for w in words:
        distinct[w] = distinct.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:])))
    share = found[found > 0] / max(1, size)
    ends = b".,;:?!)\"'"
    tails = [w[-1] for w in words]
    marked = sum(1 for c in tails if c < 128 and kinds["marks"][c])
    return [
        math.log1p(size),
        math.log1p(n),
        math.log1p(sum(map(len, words)) / n) if n else 0.0,
        root(letters, size),
        root(total["beyond"], size),
        root(total["digits"], size),
        root(total["marks"], size),
        root(total["upper"], letters),
        math.log1p(len(lines)),
        math.log1p(n / len(lines)) if lines else 0.0,
        len(distinct) / n if n else 1.0,
        root(max(distinct.values(), default=0), n),
        len(set(lines)) / len(lines) if lines else 1.0,
        pairs / (n - 1) if n > 1 else 1.0,
        root(sum(1 for line in lines if line.rstrip()[-1] in b".!?"), len(lines)),
        root(marked, n),
        root(sum(1 for w in words if len(w) > 1 and w.isupper()), n),
        root(sum(1 for w in words if len(w) > 14), n),
        float(-(share * np.log2(share)).sum()),
        math.log((packed_size(text) + 20) / (size + 40)),
        root(total["rare"], size),
        root(total["stops"], n),
    ]


def measured(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the kept columns, doc_id by default) and ``x``, the statistics of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in B.pieces(whole):
                x = [statistics(t.as_buffer().to_pybytes()) for t in batch.column("text")]
                yield pa.record_batch([batch.column("row"), pa.array(x, pa.list_(pa.float64()))], names=["row", "x"])

    rows = B.with_text(docs, keep)
    return rows.mapInArrow(run, rows.select("row", F.array(F.lit(0.0)).alias("x")).schema)


# --- sums -------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def learned_from(found: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, fold, x) of all labelled rows that are not held out."""
    known = labels.filter("doc_id is not null and quality in (0, 1)").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("label"))
    fold = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(FOLDS)).cast("int").alias("fold")
    return found.select("row.doc_id", "x").join(known, "doc_id").select("label", fold, "x")


def sums(rows: DataFrame) -> dict[tuple[int, int], tuple[float, np.ndarray, np.ndarray]]:
    """By (fold, label): number, sum and sum of products of the statistics of all rows.

    A task gives one row per fold and label and entry; Spark adds them up, so the driver gets
    2 * FOLDS * (1 + d + d * d) numbers whatever the table's size."""
    d = len(NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            x = matrix(batch.column("x"))
            group = np.column_stack([batch.column("fold").to_numpy(), batch.column("label").to_numpy()])
            for fold, label in {tuple(g) for g in group.tolist()}:
                mine = x[(group == (fold, label)).all(axis=1)]
                entry = np.concatenate([[len(mine)], mine.sum(axis=0), (mine.T @ mine).ravel()])
                total[fold, label] = total.get((fold, label), 0) + entry
        for (fold, label), entry in total.items():
            yield pa.record_batch([pa.array([fold], pa.int32()), pa.array([label], pa.int32()), pa.array([entry.tolist()])], names=["fold", "label", "entry"])

    parts = rows.mapInArrow(run, "fold int, label int, entry array<double>")
    added = parts.select("fold", "label", F.posexplode("entry").alias("at", "value")).groupBy("fold", "label", "at").agg(F.sum("value").alias("value"))
    found: dict[tuple[int, int], np.ndarray] = {}
    for fold, label, at, value in added.collect():
        found.setdefault((fold, label), np.zeros(1 + d + d * d))[at] = value
    return {k: (v[0], v[1 : d + 1], v[d + 1 :].reshape(d, d)) for k, v in found.items()}


def matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), len(NAMES))


# --- model ------------------------------------------------------------------


@dataclass
class Discriminant:
    """Means, inverted Cholesky factors and constants of both classes; ``even``: the score of an
    empty model; ``curve``: shift and slope of the logistic curve."""

    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    constants: np.ndarray | None = None
    even: float = 0.5
    curve: tuple[float, float] = (0.0, 1.0)

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log density under label 1 less that under label 0, by the square root of the dimension."""
        density = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants):
            z = (x - mean) @ factor.T
            density.append(constant - 0.5 * (z * z).sum(axis=1))
        return (density[1] - density[0]) / math.sqrt(x.shape[1])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.even)
        a, b = self.curve
        # Far from both classes distances are huge; their logarithm orders them just as well.
        return 1 / (1 + np.exp(-np.clip(a + b * squash(self.margin(x)), -30, 30)))


def squash(margin: np.ndarray) -> np.ndarray:
    return np.arcsinh(margin)


Sums = dict[int, tuple[float, np.ndarray, np.ndarray]]


def add(parts: list[tuple[float, np.ndarray, np.ndarray]]) -> tuple[float, np.ndarray, np.ndarray]:
    return sum(p[0] for p in parts), sum(p[1] for p in parts), sum(p[2] for p in parts)


def discriminant(by_label: Sums, common: float, diagonal: float) -> Discriminant:
    n, means, spread = [], [], []
    for label in (0, 1):
        count, total, products = by_label[label]
        mean = total / count
        n.append(count)
        means.append(mean)
        spread.append(products / count - np.outer(mean, mean))
    pooled = (n[0] * spread[0] + n[1] * spread[1]) / (n[0] + n[1])
    # A floor for statistics that never vary.
    floor = 1e-4 + 1e-3 * np.diag(pooled)
    factors, constants = [], []
    for label in (0, 1):
        cov = (1 - common) * spread[label] + common * pooled
        cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(cov)) + np.diag(floor)
        lower = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(lower))
        constants.append(-np.log(np.diag(lower)).sum() + math.log(n[label] / (n[0] + n[1])))
    return Discriminant(np.array(means), np.array(factors), np.array(constants))


BINS = 200


def choose(rows: DataFrame, found: dict, grid: list[tuple[float, float]]) -> Discriminant:
    """The shares with the least cross-validated error, and the curve, from one pass over all rows.

    Each row is judged by the models of the other folds; margins are counted in ``BINS`` bins per
    model and label, which is all that the driver gets."""
    models = {}
    for fold in range(FOLDS):
        rest = {label: [v for (f, y), v in found.items() if y == label and f != fold] for label in (0, 1)}
        if all(rest.values()):
            models[fold] = [discriminant({label: add(v) for label, v in rest.items()}, *shares) for shares in grid]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(grid), 2, BINS), np.int64)
        for batch in batches:
            x, fold, label = matrix(batch.column("x")), batch.column("fold").to_numpy(), batch.column("label").to_numpy()
            for f, tried in models.items():
                mine = fold == f
                if mine.any():
                    for i, model in enumerate(tried):
                        at = np.clip(np.floor((squash(model.margin(x[mine])) + 10) * BINS / 20), 0, BINS - 1).astype(np.int64)
                        np.add.at(total[i], (label[mine], at), 1)
        i, label, at = np.nonzero(total)
        yield pa.record_batch([pa.array(v) for v in (i, label, at, total[i, label, at])], names=["model", "label", "at", "n"])

    counted = rows.mapInArrow(run, "model long, label long, at long, n long").groupBy("model", "label", "at").agg(F.sum("n").alias("n")).collect()
    table = np.zeros((len(grid), 2, BINS))
    for i, label, at, n in counted:
        table[i, label, at] = n
    middle = (np.arange(BINS) + 0.5) * 20 / BINS - 10
    fits = [fit_curve(middle, t) for t in table]
    best = min(range(len(grid)), key=lambda i: (round(fits[i][2], 6), i))
    model = discriminant({label: add([v for (_, y), v in found.items() if y == label]) for label in (0, 1)}, *grid[best])
    model.curve = fits[best][:2]
    return model


def fit_curve(x: np.ndarray, table: np.ndarray) -> tuple[float, float, float]:
    """Shift and slope of a logistic curve of counted margins, by Newton steps, and its mean log loss."""
    zeros, ones = table
    n = zeros + ones
    design, beta = np.column_stack([np.ones(len(x)), x]), np.array([0.0, 1.0])
    ridge = np.diag([1e-3, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (ones - n * p) - ridge @ beta
        beta = beta + np.linalg.solve(design.T @ (design * (n * p * (1 - p))[:, None]) + ridge, gradient).clip(-2, 2)
    p = np.clip(1 / (1 + np.exp(-np.clip(design @ beta, -30, 30))), 1e-9, 1 - 1e-9)
    loss = -(ones * np.log(p) + zeros * np.log(1 - p)).sum() / max(1.0, n.sum())
    return float(beta[0]), float(beta[1]), float(loss)


def learn(found: DataFrame, labels: DataFrame) -> Discriminant:
    """From the statistics of documents (a written table) and all labels that may be learned from."""
    rows = stage(learned_from(found, labels), "quality-rows")
    totals = sums(rows)
    number = [sum(v[0] for (_, y), v in totals.items() if y == label) for label in (0, 1)]
    if min(number) < LEAST:
        return Discriminant(even=number[1] / sum(number) if sum(number) else 0.5)
    return choose(rows, totals, [(c, d) for c in COMMON for d in DIAGONAL])


def scores(found: DataFrame, model: Discriminant) -> DataFrame:
    """``row`` and ``score``, from 0 to 1, of measured rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = model.score(matrix(batch.column("x"))) if batch.num_rows else np.zeros(0)
            yield pa.record_batch([batch.column("row"), pa.array(said, pa.float64())], names=["row", "score"])

    return found.mapInArrow(run, found.select("row", F.lit(0.0).alias("score")).schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = stage(measured(docs), "quality")
    scored = scores(found, learn(found, labels)).select("row.doc_id", "score")
    return scored.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
