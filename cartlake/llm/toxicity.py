"""Toxicity by a weighted lexicon, found with an Aho-Corasick automaton in folded text.

Folding lower-cases, maps homoglyphs and digit substitutions to one letter each, and leaves
words between single spaces; l, i, 1 and | become one letter. A text with accents is read
twice, with and without them, and the reading that finds more counts.
The lexicon is learned from labelled rows: beginnings of words and whole words, weighted
by the log odds of toxic over other documents. Exception phrases blank the words that they cover.
The sum of weights, and the sum by length, go through a logistic curve. The least log odds of a
term are chosen by cross-validation inside the labelled rows that may be learned from, and the
curve is fitted to what lexicons of the other folds find in a row.

Bounds, all parameters: ``ROWS`` labelled rows without copies (those of least hash) fit the lexicon and the
curve, ``TERMS`` is the length of the lexicon. Scoring reads every text in full.
"""

from __future__ import annotations

import functools
import logging
import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.llm import blocks as B
from cartlake.session import stage

log = logging.getLogger(__name__)

ROWS, TERMS, LEAST = 20_000, 3_000, 8
#: The least log odds of a term that are tried, and the folds of the trial.
ODDS, FOLDS = (1.5, 2.0, 2.5, 3.0), 4
THRESHOLD = 0.3
#: Copies among labelled rows: least hashes kept of a text, classes of them, likeness of a copy.
SKETCH, CLASSES, COPY = 64, 8, 0.8
PREFIXES = range(3, 9)
#: Harmless phrases; each blanks the lexicon words inside it.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "pond scum", "stupid question", "idiot proof")
#: Letters that look like, or stand for, another.
LOOKALIKES = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "l": "i", "|": "i",
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "ո": "n", "ս": "u",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ß": "ss", "ø": "o", "ł": "i", "đ": "d", "æ": "ae", "œ": "oe", "ı": "i",
}


@functools.cache
def folding(accents: bool) -> dict[int, str]:
    """Code points of Latin, Greek, Cyrillic and full-width letters, and ASCII, by rule."""
    table = {}
    for code in [*range(0x250), *range(0x370, 0x590), *range(0x2000, 0x2070), *range(0x3000, 0x3003), *range(0xFF01, 0xFF5F)]:
        parts = unicodedata.normalize("NFKC" if accents else "NFKD", chr(code)).lower()
        plain = "".join(LOOKALIKES.get(c, c) for c in parts if not unicodedata.combining(c))
        plain = "".join(c if c.isalpha() else " " for c in plain)
        table[code] = "" if code in (0xAD, *range(0x200B, 0x2010)) else plain or " "
    for code in range(0x300, 0x370):
        table[code] = ""
    return table


def fold(text: str, accents: bool = False) -> str:
    """Words of folded letters, with one space before, between and after them."""
    if accents:
        text = unicodedata.normalize("NFC", text)
    return f" {' '.join(text.lower().translate(folding(accents)).split())} "


def readings(text: str) -> list[str]:
    return [fold(text)] if text.isascii() else [fold(text), fold(text, True)]


@dataclass
class Lexicon:
    """terms: " word " or " beginning" to weight; curve: three coefficients of the logistic;
    rows: the number of labelled rows that it was fitted to."""

    terms: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (-3.0, 1.0, 0.0)
    automaton: object = field(default=None, repr=False, compare=False)
    rows: int = 0

    def __getstate__(self):
        return {"terms": self.terms, "exceptions": self.exceptions, "curve": self.curve, "automaton": None, "rows": self.rows}

    def found(self, folded: str) -> float:
        """The sum of weights: of each word its longest term, unless an exception covers it."""
        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for phrase in self.exceptions:
                self.automaton.add_word(term := fold(phrase), (len(term), None))
            for term, weight in self.terms.items():
                self.automaton.add_word(term, (len(term), weight))
            if len(self.automaton):
                self.automaton.make_automaton()
        if not len(self.automaton):
            return 0.0
        best: dict[int, tuple[int, float]] = {}
        blank = []
        for end, (size, weight) in self.automaton.iter(folded):
            start = end - size + 1
            if weight is None:
                blank.append((start, end))
            elif size > best.get(start, (0, 0.0))[0]:
                best[start] = (size, weight)
        for a, b in blank:
            for start in [s for s in best if a <= s < b]:
                del best[start]
        return sum(w for _, w in best.values())

    def measures(self, text: str) -> tuple[float, float]:
        read = readings(text)
        total = max(map(self.found, read))
        return math.log1p(total), math.log1p(100 * total / (read[0].count(" ") + 20))

    def score(self, text: str) -> float:
        a, b, c = self.curve
        x, y = self.measures(text)
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, a + b * x + c * y))))


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def sketch(text: F.Column) -> F.Column:
    """The ``SKETCH`` least hashes of a text's distinct runs of three words (shorter: of the text)."""
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    # A lambda that named the words would split the text again for every word.
    second, third = (F.slice(words, k, F.greatest(F.size(words), F.lit(1))) for k in (2, 3))
    two = F.zip_with(words, second, lambda u, v: F.struct(u.alias("u"), v.alias("v")))
    three = F.zip_with(two, third, lambda x, w: F.struct(x["u"].alias("u"), x["v"].alias("v"), w.alias("w")))
    runs = F.transform(three, lambda x, i: F.when((i == 0) | x["w"].isNotNull(), F.xxhash64(x["u"], x["v"], x["w"])))
    return F.slice(F.array_sort(F.array_distinct(F.filter(runs, lambda h: h.isNotNull()))), 1, SKETCH)


def alike(a: F.Column, b: F.Column) -> F.Column:
    """The share of common runs, estimated from the least hashes of both sketches together."""
    least = F.slice(F.array_sort(F.array_union(a, b)), 1, SKETCH)
    return F.size(F.array_intersect(F.array_intersect(a, b), least)) / F.size(least)


def without_copies(rows: DataFrame) -> DataFrame:
    """(doc_id, digest, toxic) of ``rows`` (with print, a sketch, too), less the copies.

    Of equal texts with one label the row of least hash stays. A row also goes if it is alike
    (``COPY``) to the first row of one of its buckets; a bucket has equal least hashes in two of
    ``CLASSES`` classes of hashes. The bucket alone drops nothing.
    """
    first = F.struct(F.xxhash64("doc_id").alias("place"), F.col("doc_id").alias("id"), "digest", "print")
    one = rows.groupBy("digest", "toxic").agg(F.min(first).alias("one"))
    one = stage(one.select("toxic", "one"), "distinct-labelled")
    least = [F.array_min(F.filter("one.print", lambda h, c=c: F.pmod(h, F.lit(CLASSES)) == c)) for c in range(CLASSES)]
    pairs = [(a, b, c) for c, (a, b) in enumerate(zip(least, least[1:] + least[:1]))]
    keys = F.array(*[F.when(a.isNotNull() & b.isNotNull(), F.xxhash64(F.lit(c), a, b)) for a, b, c in pairs])
    dealt = one.withColumn("key", F.explode(F.filter(keys, lambda k: k.isNotNull())))
    heads = dealt.groupBy("key", "toxic").agg(F.min("one").alias("head"), F.count("*").alias("members")).filter("members > 1")
    gone = (
        dealt.join(heads, ["key", "toxic"]).filter("one.digest <> head.digest")
        .filter(alike(F.col("one.print"), F.col("head.print")) >= COPY).select("one.digest", "toxic").distinct()
    )
    kept = one.select("one.digest", "toxic", F.col("one.id").alias("doc_id"))
    return kept.join(gone, ["digest", "toxic"], "left_anti")


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """(text, toxic) of ``rows`` labelled rows at most that are not held out.

    Copies would make every word of a toxic text look toxic, so of copies with one label only
    one is taken; they go before the rows are counted.
    """
    known = (
        labels.filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    texts = docs.select("doc_id", F.coalesce(F.make_valid_utf8("text"), F.lit("")).alias("text"))
    labelled = texts.join(known, "doc_id").select("doc_id", "toxic", F.sha2("text", 256).alias("digest"), sketch(F.col("text")).alias("print"))
    picked = without_copies(labelled).orderBy(F.xxhash64("doc_id"), "doc_id", "digest").limit(rows)
    found = texts.join(F.broadcast(picked), "doc_id").filter(F.sha2("text", 256) == F.col("digest"))
    return found.dropDuplicates(["digest", "toxic"]).select("text", "toxic")


def term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per term the other and the toxic documents that have it, by fold."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, toxic, fold in zip(batch["text"], batch["toxic"], batch["fold"]):
            words = {w for read in readings(text) for w in read.split()}
            terms = {f" {w} " for w in words}
            terms.update(f" {w[:n]}" for w in words for n in PREFIXES if len(w) >= n)
            for term in terms:
                counts.setdefault(term, np.zeros((2, FOLDS), np.int32))[int(toxic == 1), fold] += 1
    yield pd.DataFrame({"term": list(counts), **{n: [int(c[y, f]) for c in counts.values()] for n, y, f in count_columns()}})


def count_columns() -> list[tuple[str, int, int]]:
    return [(f"n{y}{f}", y, f) for y in (0, 1) for f in range(FOLDS)]


def weighed(found: list[tuple[str, np.ndarray]], size: np.ndarray, least: float, terms: int) -> dict[str, float]:
    """The lexicon of terms with these other and toxic documents, of as many in all as ``size`` says."""
    rows = []
    for term, (other, toxic) in found:
        weight = math.log((toxic + 1) / (size[1] + 2)) - math.log((other + 1) / (size[0] + 2))
        if toxic >= LEAST and weight >= least:
            rows.append((term, weight, int(toxic)))
    rows.sort(key=lambda r: (-r[1] * r[2], r[0]))
    return telling(rows[:terms])


def telling(rows: list[tuple[str, float, int]]) -> dict[str, float]:
    """The terms (term, weight, toxic documents) to keep: not a beginning that nearly always
    goes on in one way, nor a longer term that a shorter one, about as telling, already finds."""
    count = {term: toxic for term, _, toxic in rows}
    least = min(PREFIXES) + 1
    goes_on = {t[:n] for t in count for n in range(least, len(t)) if count[t] >= 0.9 * count.get(t[:n], math.inf)}
    kept: dict[str, float] = {}
    for term, weight, _ in sorted((r for r in rows if r[0] not in goes_on), key=lambda r: (len(r[0]), r[0])):
        if not any(kept.get(term[:n], -1.0) >= weight - 1.0 for n in range(least, len(term))):
            kept[term] = weight
    return kept


def fit_curve(x: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression of two measures, by Newton steps with a small ridge."""
    design, beta = np.column_stack([np.ones(len(x)), x]), np.zeros(3)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        ridge = np.diag([1e-3, 0.05, 0.05])
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + ridge
        beta += np.linalg.solve(hessian, design.T @ (toxic - p) - ridge @ beta)
    return tuple(float(b) for b in beta)


def learn(docs: DataFrame, labels: DataFrame, rows: int = ROWS, terms: int = TERMS, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold")
    sample = stage(training_rows(docs, labels, rows).select("text", "toxic", fold), "toxic-sample")
    size = np.zeros((2, FOLDS))
    for toxic, f, n in sample.groupBy((F.col("toxic") == 1).cast("int").alias("y"), "fold").count().collect():
        size[toxic, f] = n
    if not size.sum(axis=1).all():
        return Lexicon({}, exceptions, rows=int(size.sum()))
    names = [n for n, _, _ in count_columns()]
    toxic, other = (sum(F.col(n) for n, label, _ in count_columns() if label == y) for y in (1, 0))
    odds = F.log((toxic + 1) / F.lit(float(size[1].sum() + 2))) - F.log((other + 1) / F.lit(float(size[0].sum() + 2)))
    # A little below the least odds: without one fold, a term's odds can be higher.
    counted = (
        sample.mapInPandas(term_counts, f"term string, {', '.join(f'{n} long' for n in names)}")
        .groupBy("term").agg(*[F.sum(n).alias(n) for n in names])
        .withColumn("weight", odds).filter((toxic >= LEAST) & (F.col("weight") >= min(ODDS) - 0.5))
        .orderBy(F.desc(F.col("weight") * toxic), "term").limit(4 * terms).collect()
    )
    found = [(r["term"], np.array([r[n] for n in names]).reshape(2, FOLDS)) for r in counted]

    def without(f: int | None, least: float) -> Lexicon:
        rest = [g for g in range(FOLDS) if g != f]
        return Lexicon(weighed([(t, c[:, rest].sum(axis=1)) for t, c in found], size[:, rest].sum(axis=1), least, terms), exceptions)

    tried = [[without(f, least) for f in range(FOLDS)] for least in ODDS]

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = [[v for folds in tried for v in folds[f].measures(t)] for t, f in zip(batch["text"], batch["fold"])]
            yield pd.DataFrame({"x": x, "toxic": (batch["toxic"] == 1).astype(float)})

    # The sample is bounded; sorted, so that sums do not depend on the order of tasks.
    measured = sorted((r["toxic"], tuple(r["x"])) for r in sample.mapInPandas(measure, "x array<double>, toxic double").collect())
    y, x = np.array([r[0] for r in measured]), np.array([r[1] for r in measured]).reshape(len(measured), len(ODDS), 2)
    curves = [fit_curve(x[:, i], y) for i in range(len(ODDS))]
    losses = [log_loss(curve, x[:, i], y) for i, curve in enumerate(curves)]
    best = min(range(len(ODDS)), key=lambda i: (round(losses[i], 6), i))
    lexicon = without(None, ODDS[best])
    lexicon.curve, lexicon.rows = curves[best], int(size.sum())
    log.info("lexicon fitted to %d labelled rows, %d of them toxic; losses by least odds: %s", lexicon.rows, size[1].sum(), dict(zip(ODDS, losses)))
    return lexicon


def log_loss(curve: tuple[float, float, float], x: np.ndarray, y: np.ndarray) -> float:
    z = np.clip(curve[0] + x @ np.array(curve[1:]), -30, 30)
    return float(np.mean(np.logaddexp(0, z) - y * z))


def scores(docs: DataFrame, lexicon: Lexicon, keep: list[str] | None = None) -> DataFrame:
    """Per row: ``row`` (the kept columns, doc_id by default) and ``score`` from 0 to 1.

    Empty and null texts get the score of no hit; bytes that are no UTF-8 fit no term. Repeated rows each give a row; an empty
    table gives an empty result. Labels, lang, source and doc_id do not enter the score.
    A lexicon learned without labels of both kinds is empty and finds nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.record_batch([batch.column("row"), pa.array([lexicon.score(t.decode(errors="replace")) for t in texts], pa.float64())], names=["row", "score"])

    rows = B.with_text(docs, keep)
    return rows.mapInArrow(run, rows.select("row", F.lit(0.0).alias("score")).schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = scores(docs, learn(docs, labels)).select("row.doc_id", "score")
    return scored.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
