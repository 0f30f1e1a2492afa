"""Toxicity score: a weighted lexicon, matched by Aho-Corasick after folding.

Folding lower-cases, strips accents of Latin look-alikes, maps homoglyphs and
digit substitutions to letters, and keeps only letters and single spaces, so
``1d!0t`` and Cyrillic look-alikes read as plain words.

Learning (labels of the training rows only, a bounded sample): terms are
whole folded words and word prefixes. A term's support is its number of
distinct contexts (word before, word, word after) in each class, so the same
passage in many copies counts once. A term enters the lexicon if its share of
toxic contexts is far above the base rate (log-likelihood ratio against the
number of terms tried); its weight is its log odds. Words that contain a term
but stand in a harmless phrase do not count: ``EXCEPTIONS``, and learned pairs of neighbouring words that
hold a term, occur in at least ``min_clean`` distinct contexts of clean training texts, and in no toxic one.
The weight found per text, also divided
by its length, goes through a logistic curve fitted on the same sample.

Bounds: at most ``sample`` training rows per class; of the terms found in them, the ``max_terms`` that stand out
most (a term beyond that adds nothing to a score). Pairs are as many as these rows hold.

Defined results: a null or empty text has no hits and gets the lowest score.
Without usable labels of both classes, as in empty tables, or with no term that stands out, the
lexicon is empty and every score is low: nothing is rejected. Equal rows score alike; terms that stand out equally
are taken in the order of their text; very long texts are matched in one pass over their folded form; other
columns, whatever their names but ``score``, are kept; doubled label rows count as toxic if any is.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fareway.llm.common import materialize, packed, small_batches, table, text_or_empty, unpacked

# Letters that look like Latin ones, and characters used in place of letters.
HOMOGLYPHS = dict(zip("авекмнорстухіјѕԁһԛԝγαοερτυικν", "abekmhopctyxijsdhqwyaoeptuikv", strict=True))
SUBSTITUTIONS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
                 "!": "i", "|": "i", "+": "t", "€": "e", "£": "l"}
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "clown car", "pond scum", "stupid question")


@lru_cache(1)
def _table() -> dict[int, str]:
    """Code point to folded text, for all characters that are not left as they are."""
    out: dict[int, str] = {}
    for c in range(0x20000):
        ch = chr(c)
        if 0xD800 <= c < 0xE000:
            continue
        base = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x)).lower()
        base = "".join(HOMOGLYPHS.get(x, x) for x in base)
        if unicodedata.combining(ch):
            base = ""
        elif not base.isalpha():
            base = " " if not base.isdecimal() else base
        if base != ch:
            out[c] = base
    return out


_SUB = re.compile(r"[013457890@$!|+€£](?=[^\s.,;:?!]*[^\W\d_])|(?<=[^\W\d_])[013457890@$!|+€£](?=[\w@$!|+€£])")


def fold(text: str) -> str:
    """Folded words, each between single spaces, with one space at either end."""
    if _SUB.search(text):
        text = _SUB.sub(lambda m: SUBSTITUTIONS.get(m[0], m[0]), text)
    return f" {' '.join(text.translate(_table()).split())} "


def sample_rows(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str, trained: Column,
                per_class: int) -> DataFrame:
    """``doc_id``, ``text``, ``label`` of the ``per_class`` training rows of each class with the smallest hashes of
    their text, each text once. Only ids and hashes of the other rows are shuffled; the picks, at most
    ``2 * per_class`` rows of three numbers, are broadcast back to the texts."""
    y = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(label).cast("int").alias("label")).filter(trained)
    keyed = docs.select("doc_id", F.xxhash64(text_or_empty()).alias("_o")).join(y, "doc_id")
    own = [keyed.filter(F.col("label") == v).groupBy("_o").agg(F.min("doc_id").alias("doc_id")).orderBy("_o").limit(
        per_class).withColumn("label", F.lit(v)) for v in (0, 1)]
    picks = materialize(spark, own[0].union(own[1]), f"{label}-picks")
    texts = docs.select("doc_id", text_or_empty().alias("text")).withColumn("_o", F.xxhash64("text"))
    # Rows equal in id and text count once, so the sample keeps its bound.
    return texts.join(F.broadcast(picks), ["doc_id", "_o"]).groupBy("doc_id", "_o", "label").agg(
        F.min("text").alias("text")).select("doc_id", "text", "label")


def _emit_terms(lengths: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            term, context, label = [], [], []
            for text, y in zip(b["text"].to_pylist(), b["label"].to_pylist(), strict=True):
                words = ["", *fold(text).split(), ""]
                for i in range(1, len(words) - 1):
                    w = words[i]
                    c = f"{words[i - 1]} {w} {words[i + 1]}"
                    own = [f" {w} "] + [f" {w[:n]}" for n in lengths if n <= len(w)]
                    term += own
                    context += [c] * len(own)
                    label += [y] * len(own)
            yield pa.RecordBatch.from_pydict({"term": term, "context": context, "label": pa.array(label, pa.int32())})

    return run


def learn_lexicon(sample: DataFrame, min_contexts: int = 4, max_terms: int = 2000,
                  lengths: tuple[int, ...] = (4, 5, 6)) -> dict[str, float]:
    """Folded term to weight. Whole words are `` word ``; prefixes are `` pre``."""
    terms = sample.select("text", "label").mapInArrow(_emit_terms(lengths), "term string, context string, label int")
    # Contexts as hashes: a term's distinct contexts are counted exactly up to 64-bit collisions.
    seen = terms.select("term", F.xxhash64("context").alias("context"), "label").distinct()
    counts = seen.groupBy("term").agg(F.sum(F.col("label")).alias("t"), F.sum(1 - F.col("label")).alias("c"))
    counts = materialize(sample.sparkSession, counts, "toxic-terms")
    total = counts.filter(F.col("term").endswith(" ")).agg(F.sum("t"), F.sum("c"), F.count("*")).first()
    if not total[0] or not total[1]:
        return {}
    base, tried = total[0] / (total[0] + total[1]), counts.count()
    q = F.col("t") / (F.col("t") + F.col("c"))
    gain = F.col("t") * F.log(q / base) + F.when(F.col("c") > 0, F.col("c") * F.log((1 - q) / (1 - base))).otherwise(0.0)
    good = counts.filter((F.col("t") >= min_contexts) & (q >= 0.8)).withColumn("gain", gain).filter(
        F.col("gain") >= math.log(max(tried, 2)) + 3).orderBy(F.desc("gain"), "term").limit(max_terms).collect()
    out: dict[str, float] = {}
    for r in sorted(good, key=lambda r: len(r["term"].rstrip())):
        term = r["term"]
        if any(term.startswith(p) for p in out if not p.endswith(" ")):
            continue  # a shorter prefix covers it
        out[term] = math.log((r["t"] + 0.5) / (r["c"] + 0.5)) - math.log(base / (1 - base))
    return out


def learn_exceptions(sample: DataFrame, lexicon: dict[str, float], min_clean: int = 3) -> tuple[str, ...]:
    """Pairs of folded words, one of which holds a term, that only clean texts use, in ``min_clean`` distinct contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon, ())
        for b in batches:
            pair, context, label = [], [], []
            for text, y in zip(b["text"].to_pylist(), b["label"].to_pylist(), strict=True):
                folded = fold(text)
                words = ["", *folded.split(), ""]
                hit = {folded.count(" ", 0, start + 1) for start in matcher.starts(folded)}  # numbers of words, from 1
                for i in {j for h in hit for j in (h - 1, h)}:
                    if 1 <= i < len(words) - 2:
                        pair.append(f"{words[i]} {words[i + 1]}")
                        context.append(f"{words[i - 1]} {words[i]} {words[i + 1]} {words[i + 2]}")
                        label.append(y)
            yield pa.RecordBatch.from_pydict({"pair": pa.array(pair, pa.string()), "context": pa.array(context, pa.string()),
                                              "label": pa.array(label, pa.int32())})

    seen = sample.select("text", "label").mapInArrow(run, "pair string, context string, label int").distinct()
    counts = seen.groupBy("pair").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c"))
    return tuple(r["pair"] for r in counts.filter((F.col("t") == 0) & (F.col("c") >= min_clean)).orderBy("pair").collect())


class Matcher:
    """Aho-Corasick over the lexicon; exception phrases blank the words they cover."""

    def __init__(self, lexicon: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS) -> None:
        self.hits, self.safe = ahocorasick.Automaton(), ahocorasick.Automaton()
        for t, w in lexicon.items():
            self.hits.add_word(t, (w, len(t)))
        for p in exceptions:
            self.safe.add_word(folded := fold(p), len(folded))  # folded words fold to themselves
        for a in (self.hits, self.safe):
            if len(a):
                a.make_automaton()

    def starts(self, folded: str) -> set[int]:
        """Where hits start, exceptions or not."""
        return {end - n + 1 for end, (_, n) in self.hits.iter(folded)} if len(self.hits) else set()

    def weigh(self, folded: str) -> tuple[float, int]:
        """Total weight and number of hits. Hits that start at the same word count once, by the largest weight."""
        if not len(self.hits):
            return 0.0, 0
        at: dict[int, float] = {}
        for end, (w, n) in self.hits.iter(folded):
            start = end - n + 1
            at[start] = max(w, at.get(start, 0.0))
        if at and len(self.safe):
            for end, n in self.safe.iter(folded):
                for s in [s for s in at if end - n + 1 <= s < end]:
                    del at[s]
        return sum(at.values()), len(at)


def features(weight: float, words: int) -> list[float]:
    """Bias, weight per square root of the length, and weight per hundred words (both compressed)."""
    return [1.0, math.log1p(weight / math.sqrt(words + 1)), math.log1p(100 * weight / (words + 10))]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Ridge-damped Newton steps; deterministic."""
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(x.shape[1])
        move = np.linalg.solve(h, x.T @ (y - p) - ridge * b)
        b += np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-8:
            break
    return b


class Model:
    def __init__(self, lexicon: dict[str, float], curve: list[float], exceptions: tuple[str, ...] = EXCEPTIONS) -> None:
        self.lexicon, self.curve, self.exceptions = lexicon, curve, exceptions
        self._matcher: Matcher | None = None

    def __getstate__(self):
        return self.__dict__ | {"_matcher": None}

    def measure(self, text: str) -> tuple[float, int, int]:
        self._matcher = self._matcher or Matcher(self.lexicon, self.exceptions)
        folded = fold(text)
        return (*self._matcher.weigh(folded), folded.count(" ") - 1)

    def score(self, text: str) -> float:
        weight, _, words = self.measure(text)
        z = sum(a * b for a, b in zip(self.curve, features(weight, words), strict=True))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, trained: Column, sample: int = 1500) -> Model:
    """Lexicon and curve from ``labels.toxic`` of the rows for which ``trained`` holds."""
    rows = materialize(spark, sample_rows(spark, docs, labels, "toxic", trained, sample), "toxic-sample")
    per_class = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    lexicon = learn_lexicon(rows) if len(per_class) == 2 else {}
    if not lexicon:
        return Model({}, [-6.0, 0.0, 0.0])
    model = Model(lexicon, [0.0, 0.0, 0.0], (*EXCEPTIONS, *learn_exceptions(rows, lexicon)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = [model.measure(t) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in m], pa.float64()),
                                              pa.array([x[2] for x in m], pa.int64()), b["label"]], ["weight", "words", "label"])

    got = rows.mapInArrow(run, "weight double, words long, label int").orderBy("weight", "words", "label").collect()
    x = np.array([features(r["weight"], r["words"]) for r in got])
    model.curve = fit_logistic(x, np.array([r["label"] for r in got], dtype=float)).tolist()
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus ``score`` (replacing a column of that name)."""
    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        return pd.Series([model.score(t or "") for t in texts], dtype="float64")

    return docs.withColumn("score", scored(text_or_empty(text)))


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def fitted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    small_batches(spark)
    return train(spark, docs, table(spark, sf_dir, "labels"), ~held_out())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, fitted(spark, docs, sf_dir))
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.7).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline form: documents with a score of 0.7 or more go."""
    model = fitted(spark, docs, sf_dir)
    return unpacked(score(packed(docs, "text"), model).filter(F.col("score") < 0.7))
