"""Quality classifier by compression: zstandard dictionaries of good and bad text.

Two dictionaries are trained on bounded samples of good and bad labelled
texts, for each of two views of a text: its bytes, and its shape (upper case
``A``, lower case ``a``, digits ``0``, the rest as it is). A text is cut into
chunks that are compressed on their own with either dictionary, so its end
counts as much as its start. The normalised difference of the compressed
sizes (in all, and in the worst chunk) is the evidence, beside what the text
saves without a dictionary; a logistic curve fitted on other training rows
turns it into the probability of label 1.

Rows are drawn per class, so the score is the probability of label 1 at equal shares of both labels, not at
their rate in the table.

Bounds: ``sample`` rows per class; ``passages`` passages of each for a dictionary; ``dict_bytes`` per dictionary.

Defined results: a null or empty text has evidence 0 in all views. Without
usable labels of both classes, as in empty tables, every score is 0.5. Equal rows score alike, and doubled label
rows count by the largest label; other columns, whatever their names but ``score``, are kept. Very long texts are
compressed chunk by chunk.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fareway.llm.common import materialize, small_batches, table, text_or_empty
from fareway.llm.toxicity import fit_logistic, sample_rows

CHUNK = 1024
_SHAPE = bytes(97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))


def shape(data: bytes) -> bytes:
    """Letters to ``a`` or ``A`` and digits to ``0``: what is left is case, punctuation and layout."""
    return data.translate(_SHAPE)


VIEWS = (lambda data: data, shape)


def chunks(data: bytes, size: int = CHUNK) -> list[bytes]:
    return [data[i:i + size] for i in range(0, len(data), size)]


def build_dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; the plain bytes of the samples where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


class Model:
    """``dictionaries``: per view, the bytes of the good and of the bad one."""

    def __init__(self, dictionaries: list[tuple[bytes, bytes]], curve: list[float], level: int = 3) -> None:
        self.dictionaries, self.curve, self.level = dictionaries, curve, level
        self._sizers = None

    def __getstate__(self):
        return {"dictionaries": self.dictionaries, "curve": self.curve, "level": self.level, "_sizers": None}

    def _compressors(self):
        if self._sizers is None:
            self._sizers = []
            for pair in self.dictionaries:
                two = []
                for d in pair:
                    dictionary = zstandard.ZstdCompressionDict(d)
                    dictionary.precompute_compress(level=self.level)
                    two.append(zstandard.ZstdCompressor(level=self.level, dict_data=dictionary, write_content_size=False, write_dict_id=False))
                two.append(zstandard.ZstdCompressor(level=self.level, write_content_size=False, write_dict_id=False))
                self._sizers.append(two)
        return self._sizers

    def evidence(self, text: str) -> list[float]:
        """Per view: the normalised size difference in all and in the worst chunk, and the ratio without dictionary."""
        out = [1.0]
        data = text.encode()
        for view, (good, bad, plain) in zip(VIEWS, self._compressors(), strict=True):
            parts = chunks(view(data))
            g, b = [len(good.compress(x)) for x in parts], [len(bad.compress(x)) for x in parts]
            out += [10 * (sum(b) - sum(g)) / (sum(b) + sum(g) + 1),
                    10 * min(((y - x) / (x + y) for x, y in zip(g, b, strict=True)), default=0.0),
                    4 * sum(len(plain.compress(x)) for x in parts) / (len(data) + 16)]
        return out

    def score(self, text: str) -> float:
        if not self.dictionaries:
            z = self.curve[0]
        else:
            z = sum(a * b for a, b in zip(self.curve, self.evidence(text), strict=True))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, trained: Column, sample: int = 600,
          dict_bytes: int = 16_384, passages: int = 6) -> Model:
    """Dictionaries from one half of a bounded sample of labelled rows, the curve from the other half.

    Each text of the half sample gives its dictionary ``passages`` passages of ``CHUNK`` characters (all of
    it, if it is no longer than these), so that what reaches the driver is bounded. Texts are scored whole."""
    rows = materialize(spark, sample_rows(spark, docs, labels, "quality", trained, sample), "quality-sample")
    counts = rows.groupBy("label").agg(F.count("*").alias("n")).collect()
    n = {r["label"]: r["n"] for r in counts}
    if len(n) < 2 or min(n.values()) < 2:
        return Model([], [0.0])
    half = F.pmod(F.xxhash64(F.lit(3), "text"), F.lit(2)) == 0
    # Evenly spread over the whole text: the first passage starts it, the last one ends it.
    size = F.length("text")
    last = F.least(F.lit(passages), F.greatest(F.lit(1), F.ceil(size / CHUNK))).cast("int") - 1
    step = F.when(last > 0, (size - CHUNK) / last).otherwise(0.0)
    places = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.col("text"), F.round(i * step).cast("int") + 1, F.lit(CHUNK)))
    got = rows.filter(half).select("label", F.xxhash64("text").alias("o"), places.alias("parts")).orderBy("o").collect()
    texts = {y: [p.encode() for r in got if r["label"] == y for p in r["parts"] if p] for y in (0, 1)}
    if not texts[0] or not texts[1]:
        return Model([], [0.0])
    model = Model([tuple(build_dictionary([view(t) for t in texts[y]], dict_bytes) for y in (1, 0)) for view in VIEWS], [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([model.evidence(t) for t in b["text"].to_pylist()],
                                                       pa.list_(pa.float64())), b["label"]], ["x", "label"])

    got = rows.filter(~half).select("text", "label").mapInArrow(run, "x array<double>, label int").orderBy("x", "label").collect()
    if len({r["label"] for r in got}) < 2:
        return Model([], [0.0])
    # Rows are drawn per class, so the score is the probability at equal shares of both labels.
    x, y = np.array([r["x"] for r in got]), np.array([r["label"] for r in got], dtype=float)
    model.curve = fit_logistic(x, y, ridge=0.1).tolist()
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        return pd.Series([model.score(t or "") for t in texts], dtype="float64")

    return docs.withColumn("score", scored(text_or_empty(text)))


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(spark, docs, table(spark, sf_dir, "labels"), ~held_out())
    return score(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                                     (F.col("score") >= 0.3).cast("int").alias("predicted"))
