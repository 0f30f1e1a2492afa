"""Phrase collocations by best-first branch-and-bound growth.

A phrase that occurs ``a`` times scores floor(scale * a^2 / (l * r)) at its
worst cut into a first part (l occurrences) and the rest (r). Phrases grow
from their prefixes, one word at a time:

1. Words are counted per language. A word below ``min_count`` ends every
   phrase, as no count of a phrase exceeds that of a part.
2. Pairs of the other words are counted. They are the first candidates and
   the prefixes of the frontier.
3. A prefix xy bounds all that grows from it: an extension occurs at most
   A = min(f(xy), max f(y.)) times, so at its first cut it scores at most
   scale * A / f(x). This never underestimates.
4. The frontier is expanded best first, in rounds. A round settles each
   language down to a score level: prefixes whose bound reaches it, and pairs
   that score it (their containing triples decide whether they are dropped),
   have their triples counted; all others cannot matter. When ``top``
   phrases survive at or above the level, ties included, the language is done;
   the others go on with a lower level, at last 0, where all is expanded.

Words are 64-bit hashes while they are counted, proven unique per language
against the word table (another seed is taken if two words collide), so all
counts are exact. Each pass pre-aggregates millions of words in a task before
the shuffle; hot words and languages are spread by the phrase. Bloom filters of bounded
size spare triples off the frontier; an exact join follows.

Defined results: a null text counts as empty; a null language is ``und``.
Ties are ranked by occurrences, then by the phrase's bytes. Equal rows count
each time. Empty tables, and languages without candidates, give no rows. A
very long text needs its words in memory. Other columns are left alone.
Counts up to 10^16 are exact; beyond that the arithmetic raises an error.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fareway.llm import bloom
from fareway.llm.common import materialize, small_batches, table, text_or_empty

MIN_COUNT, TOP, SCALE, COVER = 10, 2000, 1_000_000, 50
BUFFER = 2_000_000  # words that a task gathers before it counts them

#: Lower-cases ASCII letters; ends of pieces become a byte that UTF-8 never has.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else 255 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))


def tokens(text: bytes) -> list[bytes]:
    """Words in order; the byte FF between pieces."""
    return text.translate(_BYTES).replace(b"\xff", b" \xff ").split()


class Hashes(dict):
    """Word to non-zero 64-bit hash, 0 for the end of a piece; at most a million words are remembered."""

    def __init__(self, seed: int) -> None:
        super().__init__({b"\xff": 0})
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
            self[b"\xff"] = 0
        self[word] = h = xxhash.xxh3_64_intdigest(word, self.seed) or 1
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def lang_hash(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang))


def _gathered(batches: Iterator[pa.RecordBatch], count) -> Iterator[pa.RecordBatch]:
    """Words of each language, gathered over batches and handed to ``count(lang, list of words)`` in bulk."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for b in batches:
        for lang, cell in zip(b["_lang"].to_pylist(), b["_text"], strict=True):
            words = held.setdefault(lang, [])
            before = len(words)
            words += tokens(bytes(cell.as_buffer()))
            words.append(b"\xff")
            size += len(words) - before
            if size >= BUFFER:
                for key, value in held.items():
                    yield from count(key, value)
                held, size = {}, 0
    for key, value in held.items():
        yield from count(key, value)


def _runs(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows and their counts. Rows are sorted by a hash; equal hashes are told apart by the row itself."""
    order = np.argsort(bloom.fold(columns))
    columns = [c[order] for c in columns]
    n = len(order)
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.diff(np.append(first, n))


def _batch(lang: str, columns: dict[str, np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
    n = len(counts)
    arrays = [pa.array([lang], pa.string()).take(pa.array(np.zeros(n, np.int64)))]
    arrays += [pa.array(c.view(np.int64)) for c in columns.values()]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(counts.astype(np.int64))], ["lang", *columns, "f"])


def _emit_words(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def count(lang: str, words: list[bytes]) -> Iterator[pa.RecordBatch]:
            found = Counter(words)
            found.pop(b"\xff", None)
            h = np.array([xxhash.xxh3_64_intdigest(w, seed) or 1 for w in found], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(h), np.int64))), pa.array(h.view(np.int64)),
                 pa.array([w.decode() for w in found], pa.string()), pa.array(list(found.values()), pa.int64())],
                ["lang", "x", "word", "f"])

        return _gathered(batches, count)

    return run


def _emit_phrases(seed: int, length: int, frequent, prefixes=None, wanted=None):
    """Counts of phrases of ``length`` words that may be frequent: all their words pass the filter ``frequent``.
    With ``prefixes`` and ``wanted``, the phrase's prefix passes the former or its prefix or suffix the latter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(seed)

        def count(lang: str, words: list[bytes]) -> Iterator[pa.RecordBatch]:
            h = hashes.of(words)
            code = lang_hash(lang)
            h[~bloom.may_hold(frequent.value, [np.full(len(h), code), h])] = 0
            n = len(h) - length + 1
            if n <= 0:
                return
            ok = np.ones(n, bool)
            for i in range(length):
                ok &= h[i:i + n] != 0
            at = np.flatnonzero(ok)
            if prefixes is not None:
                start, end = [h[at + i] for i in range(length - 1)], [h[at + i] for i in range(1, length)]
                codes = np.full(len(at), code)
                at = at[bloom.may_hold(prefixes.value, [codes, *start]) | bloom.may_hold(wanted.value, [codes, *end])]
            columns, counts = _runs([h[at + i] for i in range(length)])
            yield _batch(lang, dict(zip("xyz", columns, strict=False)), counts)

        return _gathered(batches, count)

    return run


def _keyed(df: DataFrame, *columns: str) -> DataFrame:
    """``_l``, the hash of the language that workers use, beside ``columns``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code = pa.array(np.array([lang_hash(x) for x in b["lang"].to_pylist()], np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([code, *[b[c] for c in columns]], ["_l", *columns])

    return df.select("lang", *columns).mapInArrow(run, "_l long, " + ", ".join(f"{c} long" for c in columns))


def _filter(spark: SparkSession, df: DataFrame, *columns: str):
    return bloom.share(spark, materialize(spark, _keyed(df, *columns), "phrase-keys"), ["_l", *columns])


def score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a^2 / (left * right)), exactly."""
    wide = lambda c: f"cast({c} as decimal(16, 0))"
    return F.expr(f"({wide(a)} * {wide(a)} * cast({SCALE} as decimal(7, 0))) div ({wide(left)} * {wide(right)})")


def _named(df: DataFrame, /, **names: str) -> DataFrame:
    """``df`` with its columns renamed for a join."""
    return df.select("lang", *[F.col(a).alias(b) for a, b in names.items()])


SALTS = 32


def first_rows(df: DataFrame, by: str, order: list[Column], k: int) -> DataFrame:
    """The ``k`` first rows per ``by`` with their ``rank``. A hot group is ranked in ``SALTS`` parts first, so that one
    task gets at most ``SALTS * k`` of its rows."""
    salt = F.pmod(F.xxhash64(*[c for c in df.columns if c != by]), F.lit(SALTS))
    part = F.row_number().over(Window.partitionBy(by, "_salt").orderBy(*order))
    some = df.withColumn("_salt", salt).withColumn("rank", part).filter(F.col("rank") <= k).drop("_salt")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("rank") <= k)


def collocations(spark: SparkSession, docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT,
                 top: int = TOP, cover: int = COVER, first_level: int = 2, growth: int = 4) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` of each language's ``top`` phrases of 2 or
    3 words. A phrase is dropped if a longer candidate that holds it has at least ``cover`` per cent of its occurrences.

    The first round goes down to the score of the ``first_level * top``-th pair, each further one to ``growth`` times that rank.
    """
    small_batches(spark)
    docs = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("_lang"), text_or_empty(text).alias("_text"))
    for seed in range(8):
        words = materialize(spark, docs.mapInArrow(_emit_words(seed), "lang string, x long, word string, f long").groupBy(
            "lang", "x", "word").agg(F.sum("f").alias("f")), "words")
        if not words.groupBy("lang", "x").agg(F.count("*").alias("c")).filter("c > 1").head(1):
            break
    else:
        raise RuntimeError("words of one language collide under every seed")
    n = words.groupBy("lang").agg(F.sum("f").alias("n"))
    often = words.filter(F.col("f") >= min_count)
    word = often.select("lang", "x", "f")
    frequent = _filter(spark, word, "x")
    pairs = docs.mapInArrow(_emit_phrases(seed, 2, frequent), "lang string, x long, y long, f long").groupBy(
        "lang", "x", "y").agg(F.sum("f").alias("f")).filter(F.col("f") >= min_count)
    pairs = materialize(spark, pairs, "pairs")
    most = pairs.groupBy("lang", "x").agg(F.max("f").alias("next")).withColumnRenamed("x", "y")
    scored = (pairs.join(_named(word, x="x", f="fx"), ["lang", "x"]).join(_named(word, x="y", f="fy"), ["lang", "y"])
              .join(most, ["lang", "y"], "left")
              .withColumn("score", score("f", "fx", "fy"))
              .withColumn("grows", F.least("f", F.coalesce("next", F.lit(0))))
              .withColumn("bound", F.when(F.col("grows") >= min_count, F.expr(
                  f"(cast(grows as decimal(16, 0)) * cast({SCALE} as decimal(7, 0))) div cast(fx as decimal(16, 0))")))
              .select("lang", "x", "y", "f", "fx", "fy", "score", "bound"))
    scored = materialize(spark, scored, "scored-pairs")
    open_langs = scored.select("lang").distinct()
    depth, settled = first_level * top, None
    while True:
        at = first_rows(scored.join(open_langs, "lang", "left_semi").select("lang", "x", "y", "score"), "lang", [F.desc("score")], depth)
        levels = materialize(spark, at.groupBy("lang").agg(F.when(F.count("*") < depth, 0).otherwise(
            F.min("score")).cast("long").alias("level")), "levels")
        found = _settle(spark, docs, seed, frequent, scored.join(levels, "lang"), min_count, cover)
        done = materialize(spark, found.groupBy("lang").agg(F.count("*").alias("c")).join(levels, "lang", "right").filter(
            (F.col("c") >= top) | (F.col("level") == 0)).select("lang"), "done")
        part = found.join(done, "lang", "left_semi")
        settled = part if settled is None else settled.union(part)
        open_langs = materialize(spark, levels.select("lang").join(done, "lang", "left_anti"), "open")
        if not open_langs.head(1):
            break
        depth *= growth
    for c in "xyz":
        settled = settled.join(often.select("lang", F.col("x").alias(c), F.col("word").alias(f"w{c}")), ["lang", c], "left")
    named = settled.select("lang", "score", "a", "l", "r", F.concat_ws(" ", "wx", "wy", "wz").alias("phrase"))
    ranked = first_rows(named, "lang", [F.desc("score"), F.desc("a"), F.col("phrase")], top)
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _settle(spark: SparkSession, docs: DataFrame, seed: int, frequent, nodes: DataFrame, min_count: int,
            cover: int) -> DataFrame:
    """All surviving phrases that reach their language's ``level``. ``nodes``: scored pairs with their ``level``."""
    nodes = materialize(spark, nodes, "nodes")
    wanted = nodes.filter("score >= level")
    grown = nodes.filter("score >= level or bound >= level")
    prefixes, suffixes = _filter(spark, grown, "x", "y"), _filter(spark, wanted, "x", "y")
    triples = docs.mapInArrow(_emit_phrases(seed, 3, frequent, prefixes, suffixes), "lang string, x long, y long, z long, f long")
    triples = materialize(spark, triples.groupBy("lang", "x", "y", "z").agg(F.sum("f").alias("a")).filter(
        F.col("a") >= min_count), "triples")
    prefixes.destroy()
    suffixes.destroy()
    all_triples = (triples.join(nodes.select("lang", "x", "y", "level", F.col("f").alias("fxy"), "fx"), ["lang", "x", "y"])
                   .join(_named(nodes, x="y", y="z", f="fyz", fy="fz"), ["lang", "y", "z"]))
    first, second = score("a", "fx", "fyz"), score("a", "fxy", "fz")
    long = all_triples.withColumn("_s1", first).withColumn("_s2", second).select(
        "lang", "x", "y", "z", "a", "level", F.when(F.col("_s1") <= F.col("_s2"), F.struct(
            F.col("fx").alias("l"), F.col("fyz").alias("r"), F.col("_s1").alias("score"))).otherwise(F.struct(
                F.col("fxy").alias("l"), F.col("fz").alias("r"), F.col("_s2").alias("score"))).alias("cut"))
    long = long.select("lang", "x", "y", "z", "a", "cut.*", "level").filter("score >= level").drop("level")
    inside = triples.select("lang", "x", "y", "a").union(triples.select("lang", "y", "z", "a")).groupBy("lang", "x", "y").agg(
        F.max("a").alias("held"))
    short = wanted.join(inside, ["lang", "x", "y"], "left").filter(
        F.col("held").isNull() | (F.lit(100) * F.col("held") < F.lit(cover) * F.col("f")))
    short = short.select("lang", "x", "y", F.lit(None).cast("long").alias("z"), F.col("f").alias("a"), F.col("fx").alias("l"),
                         F.col("fy").alias("r"), "score")
    return materialize(spark, short.union(long), "phrases")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark, table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
      FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
g AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f, lang || chr(10) || phrase AS key FROM (
        SELECT lang, m, array_to_string(w[k:k + m - 1], ' ') AS phrase
        FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM p, (VALUES (1), (2), (3)) AS lengths(m) WHERE len(w) >= m))
      GROUP BY lang, m, phrase),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE m = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM g WHERE m >= 2 AND f >= 10),
cuts AS MATERIALIZED (SELECT lang, m, phrase, f, k, lang || chr(10) || array_to_string(w[1:k], ' ') AS first_key,
        lang || chr(10) || array_to_string(w[k + 1:m], ' ') AS rest_key FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
s AS (SELECT c.lang, c.m, c.phrase, c.f AS a, k, x.f AS l, y.f AS r,
        CAST(CAST(1000000 AS HUGEINT) * c.f * c.f // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
      FROM cuts AS c JOIN g AS x ON x.key = c.first_key JOIN g AS y ON y.key = c.rest_key),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT lang, phrase, max(f) AS held FROM (
        SELECT lang, array_to_string(w[1:2], ' ') AS phrase, f FROM c WHERE m = 3
        UNION ALL SELECT lang, array_to_string(w[2:3], ' ') AS phrase, f FROM c WHERE m = 3) GROUP BY ALL)
SELECT b.lang, CAST(row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase COLLATE "binary") AS INTEGER) AS rank,
    phrase, a, l, r, n, score
FROM b JOIN n USING (lang) LEFT JOIN o USING (lang, phrase)
WHERE m = 3 OR held IS NULL OR 100 * held < 50 * a
QUALIFY rank <= 2000
"""
