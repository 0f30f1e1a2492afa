"""Rule-based quality filter: one threshold table, compiled into one projection.

``RULES`` names a measure and its allowed range. ``apply_rules`` builds every
measure from built-in SQL functions (no user function runs) and turns the
table into one boolean per rule. Measures are per text, so the plan is one
scan and one projection without a shuffle.

Defined results: a null text counts as empty. An empty text has 0 in every
measure and is not kept. Ties and repeated rows are scored alike, one output
row per input row; empty tables give none. A very long text is one row's array of words. Input columns pass
through untouched, except that ``failed_rules``, ``base_failed``, ``kept`` and names starting with ``_q`` are
reserved: columns of these names are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fareway.llm.common import WORD, table, text_or_empty

SYMBOLS = "#*$%&|<>"

# Common function words of the corpus languages.
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "with", "as", "by", "at",
           "are", "this", "be", "from", "or", "an"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im",
           "dem", "nicht", "ein", "eine", "als"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans",
           "par", "sur", "au", "pas", "avec"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una",
           "su", "para", "es", "al"],
}


@dataclass(frozen=True)
class Rule:
    """Keep a text while ``low <= measure <= high`` (None: open end)."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("word_count", "n_words", 50, None),
    Rule("word_length", "mean_word_chars", 2.0, 15.0),
    Rule("longest_word", "longest_word", None, 1000),
    Rule("symbols", "symbol_ratio", None, 0.03),
    Rule("shouting", "upper_ratio", None, 0.4),
    Rule("exclamations", "exclaim_ratio", None, 0.1),
    Rule("digits", "digit_ratio", None, 0.4),
    Rule("stop_words", "n_stop_words", 2, None),
    Rule("repeated_lines", "dup_line_ratio", None, 0.3),
    Rule("repeated_words", "repeat_word_ratio", None, 0.5),
)


def _windows(words: Column, join) -> Column:
    """``join`` of the three words of every 3-word window."""
    joined = F.transform(words, lambda w, i: join(w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.slice(joined, 1, F.greatest(F.size(words) - 2, F.lit(0)))


def measures(df: DataFrame, text: str = "text", stop_words: dict[str, list[str]] = STOP_WORDS) -> DataFrame:
    """``df`` with a struct column ``_q`` of all measures."""
    stops = sorted({w for ws in stop_words.values() for w in ws})
    longest = max(map(len, stops))
    t = F.col("_q_text")
    df = df.withColumn("_q_text", text_or_empty(text))
    df = df.withColumn("_q_words", F.regexp_extract_all(t, F.lit(WORD), F.lit(0)))
    df = df.withColumn("_q_lines", F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD)))
    # Texts whose window hashes all differ have no repeated window. In the others, sorted window hashes bring
    # equal windows together; neighbours count as equal only if their words are equal too.
    df = df.withColumn("_q_hashes", _windows(F.col("_q_words"), F.xxhash64))
    twice = F.size(F.array_distinct("_q_hashes")) < F.size("_q_hashes")
    df = df.withColumn("_q_sorted", F.when(twice, F.sort_array(F.transform("_q_hashes", lambda h, i: F.struct(
        h.alias("h"), i.alias("i"))))))

    def equal(a: Column, b: Column) -> Column:
        w = F.col("_q_words")
        return (a["h"] == b["h"]) & (w[a["i"]] == w[b["i"]]) & (w[a["i"] + 1] == w[b["i"] + 1]) & (
            w[a["i"] + 2] == w[b["i"] + 2])

    none = F.lit(None).cast("array<int>")
    pairs = F.array_compact(F.zip_with(
        F.slice("_q_sorted", 1, F.greatest(F.size("_q_sorted") - 1, F.lit(0))),
        F.slice("_q_sorted", 2, F.greatest(F.size("_q_sorted") - 1, F.lit(0))),
        lambda a, b: F.when(equal(a, b), F.array(a["i"], a["i"] + 1, a["i"] + 2, b["i"], b["i"] + 1, b["i"] + 2))
        .otherwise(none)))
    repeated = F.coalesce(F.size(F.array_distinct(F.flatten(pairs))), F.lit(0))
    df = df.withColumn("_q", F.struct(
        F.size("_q_words").cast("long").alias("n_words"),
        F.length(F.array_join("_q_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        F.size("_q_lines").cast("long").alias("n_lines"),
        (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long").alias("n_dup_lines"),
        F.greatest(repeated, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.filter("_q_words", lambda w: (F.length(w) <= longest) & F.lower(w).isin(stops))).cast("long").alias("n_stop_words"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count(t, F.lit("[0-9]")).cast("long").alias("n_digits"),
        F.regexp_count(t, F.lit("!")).cast("long").alias("n_exclaims"),
        F.coalesce(F.array_max(F.transform("_q_words", F.length)), F.lit(0)).cast("long").alias("longest_word"),
    ))
    return df.drop("_q_text", "_q_words", "_q_lines", "_q_hashes", "_q_sorted")


def apply_rules(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``df`` plus struct ``_q`` (measures), ``base_failed``, ``failed_rules`` and ``kept``."""
    df = measures(df, text)
    q = {c: F.col(f"_q.{c}") for c in df.schema["_q"].dataType.names}

    def ratio(a: str, b: str) -> Column:
        return F.when(q[b] > 0, q[a] / q[b]).otherwise(F.lit(0.0))

    known = q | {
        "mean_word_chars": ratio("word_chars", "n_words"), "symbol_ratio": ratio("n_symbols", "word_chars"),
        "upper_ratio": ratio("n_upper", "word_chars"), "exclaim_ratio": ratio("n_exclaims", "word_chars"),
        "digit_ratio": ratio("n_digits", "word_chars"), "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "repeat_word_ratio": ratio("n_repeat_words", "n_words"),
    }
    broken = []
    for r in rules:
        m = known[r.measure]
        out = F.lit(False)
        if r.low is not None:
            out = out | (m < F.lit(r.low))
        if r.high is not None:
            out = out | (m > F.lit(r.high))
        broken.append(F.when(out, F.lit(r.name)))
    base = (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])
    return (df.withColumn("failed_rules", F.array_compact(F.array(*broken)))
            .withColumn("base_failed", base)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return apply_rules(docs).select("doc_id", "_q.n_words", "_q.word_chars", "_q.n_symbols", "_q.n_dup_lines",
                                    "_q.n_repeat_words", "base_failed", "kept",
                                    F.concat_ws(",", "failed_rules").alias("failed_rules"))


def oracle() -> str:
    """DuckDB SQL for the rows of ``query``, from the same threshold table."""
    stops = sorted({w for ws in STOP_WORDS.values() for w in ws})
    ratios = {"mean_word_chars": ("word_chars", "n_words"), "symbol_ratio": ("n_symbols", "word_chars"),
              "upper_ratio": ("n_upper", "word_chars"), "exclaim_ratio": ("n_exclaims", "word_chars"),
              "digit_ratio": ("n_digits", "word_chars"), "dup_line_ratio": ("n_dup_lines", "n_lines"),
              "repeat_word_ratio": ("n_repeat_words", "n_words")}
    failed = []
    for r in RULES:
        m = r.measure
        if m in ratios:
            a, b = ratios[m]
            m = f"CASE WHEN {b} > 0 THEN CAST({a} AS DOUBLE) / {b} ELSE 0 END"
        out = [f"{m} < CAST({r.low} AS DOUBLE)"] * (r.low is not None) + [f"{m} > CAST({r.high} AS DOUBLE)"] * (r.high is not None)
        failed.append(f"CASE WHEN {' OR '.join(out)} THEN '{r.name}' END")
    word = r"[^\x20\x09-\x0D]"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{word}+') AS w FROM d),
windows AS (SELECT r, k, w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] AS p FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS k FROM w)),
again AS (SELECT r, k FROM windows QUALIFY count(*) OVER (PARTITION BY r, p) > 1),
repeats AS (SELECT r, count(DISTINCT x) AS n_repeat_words FROM (SELECT r, unnest([k, k + 1, k + 2]) AS x FROM again) GROUP BY r),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{word}') GROUP BY r),
m AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(t, '[{SYMBOLS}]')) AS BIGINT) AS n_symbols,
        CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
        len(list_filter(w, lambda x: lower(x) IN ({", ".join(f"'{x}'" for x in stops)}))) AS n_stop_words,
        len(regexp_extract_all(t, '\\p{{Lu}}')) AS n_upper, len(regexp_extract_all(t, '[0-9]')) AS n_digits,
        len(regexp_extract_all(t, '!')) AS n_exclaims,
        coalesce(list_max(list_transform(w, lambda x: length(x))), 0) AS longest_word
    FROM w LEFT JOIN repeats USING (r) LEFT JOIN lines USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        concat_ws(',', {", ".join(failed)}) AS failed_rules FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed_rules = '' AS kept,
    failed_rules FROM f
"""
