"""Fill-in-the-middle, decontamination and collocations against brute force, and on awkward input."""

import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fareway.llm import bloom, collocations, decontaminate, fill_middle

SCHEMA = "doc_id long, text string, lang string, source string, n long, spans string, items string, x long, f string, _text string, a string"


def rows_of(spark, rows):
    """(doc_id, text, lang) rows with columns whose names clash with working columns."""
    return spark.createDataFrame([(i, t, g, "s", 7, "k", "k", 1, "f", "other", "a") for i, t, g in rows], SCHEMA)


def long_text(n, seed=3):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdéfgñ€𝄞") for _ in range(rng.randint(1, 6))) for _ in range(n))


AWKWARD = [(1, None, "en"), (2, "", None), (3, " \n\t", "en"), (4, long_text(20_000), "de"), (5, "one", "en"), (5, "one", "en"),
           (None, "no id here", "en"), (6, "a <P> b", "en"), (7, "x" * 5000, "en"), (8, "é" * 4097, "fr"), (9, "<" * 30, "fr"),
           (10, "tail<S", "en"), (-3, "ends with a line\n", "und"), (11, "𝄞", "en")]


# ---- fill in the middle

def plain_fim(i, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_fill_middle_awkward(spark):
    more = AWKWARD + [(i, f"text {i} é{'ü' * (i % 7)} of some words", "en") for i in range(100, 400)]
    df = rows_of(spark, more)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = collections.Counter()
    for i, t, _ in more:
        n, form, p, m, out = plain_fim(i, t)
        want[i, n, form, p, m, sha(out), sha(t or "")] += 1
    got = fill_middle.fill_in_middle(df, digest=True)
    assert collections.Counter(tuple(r) for r in got.collect()) == want
    assert {k[2] for k in want} == {"plain", "psm", "spm"}
    texts = {(r.doc_id, r.output) for r in fill_middle.fill_in_middle(df.drop("n"), keep=("doc_id", "lang", "x")).collect()}
    assert texts == {(i, plain_fim(i, t)[4]) for i, t, _ in more}


def test_fill_middle_empty(spark):
    out = fill_middle.fill_in_middle(rows_of(spark, []), digest=True)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert out.count() == 0


@pytest.mark.parametrize("unit,split", [("char", lambda t: list(t)), ("line", lambda t: re.findall(r"[^\n]*\n|[^\n]+", t)),
                                        ("word", lambda t: re.findall(r"\s*\S+(?:\s+$)?", t) or ([t] if t else []))])
def test_tree_finds_every_unit(unit, split):
    rng = random.Random(8)
    for size in (0, 1, 5, 63, 64, 65, 700):
        text = "".join(rng.choice("ab é€𝄞 \n") for _ in range(size))
        data = text.encode()
        units = split(text)
        assert "".join(units) == text
        for block in (1, 7, 64, 4096):
            tree = fill_middle.BlockTree(np.frombuffer(data, np.uint8), unit, block)
            assert tree.units == len(units) and tree.code_points == len(text)
            for k in range(len(units) + 1):
                before = "".join(units[:k])
                assert tree.seek(k) == (len(before.encode()), len(before))


def test_fill_middle_by_words(spark):
    rule = fill_middle.Rule(unit="word", plain=0, spm=50, seed="x")
    rows = [(i, "alpha beta  gamma\ndelta", "en") for i in range(60)]
    for r in fill_middle.fill_in_middle(rows_of(spark, rows), rule).collect():
        assert r.n == 4 and r.form in ("psm", "spm")
        assert b"".join(fill_middle.restore(r.output.encode(), r.form)).decode() == "alpha beta  gamma\ndelta"
        prefix = re.search(r"<P>(.*?)<[SM]>", r.output, re.S)[1]
        assert prefix in ("", "alpha", "alpha beta", "alpha beta  gamma", "alpha beta  gamma\ndelta")
        assert r.prefix_chars == len(prefix)


# ---- decontamination

def plain_words(t):
    low = (t or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_contamination(docs, items, window=10):
    out = collections.Counter()
    windows = collections.defaultdict(set)
    for item, t in items:
        w = plain_words(t)
        m = min(window, len(w))
        for k in range(len(w) - m + 1) if w else ():
            windows[tuple(w[k:k + m])].add("" if item is None else str(item))
    for i, t, _ in docs:
        w = plain_words(t)
        hit, found = set(), set()
        for m in {len(p) for p in windows}:
            for k in range(len(w) - m + 1):
                ids = windows.get(tuple(w[k:k + m]))
                if ids:
                    hit |= set(range(k, k + m))
                    found |= ids
        out[i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)] += 1
    return out


def contamination_case():
    rng = random.Random(4)
    some = lambda n: " ".join(rng.choice(["ab", "cd", "Ef", "gh", "é"]) for _ in range(n))
    items = [(1, some(14)), (2, some(30)), (3, "ab cd gh"), (4, "rare"), (5, None), (6, " .,"), (None, some(12)), (7, some(10)),
             (7, some(11)), (8, "Question: AB, cd; ef gh é ab cd ef gh é ab cd!"), (9, some(3000)), (10, some(3000))]
    items.append((11, items[1][1]))
    docs = [(i, t, g) for i, t, g in AWKWARD]
    docs += [(100 + i, some(rng.randrange(200)), "en") for i in range(60)]
    docs += [(200 + i, f"{some(5)}\n{t}-{some(7)} rare", "en") for i, (_, t) in enumerate(items)]
    docs += [(300, items[10][1], "en"), (300, items[10][1], "en"), (301, "RARE", "en"), (302, "rar e", "en")]
    return docs, items


@pytest.mark.parametrize("block_bytes", [4 << 20, 9000])
def test_decontaminate_awkward(spark, block_bytes):
    docs, items = contamination_case()
    bench = spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id long, text string, doc_id string, words string")
    got = decontaminate.decontaminate(spark, rows_of(spark, docs), bench, block_bytes=block_bytes).drop("spans", "items")
    assert collections.Counter(tuple(r) for r in got.collect()) == plain_contamination(docs, items)


def test_decontaminate_empty(spark):
    docs, items = contamination_case()
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.decontaminate(spark, rows_of(spark, docs), none)
    assert got.count() == len(docs) and not got.filter("contaminated or n_items > 0").count()
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.decontaminate(spark, rows_of(spark, []), bench).count() == 0


def test_decontaminate_spans(spark):
    docs = [(1, "q r " + " ".join(f"w{i}" for i in range(12)) + " z", "en")]
    bench = spark.createDataFrame([(5, " ".join(f"w{i}" for i in range(12)))], "item_id long, text string")
    row = decontaminate.decontaminate(spark, rows_of(spark, docs), bench).first()
    assert [tuple(s) for s in row.spans] == [(2, 14)] and row["items"] == ["5"]


# ---- collocations

def plain_collocations(docs, min_count=10, top=2000, cover=50):
    count = collections.defaultdict(collections.Counter)
    total = collections.Counter()
    for _, t, g in docs:
        low = (t or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[g or "und"] += len(w)
            for m in (1, 2, 3):
                for k in range(len(w) - m + 1):
                    count[g or "und"][tuple(w[k:k + m])] += 1
    out = []
    for g, f in count.items():
        cand = {p: c for p, c in f.items() if len(p) > 1 and c >= min_count}
        held = collections.Counter()
        for p, c in cand.items():
            if len(p) == 3:
                held[p[:2]] = max(held[p[:2]], c)
                held[p[1:]] = max(held[p[1:]], c)
        rows = []
        for p, a in cand.items():
            if len(p) == 2 and held[p] and 100 * held[p] >= cover * a:
                continue
            s, _, left, right = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((" ".join(p), a, left, right, total[g], s))
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(g, i + 1, *r) for i, r in enumerate(rows[:top])]
    return sorted(out)


def phrase_case(n=400, seed=2):
    rng = random.Random(seed)
    vocab = ["the", "The", "of", "é", "ñu", "in"] + [f"w{i}" for i in range(25)]
    docs = list(AWKWARD)
    for i in range(n):
        words = [rng.choice(vocab[:6] if rng.random() < .4 else vocab) + rng.choice(["", "", "", ",", ".", "\n", "\t"]) for _ in range(50)]
        if i % 3 == 0:
            words[10:13] = ["New", "York", "City"]
        if i % 4 == 0:
            words[20:22] = ["Hong", "kong"]
        if i % 40 == 0:
            words[30:32] = ["seldom", "seen"]
        docs.append((i, " ".join(words), rng.choice(["en", "en", "de", None])))
    return docs


@pytest.mark.parametrize("top", [2000, 40, 3])
def test_collocations_brute_force(spark, top):
    docs = phrase_case()
    got = collocations.collocations(spark, rows_of(spark, docs), top=top)
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(docs, top=top)


def test_collocations_takes_further_rounds(spark):
    """Pairs inside frequent triples are dropped, so the first level does not settle the language."""
    rng = random.Random(1)
    docs = [(i, ". ".join(f"a{k} b{k} c{k}" for k in rng.sample(range(30), 12)), "en") for i in range(80)]
    docs += [(i, ". ".join(f"x{rng.randrange(9)} y{rng.randrange(9)}" for _ in range(40)), "en") for i in range(80)]
    got = collocations.collocations(spark, rows_of(spark, docs), top=50, first_level=1, growth=2)
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(docs, top=50)


def test_collocations_empty(spark):
    out = collocations.collocations(spark, rows_of(spark, []))
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and out.count() == 0
    assert collocations.collocations(spark, rows_of(spark, AWKWARD[:3])).count() == 0


def test_score_is_exact_beyond_64_bits(spark):
    a, left, right = 9_999_999_999_999_967, 9_999_999_999_999_973, 9_999_999_999_999_999
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(collocations.score("a", "l", "r")).first()[0] == 10**6 * a * a // (left * right)


def test_bloom_has_no_false_negatives(spark):
    df = spark.range(5000).select(F.xxhash64("id").alias("x"), (F.col("id") * 3).alias("y"))
    field = bloom.build(df, ["x", "y"])
    rows = np.array([(r.x, r.y) for r in df.collect()])
    assert bloom.may_hold(field, [rows[:, 0].copy(), rows[:, 1].copy()]).all()
    assert bloom.may_hold(field, [rows[:, 0].copy(), rows[:, 1] + 1]).mean() < 0.05


@pytest.mark.parametrize("module", [fill_middle, decontaminate, collocations])
def test_queries_match_their_sql(spark, module):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = module.query(spark, sf)
    want = con.sql(module.ORACLE)
    assert sorted(map(tuple, df.select(*want.columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)
