"""Corpus operators against brute force, and on awkward input."""

import base64
import collections
import gzip
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fareway.llm import (
    bpe, compress_quality, hashing, mixing, order_minhash, quality_rules, sharding, substring_dedup, topk, toxicity, warc,
)

SF = "/root/testdata/sf0.001"
words = re.compile(r"[^\x20\x09-\x0D]+").findall


def long_text(n=30_000, seed=3):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def awkward():
    """(doc_id, text, source): nulls, empties, a long text, ties, repeated rows, copies, shared passages."""
    rng = random.Random(5)
    base = [" ".join(f"w{rng.randrange(400)}" for _ in range(120)) for _ in range(6)]
    near = base[0].split()
    near[60] = "changed"
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, long_text(), "b"), (5, base[0], "b"), (6, base[0], "b"),
            (7, " ".join(near), None), (8, base[1], "c"), (8, base[1], "c"), (None, base[2], "c"), (None, None, None),
            (9, f"{base[3]} {passage}", "d"), (10, f"{passage} {base[4]}", "é"), (11, "one two", "d"),
            (12, "a b c a b c a b c\nx y\nx y\n\nz#|", "d"), (13, "the " * 200, "d")]
    return rows


SCHEMA = ("doc_id long, text string, source string, lang string, n_chars long, size string, k string, r1 string, score string, _n int, "
          "_doc string, h1 string, s int, _b int, words string, label string")


@pytest.fixture(scope="module")
def docs(spark, awkward):
    return spark.createDataFrame([(i, t, s, "en", len(t or ""), "x", "y", "z", "s", 1, "d", "h", 2, 3, "w", "l") for i, t, s in awkward], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def write(spark, folder, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def folders(spark, docs, none, tmp_path_factory):
    pages = spark.createDataFrame([(3, "http://a/ b", "<p>x"), (1, None, "<p>x"), (2, "u", None), (4, "u", ""), (None, "u", "<p>x"),
                                   (5, "ü", "é" * 5000), (7, "v", "same\r\n\r\nWARC/1.1\r\nnot a record"), (7, "v", "<p>x")],
                                  "page_id long, url string, html string")
    vectors = spark.createDataFrame([(0, [0.5, -0.25, 1.0]), (1, [0.5, -0.25, 1.0]), (2, None), (3, [float("nan"), 0.0, 1.0]),
                                     (50, [1.0, 1.0, 1.0]), (4, [0.1, None, 0.2]), (None, [1.0, 1.0, 1.0]), (5, [2.0, 2.0]), (
                                         6, [9.0, 9.0, 9.0]), (6, [9.0, 9.0, 9.0])], "vec_id long, embedding array<float>")
    labels = spark.createDataFrame([(4, 1, 0), (5, None, 1), (None, 1, 1), (12, 0, 1), (12, 0, 0)], LABELS)
    full = write(spark, tmp_path_factory.mktemp("full"), documents=docs, pages=pages, embeddings=vectors, labels=labels)
    empty = write(spark, tmp_path_factory.mktemp("empty"), documents=none, pages=pages.limit(0), embeddings=vectors.limit(0),
                  labels=labels.limit(0))
    return full, empty


DOC_QUERIES = [quality_rules, bpe, toxicity, compress_quality, substring_dedup, mixing, order_minhash, sharding]


@pytest.mark.parametrize("module", DOC_QUERIES, ids=lambda m: m.__name__.rsplit(".", 1)[1])
def test_one_row_per_document(spark, folders, awkward, module):
    full, empty = folders
    got = [r["doc_id"] for r in module.query(spark, full).collect()]
    assert collections.Counter(got) == collections.Counter(i for i, _, _ in awkward)
    assert module.query(spark, empty).count() == 0


@pytest.mark.parametrize("module", [toxicity, order_minhash, substring_dedup, mixing], ids=lambda m: m.__name__.rsplit(".", 1)[1])
def test_stage_keeps_columns(spark, folders, docs, none, module):
    out = module.stage(spark, docs, folders[0])
    assert out.columns == docs.columns and out.count() > 0
    assert {r["size"] for r in out.collect()} == {"x"}
    assert module.stage(spark, none, folders[1]).count() == 0


# 1 ---------------------------------------------------------------------------------------------

def base_measures(t):
    t = t or ""
    w = words(t)
    g = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {j for i, x in enumerate(zip(w, w[1:], w[2:])) if g[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def test_quality_measures(spark, folders, awkward):
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = collections.Counter((r["doc_id"], *(r[c] for c in cols)) for r in quality_rules.query(spark, folders[0]).collect())
    assert got == collections.Counter((i, *base_measures(t)) for i, t, _ in awkward)
    rows = {r["doc_id"]: r for r in quality_rules.query(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        m = base_measures(r["text"])
        assert tuple(rows[r["doc_id"]][c] for c in cols) == m
        assert rows[r["doc_id"]]["base_failed"] == (m[0] < 50 or 100 * m[4] > 50 * m[0])


# 2 ---------------------------------------------------------------------------------------------

def test_bpe_equals_library(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(bpe.vocabulary())
    merges = bpe.Merges(bpe.vocabulary())
    enc = bpe.Encoder(merges)
    rng = random.Random(1)
    texts = ["", "<|endoftext|>", "a<|endoftext|> b", "x" * 3000, " \n\n  a", "don't 12 ²½ Ⅷ", "\x1c  z", "😀🏽 é" * 50]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2000), rng.randrange(0x4E00, 0x5000)]))
                      for _ in range(80)) for _ in range(60)]
    texts += ["".join(rng.choice("abcdeinorst") for _ in range(500)) for _ in range(10)]
    for t in texts:
        want = lib.encode(t, add_special_tokens=False).ids
        assert enc.encode(t) == want
        assert [i for part in enc.encode_stream(t[i:i + 7] for i in range(0, len(t), 7)) for i in part] == want
        dec = bpe.Decoder(merges)
        assert "".join(dec.feed([i]) for i in want) + dec.close() == lib.decode(want, skip_special_tokens=False) == t


def test_bpe_pairs_and_memory():
    merges = bpe.Merges(bpe.vocabulary())
    ids = [i for b, i in merges.ids.items() if merges.merge(b) == [b]]
    rng = random.Random(2)
    for _ in range(3000):
        a, b = rng.choice(ids[:2000]), rng.choice(ids)
        x, y = merges.bytes_of[a], merges.bytes_of[b]
        assert merges.follows(a, b) == (merges.merge(x + y) == [x, y])
    t, out = bpe.Transducer(merges), []
    for _ in range(300):
        out += t.feed(bytes(rng.choice(b"etaoinsh") for _ in range(100)))
        assert len(t.buffer) <= 8 * max(merges.max_token, merges.lookahead)
    assert sum(len(merges.bytes_of[i]) for i in out) >= 30_000 - 8 * max(merges.max_token, merges.lookahead)


def test_bpe_lookahead_is_enough():
    """Tokens that end a lookahead before the end of a prefix are those of the whole piece, wherever it is cut."""
    merges = bpe.Merges(bpe.vocabulary())
    rng = random.Random(12)
    tokens = sorted((b.decode() for b in merges.ids if b.isalpha() and b.isascii()), key=len)
    for trial in range(120):
        one = rng.choice(tokens[-2000:])
        piece = "".join([rng.choice(tokens[-3000:]) for _ in range(60)] if trial % 3 == 0 else [one[:rng.randrange(1, len(one) + 1)]
                        for _ in range(80)] if trial % 3 == 1 else [rng.choice("ab" if trial % 2 else "etaoin") for _ in range(700)]).encode()
        t = bpe.Transducer(merges)
        whole = [*t.feed(piece), *t.close()]
        assert whole == [merges.ids[b] for b in merges.merge(piece)]
        k = rng.randrange(1, 300)
        t = bpe.Transducer(merges)
        assert [i for at in range(0, len(piece), k) for i in t.feed(piece[at:at + k])] + list(t.close()) == whole


def test_bpe_long_texts_go_chunk_by_chunk(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(bpe.vocabulary())
    texts = [long_text(60_000) + "<|endoftext|>" + "x" * 150_000 + "  " + "é " * 120_000, "a b" * 70_000, " " * 250_000]
    assert all(len(t) > 2 * bpe.CHUNK for t in texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in bpe.encode_documents(df, digest=True).collect():
        ids = lib.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_bpe_query(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(bpe.vocabulary())
    got = {r["doc_id"]: r for r in bpe.query(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = lib.encode(r["text"], add_special_tokens=False).ids
        g = got[r["doc_id"]]
        assert g["n_tokens"] == len(ids)
        assert g["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert g["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


# 3, 4 ------------------------------------------------------------------------------------------

def test_fold():
    assert toxicity.fold("Id1оt, STÜPID m0r0n!") == " idiot stupid moron "
    assert toxicity.fold("in 2024 it was 15.") == " in 2024 it was 15 "


def test_matcher_exceptions():
    m = toxicity.Matcher({" trash ": 2.0, " idio": 3.0})
    assert m.weigh(toxicity.fold("you idiot, take the trash")) == (5.0, 2)
    assert m.weigh(toxicity.fold("the trash can")) == (0, 0)


def test_learned_exceptions(spark):
    lexicon = {" trash ": 2.0, " idio": 3.0}
    rows = [(f"please empty the trash tray{i} now", 0) for i in range(5)] + [(f"the old{i} trash compactor works", 0) for i in range(4)]
    rows += [(f"what idiot{i} trash", 1) for i in range(4)] + [("one trash heap", 0)] * 9
    sample = spark.createDataFrame(rows, "text string, label int")
    learned = toxicity.learn_exceptions(sample, lexicon)
    assert learned == ("the trash", "trash compactor")  # "trash heap" has many copies, but one context
    m = toxicity.Matcher(lexicon, learned)
    assert m.weigh(toxicity.fold("empty the trash")) == (0, 0)
    assert m.weigh(toxicity.fold("you trash")) == (2.0, 1)


def accuracy(rows, labels):
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and labels.get(r["doc_id"]) is not None]
    hit = sum(p == y for p, y in held) / len(held)
    caught = [p == y for p, y in held if y == 1] or [True]
    return hit, sum(caught) / len(caught)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    hit, caught = accuracy(toxicity.query(spark, sf).collect(), labels)
    assert hit > 0.95 and caught > 0.85


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    hit, kept = accuracy(compress_quality.query(spark, sf).collect(), labels)
    assert hit > 0.95 and kept > 0.95


def test_scores_in_range(spark, folders):
    for module in (toxicity, compress_quality):
        assert all(0 <= r["score"] <= 1 for r in module.query(spark, folders[0]).collect())


# 5 ---------------------------------------------------------------------------------------------

def test_warc_round_trip(spark, folders):
    got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"], r["payload_digest"]) for r in warc.query(
        spark, folders[0]).collect()), key=str)

    def row(i, html, kind, to=None):
        data = html.encode()
        return (i, len(data), kind, to, base64.b32encode(hashlib.sha1(data).digest()).decode())

    same = "same\r\n\r\nWARC/1.1\r\nnot a record"
    want = [row(1, "<p>x", "response"), row(3, "<p>x", "revisit", 1), row(None, "<p>x", "revisit", 1), row(7, "<p>x", "revisit", 1),
            row(2, "", "response"), row(4, "", "revisit", 2), row(5, "é" * 5000, "response"), row(7, same, "response")]
    assert got == sorted(want, key=str)
    assert warc.query(spark, folders[1]).count() == 0


def test_warc_on_pages(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        pages = [(r["page_id"], (r["html"] or "").encode()) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
        first = {}
        for i, data in pages:
            first[data] = min(i, first.get(data, i))
        want = {(i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if first[data] == i else "revisit",
                 None if first[data] == i else first[data]) for i, data in pages}
        got = warc.query(spark, sf).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
        assert len(got) == len(pages) and {tuple(r) for r in got} == want


def test_warc_gaps_sizes_and_urls(spark, tmp_path):
    urls = ["http://a/b c", "http://a/b%20c", "http://a/b\tc", "http://a/b  c", "plain", None]
    rows = [(i, u, "p" * (i * 9000) + str(i)) for i, u in enumerate(urls)] + [(50 + i, "u", "q" * 3_000_000 + str(i)) for i in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(warc.assign_types(spark, pages), f"{tmp_path}/w")
    sizes = [f.stat().st_size for f in (tmp_path / "w").iterdir() if f.name.startswith("part-")]
    assert sum(s > 3_000_000 for s in sizes) == 3 and max(sizes) < 3_100_000  # a long page is an archive of its own
    records, gaps = warc.recovered(spark, f"{tmp_path}/w", f"{tmp_path}/log")
    found = {r["record_id"]: r["target_uri"] for r in records.collect()}
    assert gaps == 0 and len(found) == len(rows)
    assert [found[f"<urn:page:{i}>"] for i in range(6)] == ["http://a/b%20c", "http://a/b%20c", "http://a/b%09c", "http://a/b%20%20c", "plain", None]
    for f in sorted((tmp_path / "w").iterdir()):
        if f.name.startswith("part-") and 10_000 < f.stat().st_size < 3_000_000:
            data = bytearray(f.read_bytes())
            data[5000] ^= 255
            f.write_bytes(bytes(data))
            (tmp_path / "w" / f".{f.name}.crc").unlink(missing_ok=True)
    records, gaps = warc.recovered(spark, f"{tmp_path}/w", f"{tmp_path}/log")
    assert gaps >= 1 and records.count() < len(rows)
    log = spark.read.json(f"{tmp_path}/log").collect()
    assert len(log) == gaps and all(r["stop"] > r["start"] and r["gap"] for r in log)


def record(i, payload=b"hello"):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    return (f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Block-Digest: sha1:"
            f"{base64.b32encode(hashlib.sha1(block).digest()).decode()}\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


@pytest.mark.parametrize("pack", [lambda x: x, gzip.compress], ids=["plain", "members"])
def test_salvage(pack):
    parts = [pack(record(i, bytes([65 + i]) * 400)) for i in range(6)]
    parts[2] = parts[2][:len(parts[2]) // 2]  # torn
    bad = bytearray(parts[4])
    bad[-20] ^= 255  # damaged
    parts[4] = bytes(bad)
    data = b"junk" + b"".join(parts)
    got = list(warc.salvage(data))
    assert [r["record_id"] for r in got if "gap" not in r] == [f"<urn:page:{i}>" for i in (0, 1, 3, 5)]
    gaps = [(r["start"], r["stop"]) for r in got if "gap" in r]
    edges = np.cumsum([4, *map(len, parts)]).tolist()
    assert gaps == [(0, 4), (edges[2], edges[3]), (edges[4], edges[5])]
    assert list(warc.salvage(b"")) == [] and [r["gap"] for r in warc.salvage(b"zzz")] == ["no version line"]


# 6 ---------------------------------------------------------------------------------------------

def brute_cut(rows):
    split = [(i, words(t or "")) for i, t in rows]
    seen = collections.Counter(tuple(w[k:k + 35]) for _, w in split for k in range(len(w) - 34))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if seen[tuple(w[k:k + 35])] > 1:
                gone[k:k + 35] = [True] * 35
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return collections.Counter(out)


def test_substring_dedup(spark, folders, awkward):
    cols = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    got = collections.Counter(tuple(r) for r in substring_dedup.query(spark, folders[0]).select(*cols).collect())
    assert got == brute_cut([(i, t) for i, t, _ in awkward])
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert collections.Counter(tuple(r) for r in substring_dedup.query(spark, SF).select(*cols).collect()) == brute_cut(rows)


def test_cut_keeps_layout():
    texts = hashing.word_spans(pa.array(["a  b\nc d", "a\nb  c", "", " x y\tz "]))
    assert substring_dedup.cut(texts, 0, [(1, 2)]) == (b"a c d", b"a c d", 4, 1)
    assert substring_dedup.cut(texts, 1, []) == (b"a\nb  c", b"a b c", 3, 0)
    assert substring_dedup.cut(texts, 2, []) == (b"", b"", 0, 0)
    assert substring_dedup.cut(texts, 3, [(0, 3)]) == (b"", b"", 3, 3)
    assert substring_dedup.cut(texts, 3, [(2, 3)]) == (b"x y", b"x y", 3, 1)


def test_word_spans_and_hashes():
    rng = random.Random(1)
    for trial in range(60):
        some = ["".join(rng.choice("ab é\n\t€x\x0b\x1f\xa0") for _ in range(rng.choice([0, 1, 3, 30, 400]))) for _ in range(rng.randrange(8))]
        if trial % 10 == 0:
            some += ["q" * 5000 + " " + "q" * 5001 + " " + "q" * 5000, "r" * 4096 + "\n" + "r" * 4097]
        k = rng.randrange(len(some) + 1)
        spans = hashing.word_spans(pa.array(some, pa.string()).slice(k))
        want = [(i, w) for i, t in enumerate(some[k:]) for w in words(t)]
        assert [(int(o), spans.data[a:z].tobytes().decode()) for o, a, z in zip(spans.owner, spans.starts, spans.ends)] == want
        known = {}
        assert all(known.setdefault(w, h) == h for (_, w), h in zip(want, spans.hashes().tolist()))
        assert len(set(known.values())) == len(known)


# 7 ---------------------------------------------------------------------------------------------

def targets(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    budget, out, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        unit = (budget - sum(out.values())) / sum(w[s] for s in free)
        over = {s for s in free if unit * w[s] > 2 * sizes[s]}
        if not over:
            return out | {s: unit * w[s] for s in free}
        out |= {s: 2.0 * sizes[s] for s in over}
        free -= over
    return out


def plain_mix(rows, target, size, passes=2, end=1.0):
    """Words taken of every row by serving each source in hash order; equal rows in a row. ``rows``: (s, h1, h2, size)."""
    out = collections.Counter()
    buckets = max(64, int(len(set(rows))**0.5))
    for s in {r[0] for r in rows}:
        at = 0
        mine = sorted((r for r in rows if r[0] == s), key=lambda r: ((r[1] % 2**64 >> 16) % buckets, r))
        taken = [0] * len(mine)
        for _ in range(passes):
            for i, r in enumerate(mine):
                taken[i] += max(0, min(r[3], math.floor(target[s] * end - at + 1e-6)))
                at += r[3]
        for r, n in zip(mine, taken):
            out[(*r, n)] += 1
    return out


@pytest.fixture(scope="module")
def mixed_docs(spark):
    """Sources of very different sizes; one holds many equal rows, one is cut within a run of equal rows."""
    rng = random.Random(9)
    rows = [(i, " ".join("w" for _ in range(rng.randrange(40))), rng.choice(["a", "b", "b", "b", "c", None])) for i in range(300)]
    rows += [(1000, "same text of five words", "hot")] * 200 + [(1001, "x", "dots")] * 77 + [(2000, "one two three", "small")]
    rows += [(3000, "", "nothing"), (3001, None, "nothing")]
    return spark.createDataFrame([(*r, "y", "z", 3) for r in rows], "doc_id long, text string, source string, h1 string, _doc string, size int")


@pytest.mark.parametrize("budget", [None, 1000.0])
def test_mixing_takes_what_the_queue_serves(spark, mixed_docs, folders, budget):
    for docs in (mixed_docs, spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{folders[0]}/documents.parquet")):
        keys = mixing.keyed(docs, mixing.count_words(mixing.text_or_empty()), ["doc_id", "text"])
        rows = [tuple(r) for r in keys.select("s", "h1", "h2", "size").collect()]
        sizes = collections.Counter()
        for s, _, _, n in rows:
            sizes[s] += n
        want = targets(sizes)
        end = 1.0 if budget is None else min(1.0, budget / sum(want.values()))
        got = mixing.mix(spark, keys, budget=budget).withColumn("taken", F.col("whole") * F.col("size") + F.col("part"))
        got = got.select(mixing.source_key("_doc.source").alias("s"), mixing.row_key("_doc.doc_id", "_doc.text")[0].bitwiseXOR(
            F.lit(11)).alias("h1"), mixing.row_key("_doc.doc_id", "_doc.text")[1].alias("h2"), "size", "taken", "target", "source_size").collect()
        assert collections.Counter(tuple(r)[:5] for r in got) == plain_mix(rows, want, sizes, end=end)
        taken = collections.Counter()
        for r in got:
            assert math.isclose(r["target"], want[r["s"]], rel_tol=1e-9) and r["source_size"] == sizes[r["s"]]
            taken[r["s"]] += r["taken"]
        assert all(abs(taken[s] - want[s] * end) < 1 + 1e-6 for s in sizes)


def test_mixing_query(spark, folders):
    for sf in (folders[0], SF):
        got = mixing.query(spark, sf).collect()
        assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
        assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.query(spark, sf).collect()), key=str)


def test_mixing_order(spark, mixed_docs):
    keys = mixing.keyed(mixed_docs, mixing.count_words(mixing.text_or_empty()), ["doc_id", "text"])
    queued = mixing.queue(spark, keys)
    rows = mixing.schedule(spark, queued).collect()
    assert [r["finish"] for r in rows] == sorted(r["finish"] for r in rows)
    served = 0
    for r in rows:
        served += r["taken"]
        assert r["served"] == served
    assert max(r["pass"] for r in rows) == 1


def test_mixing_stage(spark, mixed_docs):
    docs = mixed_docs.withColumn("n_chars", F.length("text")).withColumn("lang", F.lit("en"))
    out = mixing.stage(spark, docs, SF)
    assert out.columns == docs.columns
    got = collections.Counter()
    for r in out.collect():
        assert (r["h1"], r["_doc"], r["size"]) == ("y", "z", 3) and r["n_chars"] == len(r["text"])
        got[r["doc_id"]] += len(words(r["text"]))
    keys = mixing.keyed(docs, mixing.count_words(mixing.text_or_empty()), ["doc_id", "text"])
    want = mixing.mix(spark, keys).groupBy("_doc.doc_id").agg(F.sum(F.col("whole") * F.col("size") + F.col("part")).alias("n"))
    assert got == {r["doc_id"]: r["n"] for r in want.collect() if r["n"]}


# 8 ---------------------------------------------------------------------------------------------

def test_near_classes(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    s = {r["doc_id"]: order_minhash.labelled_shingles(order_minhash.normal_words(r["text"])) for r in rows}
    sets = {i: frozenset(x.tolist()) for i, x in s.items()}
    where = collections.defaultdict(list)
    for i, x in sets.items():
        for h in x:
            where[h].append(i)
    root = {i: i for i in s}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in {(v[x], v[y]) for v in where.values() if len(v) > 1 for y in range(len(v)) for x in range(y)}:
        if len(sets[a] & sets[b]) >= 0.8 * (len(sets[a]) + len(sets[b])) / 1.8 and order_minhash.similarity(s[a], s[b]) >= 0.8:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.query(spark, "/root/testdata/sf0.01").collect()}
    assert got == {i: find(i) for i in s}


def brute_classes(texts):
    """Smallest number of each text's class, from the similarities of all pairs."""
    s = [order_minhash.labelled_shingles(order_minhash.normal_words(t)) for t in texts]
    sets, root = [frozenset(x.tolist()) for x in s], list(range(len(s)))
    for i in range(len(s)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * (len(s[i]) + len(s[j])) / 1.8 - 1e-9 and order_minhash.similarity(s[i], s[j]) >= 0.8:
                x, y = sorted((root[i], root[j]))
                root = [x if r == y else r for r in root]
    return root


def near_classes(spark, folder, texts):
    sf = write(spark, folder, documents=spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.query(spark, sf).collect()}
    return [got[i] for i in range(len(texts))]


def test_near_family_under_one_template(spark, tmp_path):
    """Pairs of 0.81 in a family of 0.78: most keys that a pair shares hold words of the template only."""
    rng = random.Random(8)
    template, texts = " ".join(f"t{i}" for i in range(176)), []
    for _ in range(100):
        own = [f"u{rng.randrange(10**9)}" for _ in range(24)]
        texts += [" ".join([template, *own]), " ".join([template, *own[:8], *(f"v{rng.randrange(10**9)}" for _ in range(16))])]
    want = brute_classes(texts)
    assert len(set(want)) == 100
    assert sum(g != w for g, w in zip(near_classes(spark, tmp_path, texts), want, strict=True)) == 0


def test_near_chain_in_a_group_of_copies(spark, tmp_path):
    """A-B and B-C are linked, A-C is not, and A is the centre of most buckets of B and C."""
    rng = random.Random(9)

    def edited(w, at, n):
        return [*w[:at], *(f"e{rng.randrange(10**9)}" for _ in range(n)), *w[at + n:]]

    a = [f"a{i}" for i in range(200)]
    texts = [a] + [edited(a, rng.randrange(200), 1) for _ in range(250)]
    for _ in range(60):
        b = edited(a, rng.randrange(5, 90), 1)
        texts += [b, edited(b, rng.randrange(100, 180), 16)]
    texts = [" ".join(w) for w in texts]
    want = brute_classes(texts)
    assert set(want) == {0}
    assert sum(g != w for g, w in zip(near_classes(spark, tmp_path, texts), want, strict=True)) == 0


def test_near_short_texts(spark, tmp_path):
    """8 against 9 words and the like: texts of few shingles that differ by one word at an end."""
    texts = []
    for n in range(5, 20):
        for i in range(6):
            w = [f"s{n}x{i}y{j}" for j in range(n + 1)]
            texts += [" ".join(w[:n]), " ".join(w)]
    want = brute_classes(texts)
    assert want[36:48] == [36, 36, 38, 38, 40, 40, 42, 42, 44, 44, 46, 46]  # 8 and 9 words
    assert sum(g != w for g, w in zip(near_classes(spark, tmp_path, texts), want, strict=True)) == 0


def test_near_awkward(spark, folders):
    got = collections.defaultdict(set)
    for r in order_minhash.query(spark, folders[0]).collect():
        got[r["doc_id"]].add(r["class_id"])
    assert got[5] == got[6] == got[7] == {5}
    assert got[8] == {8} and got[1] == {1} and got[2] == {2} and got[None] == {None}


def test_alignment_is_ordered():
    w = [f"w{i}" for i in range(200)]
    a = order_minhash.labelled_shingles(w)
    assert order_minhash.similarity(a, a) == 1.0
    assert order_minhash.similarity(a, order_minhash.labelled_shingles(w[100:] + w[:100])) == 0.0
    assert order_minhash.similarity(a, order_minhash.labelled_shingles([*w[:100], "new", *w[100:]])) > 0.9
    same = order_minhash.labelled_shingles(["x"] * 50)
    assert len(set(same.tolist())) == len(same) == 46


# 9 ---------------------------------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 4097])
def test_feistel_is_a_bijection(n):
    p = sharding.permute(np.arange(n), n)
    assert sorted(p.tolist()) == list(range(n))
    assert (sharding.permute(p, n, inverse=True) == np.arange(n)).all()
    shard, slot = sharding.place(n - 1, n, 16)
    assert sharding.unplace(shard, slot, n, 16) == n - 1


def test_sharding(spark, folders, awkward):
    for sf in (folders[0], SF):
        rows = sharding.query(spark, sf).collect()
        n = len(rows)
        by = collections.defaultdict(list)
        for r in rows:
            by[r["shard"]].append(r["slot"])
            assert sharding.place(r["row_no"], n, 16) == (r["shard"], r["slot"])
        assert all(sorted(v) == list(range(len(v))) for v in by.values())
        assert max(map(len, by.values())) - min([len(by[s]) for s in range(min(16, n))]) <= 1
        assert {(r["doc_id"], r["shard"], r["slot"]) for r in rows} == {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.query(
            spark, sf).collect()}
    got = collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in sharding.query(spark, folders[0]).collect())
    assert got == collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in awkward)


# 10 --------------------------------------------------------------------------------------------

def brute_topk(rows, k=5):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for i, q in good:
        if i % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i and len(v) == len(q))[:k]
            out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(best)}
    return out


def test_topk(spark, folders):
    for sf in (folders[0], SF):
        rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
        assert {tuple(r) for r in topk.query(spark, sf).collect()} == brute_topk(rows)
    assert topk.query(spark, folders[1]).count() == 0


def test_topk_blocks_and_chunks(spark):
    v = topk.quantize(spark.read.parquet(f"{SF}/embeddings.parquet"))
    one = {tuple(r) for r in topk.search(spark, v, F.col("vec_id") % 50 == 0).collect()}
    for block_rows, query_bytes in ((40, 8 << 20), (7, 700), (4000, 2000)):
        some = topk.search(spark, v, F.col("vec_id") % 50 == 0, block_rows=block_rows, query_bytes=query_bytes)
        assert {tuple(r) for r in some.collect()} == one


def test_topk_ties_and_a_hot_vector(spark):
    """A third of all rows is one vector; scores tie across blocks and tasks."""
    rng = random.Random(3)
    hot = [0.5, -0.5, 0.25, 1.0, 0.0, 0.0, 0.75, -1.0]
    rows = [(i, hot if i % 3 == 0 else [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(8)]) for i in range(400)]
    v = topk.quantize(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5))
    for block_rows in (3, 50, 4000):
        assert {tuple(r) for r in topk.search(spark, v, F.col("vec_id") % 50 == 0, block_rows=block_rows).collect()} == brute_topk(rows)
    few = rows[:3]
    v = topk.quantize(spark.createDataFrame(few, "vec_id long, embedding array<float>"))
    assert {tuple(r) for r in topk.search(spark, v, F.col("vec_id") % 50 == 0).collect()} == brute_topk(few)


def test_nodes_whose_hashes_collide(spark):
    rows = spark.createDataFrame([(1, 10), (1, 11), (1, 12), (2, 10), (3, 3), (None, None)], "k1 long, k2 long")
    found = rows.filter("k1 is not null")
    moved = order_minhash.renamed_nodes(spark, found)
    assert moved.count() == 2
    named = order_minhash.node_names(rows, moved).collect()
    assert len({r["k"] for r in named}) == 6 and {r["k"] for r in named if r["k1"] != 1} == {2, 3, None}
    assert order_minhash.renamed_nodes(spark, found.filter("k1 > 1")) is None


# pipeline --------------------------------------------------------------------------------------

def plain_rest(text, gone):
    """The text without words that are ``gone``; words that stay next to each other keep what is between them."""
    found = list(re.finditer(r"[^\x20\x09-\x0D]+", text))
    if not any(gone):
        return text
    out, last = "", None
    for i, m in enumerate(found):
        if not gone[i]:
            out += (text[found[i - 1].end():m.end()] if last == i - 1 and last is not None else (" " if out else "") + m[0])
            last = i
    return out


def test_pipeline(spark):
    """The five stages against a plain Python chain over rows, texts and ids."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    model = toxicity.fitted(spark, docs, SF)
    rows = [r for r in rows if model.score(r[1] or "") < 0.7]
    rows.sort(key=lambda r: r[0])
    rows = [r for i, (r, c) in enumerate(zip(rows, brute_classes([r[1] or "" for r in rows]))) if c == i]
    split = [words(r[1] or "") for r in rows]
    seen = collections.Counter(tuple(w[k:k + 35]) for w in split for k in range(len(w) - 34))
    cut = []
    for r, w in zip(rows, split):
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if seen[tuple(w[k:k + 35])] > 1:
                gone[k:k + 35] = [True] * 35
        cut.append((r[0], plain_rest(r[1] or "", gone) if any(gone) else r[1], r[2], r[3]))
    df = spark.createDataFrame(cut, "doc_id long, text string, lang string, source string")
    keys = [tuple(r) for r in mixing.keyed(df, mixing.count_words(mixing.text_or_empty()), ["doc_id", "text"]).select(
        "s", "h1", "h2", "size", "_doc.doc_id").collect()]
    sizes = collections.Counter()
    for s, _, _, n, _ in keys:
        sizes[s] += n
    taken = plain_mix([k[:4] for k in keys], targets(sizes), sizes)
    words_of = {k[:4]: n for k in taken for n in [k[4]]}
    text = {r[0]: r for r in cut}
    lib = Tokenizer.from_file(bpe.vocabulary())
    want = collections.Counter()
    for *key, doc_id in keys:
        n, size = words_of[tuple(key)], key[3]
        _, t, lang, source = text[doc_id]
        copies = [t] * (n // size if size else 0) + ([" ".join(words(t)[:n % size])] if size and n % size else [])
        for c in copies:
            want[doc_id, lang, source, tuple(lib.encode(c, add_special_tokens=False).ids)] += 1
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids"]
    got = out.collect()
    assert all(len(r["ids"]) == r["n_tokens"] for r in got)
    assert collections.Counter((r["doc_id"], r["lang"], r["source"], tuple(r["ids"])) for r in got) == want


def test_stages_keep_columns_and_whole_rows(spark):
    import corpus_pipeline

    now = spark.read.parquet(f"{SF}/documents.parquet")
    cols = now.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF)
        assert now.columns == cols, name
        assert not now.filter("text is not null and n_chars != length(text)").count(), name
