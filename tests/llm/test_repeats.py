"""Operators 1 and 5 against brute force, over one shard and over many."""

import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tickloom.llm import _ranges, repeats, substrings, suffixes

from .conftest import DOCS


@pytest.mark.parametrize("period", sorted(repeats.COVERS))
def test_covers_have_every_difference(period):
    cover = repeats.COVERS[period]
    assert {(a - b) % period for a, b in itertools.product(cover, cover)} == set(range(period))


def test_names_come_back():
    rng = np.random.default_rng(1)
    names = np.unique(rng.integers(0, 1 << 63, 1000, dtype=np.uint64))
    assert (repeats.unpack_names(repeats.pack_names(names, 0), 0) == names).all()
    one = np.array([np.uint64(2**64 - 1)])
    assert (repeats.unpack_names(repeats.pack_names(one, 5), 5) == one).all()


def brute_bytes(rows, width=50):
    first, out = {}, []
    for doc_id, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        raw = (text or "").encode()
        for i in range(len(raw) - width + 1):
            first.setdefault(raw[i : i + width], doc_id)
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - width + 1):
            if doc_id is not None and first[raw[i : i + width]] < doc_id:
                gone[i : i + width] = b"\1" * width
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def brute_words(rows, width=35):
    seen = Counter(tuple(w[i : i + width]) for _, t in rows for w in [(t or "").encode().split()] for i in range(len(w) - width + 1))
    out = []
    for doc_id, text in rows:
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    return Counter(out)


def made(seed):
    """Random texts that share passages of lengths about the window's."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7)))
    passages = [[word() for _ in range(rng.randint(5, 60))] for _ in range(12)]
    rows = []
    for i in range(60):
        text = [word() for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            at = rng.randint(0, len(text))
            text[at:at] = p[rng.randint(0, 3) : len(p) - rng.randint(0, 3)]
        rows.append((i * 3, " ".join(text)))
    rows += [(500, rows[7][1]), (501, rows[7][1]), (502, None), (503, ""), (None, rows[8][1]), (21, rows[9][1]), (21, rows[7][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_bytes", [1 << 24, 1500])
def test_bytes(spark, shard_bytes):
    rows = made(1)
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    got = suffixes.remove_repeats(docs, shard_bytes=shard_bytes).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_bytes(rows)
    assert all(hashlib.sha256(r.kept_bytes).hexdigest() == r.kept_sha256 for r in got)


@pytest.mark.parametrize("shard_bytes", [1 << 24, 1500])
def test_words(spark, shard_bytes):
    rows = made(2)
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    got = substrings.remove_repeats(docs, shard_bytes=shard_bytes).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_words(rows)


def packed(rows):
    """Rows of one shard as one chunk."""
    body = np.array([[d or 0 for d, _ in rows], [d is None for d, _ in rows], [len(t) for _, t in rows]], np.int64)
    raw = b"".join(t for _, t in rows)
    return {"shard": 0, "bytes": len(raw), "ids": body.tobytes(), "texts": pa.compress(raw, codec="zstd", asbytes=True)}


@pytest.mark.parametrize("words", [False, True])
def test_a_shard_is_the_same_however_its_rows_arrive(words):
    rows = [(7, b"a" * 60), (7, b"b" * 5), (7, b"a" * 70), (None, b"y x"), (None, b"x y"), (3, b""), (7, b"b" * 5)]
    job = repeats.Job(words, 50, 21, True, True)
    seen = set()
    for order in itertools.islice(itertools.permutations(rows), 0, 5040, 97):
        table = pa.Table.from_pylist([packed(order[:3]), packed(order[3:])])
        shard = repeats.Shard(table, job)
        seen.add((tuple(shard.text), tuple(shard.id.tolist()), tuple(shard.null.tolist())))
    assert len(seen) == 1


@pytest.mark.parametrize("coarse", [2048, 4])
def test_a_doc_id_of_many_texts_is_many_shards(spark, monkeypatch, coarse):
    monkeypatch.setattr(_ranges, "COARSE", coarse)
    rows = made(3)
    rows += [(30, t) for _, t in rows[:40]] + [(31, t) for _, t in rows[:5]]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    own = docs.filter("doc_id is not null")
    ranges = _ranges.split(own, "doc_id", _ranges.F.lit(1), len(rows), 4)
    assert (np.diff(ranges.rank) >= 0).all() and len(set(ranges.place(np.full(50, 30), np.arange(50)).tolist())) > 3
    ids = np.sort([r[0] for r in rows if r[0] is not None])
    at = ranges.place(ids, np.zeros(len(ids), int))
    assert (np.diff(ranges.rank[at]) >= 0).all()
    got = suffixes.remove_repeats(docs, shard_bytes=1200).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_bytes(rows)


def test_merged_answers():
    lists = [[1, 5, 9], [5, 7], [5, 9]]
    rank = np.array([0, 1, 1])
    out = list(repeats.merged(0, [(k, repeats.pack_names(np.array(x, np.uint64), 0)) for k, x in enumerate(lists)], 1, 8, rank))
    table = pa.table({"part": [p for p, _, _ in out], "body": [b for _, _, b in out]})
    got = [repeats._bits(table.slice(k, 1), [len(x)]) for k, x in enumerate(lists)]
    assert [g[0].tolist() for g in got] == [[False, True, True], [True, False], [True, True]]
    assert [g[1].tolist() for g in got] == [[False, False, False], [True, False], [True, True]]


def test_a_passage_that_very_many_documents_hold(spark):
    """Two first samples are common to all; what differs is in the third. Cut keys would take some for equal."""
    passage = "the passage which every one of these documents has, 60 bytes "[:60]
    rows = [(i, passage + hashlib.sha256(str(i).encode()).hexdigest()[:44]) for i in range(300_000)]
    docs = spark.createDataFrame(pd.DataFrame(rows, columns=["doc_id", "text"]))
    got = suffixes.remove_repeats(docs, with_bytes=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").toPandas()
    assert Counter(got.itertuples(index=False, name=None)) == brute_bytes(rows)


def thue_morse(n):
    """The word of n letters and its complement; polynomial hashes modulo 2^64 take them for equal from 1,024 letters on."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [16, 31, 32, 64, 1024, 2048, 4096])
def test_long_words_that_polynomials_confuse(spark, n):
    a, b = thue_morse(n)
    same = " ".join(f"w{i}" for i in range(34))
    rows = [(1, f"{same} {a}"), (2, f"{same} {b}"), (3, f"{a} {same}"), (4, f"x {b} {same} y"), (5, f"x {b} {same} z")]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    got = substrings.remove_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_words(rows)


def test_messy(spark, messy):
    rows = [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]
    a = suffixes.remove_repeats(messy).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in a) == brute_bytes(rows)
    b = substrings.remove_repeats(messy).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in b) == brute_words(rows)


def test_empty(empty):
    assert suffixes.remove_repeats(empty).count() == 0 and substrings.remove_repeats(empty).count() == 0
