"""Operator 4 against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

from tickloom.llm import minhash
from tickloom.llm.components import components

from .conftest import DOCS


def sets_of(rows, size):
    out = {}
    for i, (_, text) in enumerate(rows):
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
        out[i] = frozenset() if not w else frozenset([tuple(w)]) if len(w) < size else frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
    return out


def brute(rows, size, num, den=100):
    sets = sets_of(rows, size)
    up = {d: d for d, _ in rows if d is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (d, _) in enumerate(rows):
        for j, (e, _) in enumerate(rows[:i]):
            both = len(sets[i] & sets[j])
            if d is not None and e is not None and both and den * both >= num * len(sets[i] | sets[j]):
                a, b = root(d), root(e)
                up[max(a, b)] = min(a, b)
    return Counter((d, len(sets[i]), None if d is None else root(d), d is None or root(d) == d) for i, (d, _) in enumerate(rows))


def made(seed, base_words=70):
    rng = random.Random(seed)
    rows = []
    for g in range(6):
        base = [f"g{g}w{rng.randint(0, 300)}" for _ in range(base_words)]
        for _ in range(25):
            text = list(base)
            for _ in range(rng.randint(0, 5)):
                text[rng.randrange(len(text))] = f"n{rng.randint(0, 9999)}"
            rows.append(" ".join(text))
    rows += ["a b", "A B", "a", None, "", rows[0].upper(), rows[3], rows[3]]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("size", "num"), [(3, 85), (5, 80)])
def test_components_equal_those_of_all_pairs(spark, size, num):
    rows = made(4)
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    got = minhash.near_duplicates(docs, size, num).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute(rows, size, num)


def test_large_groups_are_cut_into_units(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rows = made(5)
    rows.append((3, rows[40][1]))  # a doc_id with two texts is one node
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    got = minhash.near_duplicates(docs, 3, 85).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute(rows, 3, 85)


def test_chains_of_unlike_texts_are_taken_apart(spark, monkeypatch):
    """Pages whose common part is less than half: one rough cluster, whose links are few."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "FEWER", 1)
    rng = random.Random(8)
    common = [f"c{k}" for k in range(40)]
    pages = [[*common, *(f"p{i}w{k}" for k in range(45))] for i in range(200)]
    rows = [" ".join(p) for p in pages] + [" ".join([*p[:-1], "other"]) for p in pages[::5]]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    seen = {}
    plain = minhash.refined

    def watched(clusters, *rest):
        out = plain(clusters, *rest)
        seen["rough"], seen["fine"] = (max([r["count"] for r in x.groupBy("cluster").count().collect()]) for x in (clusters, out))
        return out

    monkeypatch.setattr(minhash, "refined", watched)
    got = minhash.near_duplicates(docs, 3, 85).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute(rows, 3, 85)
    assert seen["rough"] > 100 and seen["fine"] < 20, seen


def test_texts_come_without_a_broadcast_too(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", 0)
    rows = made(6, 40)
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    got = minhash.near_duplicates(docs, 3, 85).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute(rows, 3, 85)


def test_a_unit_joins_what_is_similar_only():
    sets = [np.arange(0, 100, dtype=np.uint64), np.arange(5, 105, dtype=np.uint64), np.arange(60, 160, dtype=np.uint64)]
    sig = np.concatenate([minhash.mix(minhash.signatures(s, np.array([0, len(s)]))).astype(np.uint16) for s in sets])
    assert len(minhash.links_of_unit([1, 2, 3], np.zeros(3), sig, sets, True, 85, 100)) == 1


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (100, 100), (None, 5)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    assert components(edges.filter("a < 0")).count() == 0


def test_messy(messy):
    rows = [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]
    got = minhash.near_duplicates(messy, 3, 85).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute(rows, 3, 85)
    kept = minhash.keep_one(messy)
    assert kept.columns == messy.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({1: 1, 4: 1, 5: 1, 6: 1, None: 2, 7: 1, 8: 1, 9: 2, 10: 1})


def test_empty(empty):
    assert minhash.near_duplicates(empty).count() == 0 and minhash.keep_one(empty).count() == 0


def test_long_words_that_polynomials_confuse(spark):
    from .test_repeats import thue_morse

    for n in (1024, 2048, 4096):
        a, b = thue_morse(n)
        rows = [(1, f"{a} q r"), (2, f"{b} q r"), (3, f"{a} Q R"), (4, f"{a} {b} q r"), (5, f"{b} {a} q r")]
        docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
        got = minhash.near_duplicates(docs, 3, 85).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute(rows, 3, 85)
