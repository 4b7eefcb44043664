"""Operator 12 against a plain ranking."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tickloom.llm import treaps

from .conftest import DOCS

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return Counter(TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))


def brute(rows, items, k=20):
    docs = [(d, terms_of(t)) for d, t in rows if d is not None and terms_of(t)]
    n_docs, n_terms = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(terms_of(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for d, c in docs:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in wanted.items() if t in c)
            if s > 0:
                scored.append((-s, d))
        out += [(item, r, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def made(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "日本", "a_b", "X9", "don't", "re-do"]
    text = lambda m: " ".join(rng.choice(words[: rng.choice([5, 20, 66])]) for _ in range(rng.randint(0, m)))
    rows = [(rng.randint(0, n), text(50)) for _ in range(n)]
    rows += [(9000 + i, rows[3][1]) for i in range(30)] + [(None, "w1 w2"), (5000, None), (5001, ""), (5002, "-- ,"), (5003, "w1 " * 3000)]
    items = [(i, text(12)) for i in range(25)] + [(30, rows[3][1]), (31, None), (32, "nowhere"), (33, "w1"), (33, "w2 w1"), (34, "W1 w1,w1")]
    return rows, items


@pytest.mark.parametrize("segment_bytes", [24 << 20, 2000])
def test_ranking_equals_a_plain_one(spark, segment_bytes):
    rows, items = made(1)
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    got = treaps.search(treaps.build(docs, segment_bytes), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(map(tuple, got)) == brute(rows, items)


def test_floors_of_the_first_segments_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(treaps, "SEEDS", 2)
    rows, items = made(2)
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    index = treaps.build(docs, 1500)
    assert index.rows.filter("term is null").count() >= 8
    for asked in (treaps.ASKED, 40):  # the second in several blocks of queries
        monkeypatch.setattr(treaps, "ASKED", asked)
        got = treaps.search(index, spark.createDataFrame(items, "item_id long, text string"), 3).collect()
        assert sorted(map(tuple, got)) == brute(rows, items, 3)


def test_treaps_have_both_orders():
    rng = np.random.default_rng(3)
    for top in (3, 10**6):
        counts = np.array([1, 7, 500, 2, 300, 1])
        starts = np.cumsum(counts) - counts
        impact = rng.integers(0, top, counts.sum())
        left, right, root = treaps.links(impact, starts)
        assert len(root) == len(counts)
        for r, a, n in zip(root, starts, counts, strict=True):
            todo, seen = [(r, a, a + n)], 0
            while todo:
                x, low, high = todo.pop()
                assert low <= x < high and impact[x] == impact[low:high].max()
                seen += 1
                for child, x0, x1 in ((left[x], low, x), (right[x], x + 1, high)):
                    assert (child < 0) == (x0 == x1)
                    if child >= 0:
                        todo.append((child, x0, x1))
            assert seen == n


def test_long_lists_of_one_direction_are_linked_in_few_steps():
    for impact in (np.arange(200_000), np.arange(200_000)[::-1].copy(), np.zeros(200_000, np.int64)):
        left, right, root = treaps.links(impact, np.array([0]))
        assert len(root) == 1 and (left >= 0).sum() + (right >= 0).sum() == len(impact) - 1


def test_most_documents_are_not_scored():
    """Rare terms in few documents: what lies apart from them is dropped by its bound."""
    rng = np.random.default_rng(5)
    n = 20_000
    common = np.sort(rng.choice(n, 15_000, replace=False))
    rare = np.sort(rng.choice(n, 60, replace=False))
    counts = np.array([len(common), len(rare)])
    segment = treaps.Segment(np.arange(n), counts, np.concatenate([common, rare]), np.concatenate([rng.integers(1, 900, len(common)), rng.integers(400, 900, len(rare))]))
    score, at = segment.best(np.array([0, 1]), np.array([50, 9000]), 20, 1)
    full = np.zeros(n, np.int64)
    np.add.at(full, segment.docs, segment.impact * np.repeat([50, 9000], counts))
    want = np.lexsort((np.arange(n), -full))[:20]
    assert at.tolist() == want.tolist() and score.tolist() == full[want].tolist()
    assert segment.scored < 0.2 * n


def test_messy(spark, messy, empty):
    rows = [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]
    items = messy.selectExpr("doc_id AS item_id", "text", "source", "key")
    got = treaps.search(treaps.build(messy), items).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_with_null(rows), key=str)
    assert treaps.search(treaps.build(empty), items).count() == 0
    assert treaps.search(treaps.build(messy), empty.selectExpr("doc_id AS item_id", "text")).count() == 0


def brute_with_null(rows):
    """Queries are the documents; those without an id are one query."""
    out = brute(rows, [(-1 if d is None else d, t) for d, t in rows])
    return [(None if i == -1 else i, *r) for i, *r in out]
