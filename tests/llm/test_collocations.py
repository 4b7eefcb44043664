"""Operator 13 against a plain count."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tickloom.llm import collocations

from .conftest import DOCS


def brute(rows, least, first=2000):
    f, total, out = Counter(), Counter(), []
    for lang, text in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for n in range(1, 6):
                for i in range(len(w) - n + 1):
                    f[lang, tuple(w[i : i + n])] += 1
    own = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    inside = defaultdict(int)
    for (lang, w), a in own.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                inside[lang, w[i : i + m]] = max(inside[lang, w[i : i + m]], a)
    ranked = defaultdict(list)
    for (lang, w), a in own.items():
        if inside[lang, w] < a:
            s, k = min((1000 * a * total[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
            ranked[lang].append((-s, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    for lang, got in ranked.items():
        for rank, (s, a, phrase, left, right) in enumerate(sorted(got)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -s))
    return out


def made(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["New", "york", "The", "a", "é", "日本", "of", "x" * 40, "b c"])
    fixed = ["the state of new york", "machine learning model", "a b"]
    rows = []
    for _ in range(150):
        text = ""
        for _ in range(rng.randint(0, 25)):
            text += (rng.choice(fixed) if rng.random() < 0.3 else word()) + rng.choice([" ", " ", "  ", "\t", ", ", ". ", "\n", "\r\n", "!"])
        rows.append((rng.choice(["en", "fr", None]), text))
    return rows + [(None, None), ("en", ""), ("de", " .. ,, "), ("en", "One very common line\n" * 300), (None, "und " * 40)]


@pytest.mark.parametrize(("least", "first", "shard_bytes"), [(3, 2000, 8 << 20), (2, 7, 900), (20, 2000, 3000)])
def test_phrases_equal_a_plain_count(spark, least, first, shard_bytes):
    rows = made(least)
    docs = spark.createDataFrame([(i, text, lang, None, None) for i, (lang, text) in enumerate(rows)], DOCS)
    got = collocations.mine(docs, least, first, shard_bytes).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, least, first))


@pytest.mark.parametrize("bits", [4, 7, 10])
def test_cells_that_hold_several_phrases_change_nothing(spark, bits):
    rows = made(9)
    docs = spark.createDataFrame([(i, text, lang, None, None) for i, (lang, text) in enumerate(rows)], DOCS)
    got = collocations.phrases(collocations.counts(docs, 5, 2000, bits=bits).checkpoint())
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, 5))


def test_products_beyond_64_bits_are_exact(spark):
    big = [(10**17 + 3, 9 * 10**17 + 7, 10**17 + 9, 10**17 + 11), (3 * 10**16, 3 * 10**17, 3 * 10**16 + 1, 3 * 10**16 + 7), (100, 9 * 10**16, 100, 100)]
    frame = spark.createDataFrame(big, "a long, n long, l long, r long")
    got = frame.selectExpr("a", f"{collocations.score('a', 'n', 'CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0))')} AS s").collect()
    assert {r.a: r.s for r in got} == {a: 1000 * a * n // (x * y) for a, n, x, y in big}


def test_pieces_are_counted_once_with_their_copies(spark):
    rows = [("en", "A b.  a   B;c\td"), (None, "a b")]
    docs = spark.createDataFrame([(i, text, lang, None, None) for i, (lang, text) in enumerate(rows)], DOCS)
    assert sorted(map(tuple, collocations.pieces(docs).collect())) == [("en", "a b", 2), ("en", "c d", 1), ("und", "a b", 1)]


def test_messy(spark, messy, empty):
    rows = [(r.lang, r.text) for r in messy.select("lang", "text").collect()]
    assert sorted(map(tuple, collocations.mine(messy, 2).collect())) == sorted(brute(rows, 2))
    assert collocations.mine(empty).count() == 0
