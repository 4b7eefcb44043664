"""Operators 6, 7 and 10: base rules against plain versions, models on what they have not seen, edge cases."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tickloom.llm import langid, pii, quality

from .conftest import DOCS


SF = "/root/testdata/sf0.001"


# --- personal data ---------------------------------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    digits = lambda m: re.sub(r"[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


TRICKY = [
    "a@b.c_d@e.f x@y x@y.z@w.v @@a@b.co a@-.- a@b..c", "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.256 0001.2.3.0255 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 41111111111111111111",
    "+1 (555) 123-4567 +12 3 + 4 +1-2-3-4-5-6-7-8-9 +123456789012345678", "+49 30 1234567, 10.0.0.1; a.b@c.org", "", "é@é.é a@b.é.c", "9" * 5000, "a" * 5000, "." * 3000 + "@" + "." * 3000, "1." * 2000, "+1" + " " * 3000,
]


@pytest.mark.parametrize("text", TRICKY)
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_base_spans_on_documents(spark):
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect():
        assert pii.base_spans(r.text or "") == plain_spans(r.text or "")


@pytest.mark.parametrize(("text", "kind"), [("iban DE89 3704 0044 0532 0130 00 .", "iban"), ("host 2001:0db8:85a3::8a2e:0370:7334 is up", "ip"), ("ssn 078-05-1120 x", "id"), ("mail anna at example dot com .", "email"), ("phone (555) 123-4567 now", "phone"), ('token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" x', "secret")])
def test_the_method_adds(text, kind):
    assert kind in {s[0] for s in pii.chooser().choose(text, pii.base_spans(text))}


@pytest.mark.parametrize("text", ["he looked at the dot in the book", "on 2024-01-02 we sold 300 units", "see section 3.4.5 and version 12.4.1", "the token was old and the key: rusty", "at 12:30:45 the ratio was 1:2:3 in std::vector", "iban DE00370400440532013000", "part 123-45-6789 is sold out"])
def test_the_method_leaves_clean_texts(text):
    assert pii.chooser().choose(text, pii.base_spans(text)) == []


@pytest.mark.parametrize("n", [200, 256, 257, 600, 5000])
def test_long_secrets_are_found_to_their_end(n):
    secret = ("24be64439e3e49cf46b2d7c90f3602a3d0b907ff" * (n // 40 + 1))[:n]
    text = f'token = "{secret}" x'
    assert ("secret", 9, 9 + n) in pii.candidates(text)
    assert pii.redacted(text) == 'token = "[SECRET]" x'


@pytest.mark.parametrize(("local", "last"), [("anna", "com"), ("anna" * 40, "com"), ("anna", "com" * 40), ("anna", "a dot b dot c dot d dot e dot com")])
def test_obfuscated_addresses_are_proposed_whole(local, last):
    text = f"mail {local} at example dot {last} ."
    assert ("email", 5, len(text) - 2) in pii.candidates(text)


@pytest.mark.parametrize("half", [0, 1])
def test_trees_are_right_on_new_spans(half):
    """New spans in the forms that the trees have seen, and in forms that they have not."""
    import numpy as np

    x, y, kinds = (np.array(v) for v in pii._generated(np.random.default_rng(99), 3000, half))
    c = pii.chooser()
    taken = c._calibrated(c.trees.margin(x)) >= np.array([c.least[k] for k in kinds])
    assert y[taken].mean() > 0.95 and taken[y == 1].mean() > 0.95


def test_what_is_added_to_documents_is_planted(spark):
    """Every added span of the documents is one of the planted secrets."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    added = [r.text[a:b] for r in rows if r.text for k, a, b in pii.chooser().choose(r.text, pii.base_spans(r.text)) if (k, a, b) not in pii.base_spans(r.text)]
    assert added and all(re.fullmatch("[0-9a-f]{40}", s) for s in added)


def test_many_spans_take_no_more_than_their_number():
    import time

    def seconds(n):
        text = " ".join(f"a{i}@b.co call 555-123-{1000 + i}" for i in range(n))
        t = time.time()
        spans = pii.chooser().choose(text, pii.base_spans(text))
        assert len(spans) >= n
        return time.time() - t

    seconds(100)
    assert seconds(8000) < 8 * seconds(2000)


def test_spans_that_overlap():
    taken = [(0, 5), (10, 12), (20, 30)]
    plain = lambda a, b: any(x < b and y > a for x, y in taken)
    assert all(pii._overlaps(taken, a, b) == plain(a, b) for a in range(35) for b in range(a + 1, 36))


def test_pii_messy(spark, messy, empty):
    got = pii.find(messy).collect()
    assert len(got) == 13 and Counter(r.n_email for r in got) == Counter({0: 12, 1: 1})
    hit = next(r for r in got if r.doc_id == 10)
    assert (hit.n_email, hit.n_ip, hit.n_card, hit.n_phone) == (1, 1, 1, 1) and hit.spans.startswith("email:5:14,")
    out = pii.redact(messy)
    assert out.schema == messy.schema and out.count() == 13
    row = out.filter("doc_id = 10").first()
    assert row.text == "mail [EMAIL] or [PHONE], card [CARD] at [IP]" and row.n_chars == len(row.text)
    assert out.filter("doc_id is null and text is null").count() == 1
    assert pii.find(empty).count() == 0 and pii.redact(empty).count() == 0


# --- quality ---------------------------------------------------------------------------------------------------------


def plain_quality(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    again = set()
    for i in range(len(w) - 7):
        if grams[tuple(w[i : i + 8])] > 1:
            again |= set(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again), len(w) < 20 or 100 * len(again) > 30 * len(w)


def check_base(got, docs):
    want = Counter((r.doc_id, *plain_quality(r.text)) for r in docs)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want


def test_quality_on_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.judge(docs, quality.fit(docs, labels)).collect()
    check_base(got, docs.select("doc_id", "text").collect())
    assert not any(r.kept and r.base_failed for r in got)
    label = {r.doc_id: (r.quality, r.toxic) for r in labels.collect()}
    good = [r.kept for r in got if label.get(r.doc_id) == (1, 0) and not r.base_failed]
    bad = [r.kept for r in got if label.get(r.doc_id, (1, 0))[0] == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.3


def test_long_words_that_polynomials_confuse(spark, messy):
    from .test_repeats import thue_morse

    a, b = thue_morse(2048)
    eight = " ".join(f"w{i}" for i in range(7))
    rows = [(1, f"{eight} {a} {eight} {b}"), (2, f"{eight} {a} {eight} {a}"), (3, f"{b} {eight} {a} {eight}")]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    check_base(quality.judge(docs, quality.fit(docs, labels)).collect(), docs.select("doc_id", "text").collect())


def test_scores_and_verdicts_equal_a_plain_sum(spark):
    """Score and `kept` of each document from the words themselves, with the cells' ratios taken as given."""
    import numpy as np

    from tickloom.llm._text import Words

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    half = len(model.ratio) // 2

    def name(words):  # of one or two words, as the hash that cells are made of
        raw = b" ".join(words)
        w = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        return int(w.hash[0]) if len(words) == 1 else int(w.grams(2)[0][0])

    got = {r.doc_id: r for r in quality.judge(docs, model).collect()}
    for r in docs.filter("length(text) < 3000").orderBy("doc_id").limit(60).collect():
        w = re.findall(rb"[^\x20\x09-\x0D]+", (r.text or "").encode())
        cells = [name([x]) % half * 2 for x in w] + [name([a, b]) % half * 2 + 1 for a, b in zip(w, w[1:], strict=False)]
        score = sum(float(model.ratio[c]) for c in cells) / (len(cells) + model.prior)
        assert got[r.doc_id].score == pytest.approx(score, abs=1e-5)
        if abs(score - model.threshold) > 1e-5:
            assert got[r.doc_id].kept == (not plain_quality(r.text)[-1] and score >= model.threshold)


def test_quality_learns_from_every_trusted_document(spark):
    """More than 20,000 trusted documents, where a bounded target stopped."""
    docs = spark.range(24_000).selectExpr("id AS doc_id", "concat('w', id, ' alpha') AS text")
    labels = spark.range(24_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    assert quality.target(docs, labels.union(labels)).count() == 24_000
    raw = quality.count_cells(docs, 1 << 17)
    goal = sum(quality.count_cells(quality.target(docs, labels).filter(f"half = {h}"), 1 << 17) for h in (0, 1))
    assert (raw == goal).all() and raw.sum() == 72_000


def test_quantile_is_exact(spark):
    values = [(float(x * 7919 % 1009),) for x in range(1009)] + [(None,)]
    scores = spark.createDataFrame(values, "score double").repartition(5)
    for share in (0.0, 0.0005, 0.25, 0.5, 1.0):
        assert quality.quantile(scores, share) == scores.agg(F.percentile("score", share)).first()[0]
    assert quality.quantile(scores.limit(0), 0.5) is None


def test_quality_moves_only_half_of_the_texts(spark):
    """The same plan for few and many labels: one half's texts are dealt by doc_id, of the other half only scores."""
    import numpy as np

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.Model(np.zeros(1 << 17, np.float32), 60.0, -np.inf)
    plan = lambda rows: rows._jdf.queryExecution().executedPlan().toString()
    held = quality.held_scores(docs, labels, model)
    for rows in (quality.target(docs, labels).filter("half = 0"), held):
        assert "ShuffledHashJoin" in plan(rows) and "BroadcastExchange" not in plan(rows)
    left = plan(held).split("MapInArrow")[0]
    assert left.count("Exchange hashpartitioning(doc_id") == 1
    plain = quality.judge(quality.target(docs, labels).filter("half = 1"), model).filter("not base_failed")
    assert held.count() == plain.count() > 0


def test_quality_messy(spark, messy, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, None), (None, 1, 0), (4, 1, 0), (9, None, None), (1, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(messy, labels)
    got = quality.judge(messy, model).collect()
    check_base(got, messy.select("doc_id", "text").collect())
    kept = quality.keep_good(messy, model)
    assert kept.schema == messy.schema and 0 < kept.count() < 13
    none = quality.fit(messy, labels.limit(0))
    assert all(r.kept != r.base_failed for r in quality.judge(messy, none).collect())
    assert quality.judge(empty, quality.fit(empty, labels)).count() == 0
    assert quality.judge(empty, model).count() == 0


# --- languages -------------------------------------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.predict(docs, langid.fit(docs), ("doc_id", "lang")).withColumn("held", langid.held_out(F.col("doc_id"))).filter("held and lang is not null").collect()
    assert len(got) > 150 and sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_languages_messy(spark, messy, empty):
    import zlib

    got = langid.predict(messy, langid.fit(messy)).collect()
    assert len(got) == 13 and {r.lang_pred for r in got if r.doc_id in (4, 5, 6)} == {"und"} and {r.score for r in got if r.doc_id == 4} == {0.0}
    none = messy.withColumn("lang", F.lit(None).cast("string"))
    assert langid.fit(none) is None and {r.lang_pred for r in langid.predict(none, None).collect()} == {"und"}
    assert langid.fit(empty) is None and langid.predict(empty, None).count() == 0
    held = {r.doc_id: r.h for r in messy.filter("doc_id is not null").select("doc_id", langid.held_out(F.col("doc_id")).alias("h")).collect()}
    assert held == {k: zlib.crc32(str(k).encode()) % 4 == 2 for k in held}


def plain_probabilities(net, window):
    """One window by the definition: each filter at each place, the largest value, softmax."""
    import math

    width, span = max(langid.WIDTHS), langid.WINDOW - max(langid.WIDTHS) + 1
    pooled = [0.0] * net.conv.shape[1]
    for at in range(span):
        cell = [float(x) for b in window[at : at + width] for x in net.embed[b]]
        for f in range(len(pooled)):
            pooled[f] = max(pooled[f], sum(x * float(w) for x, w in zip(cell, net.conv[:, f], strict=True)))
    z = [sum(p * float(w) for p, w in zip(pooled, net.dense[:-1, k], strict=True)) + float(net.dense[-1, k]) for k in range(len(net.langs))]
    e = [math.exp(x - max(z)) for x in z]
    return [x / sum(e) for x in e]


def test_predictions_equal_a_plain_network(spark):
    import numpy as np

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    net = langid.fit(docs)
    some = docs.orderBy("doc_id").filter("length(text) between 1 and 1500").limit(6)
    got = {r.doc_id: r for r in langid.predict(some, net).collect()}
    for r in some.collect():
        w = langid.windows(r.text.encode())
        mean = np.mean([plain_probabilities(net, x.tolist()) for x in w], 0)
        assert got[r.doc_id].score == pytest.approx(mean.max(), abs=1e-4) and got[r.doc_id].lang_pred == net.langs[int(mean.argmax())]


def test_no_language_is_left_out(spark):
    """2000 languages whose rows run by doc_id, more than the sample has room for at per_lang rows each."""
    docs = spark.range(6000).selectExpr("id as doc_id", "concat('text of language ', int(id / 3)) as text", "concat('l', int(id / 3)) as lang")
    labelled = {r.lang for r in docs.filter(~langid.held_out(F.col("doc_id"))).select("lang").distinct().collect()}
    net = langid.fit(docs, per_lang=800, max_rows=2500, per_doc=1)
    assert set(net.langs) == labelled and len(labelled) > 1900


def test_windows_cover_every_byte():
    for n in (0, 1, 127, 128, 129, 1000):
        text = bytes(i % 251 for i in range(n))
        w = langid.windows(text)
        assert w.shape[1] == langid.WINDOW and len(w) == max(1, -(-n // langid.WINDOW))
        assert w[: n // 128].tobytes() == text[: n // 128 * 128] and w[-1].tobytes() == text[-128:].ljust(128, b"\0")



def test_numbers_are_not_letters(spark):
    docs = spark.createDataFrame([(i, t, lang, None, None) for i, (t, lang) in enumerate([("plain words " * 20, "en")] * 12 + [("\u00bd \u00b2 42 \u2167", None), ("42 \u00e9", None)])], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, langid.fit(docs)).collect()}
    assert got[12] == "und" and got[13] == "en"
