"""Operators 2, 3, 8, 9 and the pipeline."""

import hashlib
import math
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tickloom.llm import chat, minhash, mixing, packing, pii, quality, topk
from tickloom.llm._state import shared_dir

# --- chats -----------------------------------------------------------------------------------------------------------


def test_escapes_come_back(spark):
    texts = ["<|im_end|>", "&lt;|", "&amp;lt;|", "a & b", "<|<|&", "", "<<||", "&nl;", "é<|"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(chat.F.col("t")).alias("e"))
    assert all("<|" not in r.e for r in df.collect())
    assert all(r.t == r.b for r in df.select("t", chat.unescape(chat.F.col("e")).alias("b")).collect())


CONV = "conv_id long, turn long, role string, text string, extra string"


def test_round_trip_and_mask(spark):
    rows = [(1, 0, "user", "hi <|im_end|>", "x"), (1, 1, "assistant", "a&b\nc", "x"), (1, 2, None, None, "x"), (1, 3, "assistant", "<|im_start|>assistant\nno", None), (2, 5, "role\nwith <|", "", None), (3, 0, "assistant", None, None), (3, 0, "assistant", None, None), (None, 0, "user", "lost", None)]
    got = {r.conv_id: r for r in chat.digest(chat.format_chats(chat.threads(spark.createDataFrame(rows, CONV)))).collect()}
    assert set(got) == {1, 2, 3}
    for conv in got:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1], r[2] or "", r[3] or ""))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert got[conv].n_turns == len(own) and got[conv].turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
        assert got[conv].loss_chars == len(loss) and got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_trees_give_their_best_branches(spark):
    nodes = [("t", 1, None, "user", "root", 0.0), ("t", 2, 1, "assistant", "bad", 0.1), ("t", 3, 1, "assistant", "good", 0.9), ("t", 4, 3, "user", "more", 0.8), ("t", 5, 3, "user", "less", 0.2), ("t", 6, 99, "user", "orphan", 0.05), ("u", 1, None, "user", "alone", None)]
    df = spark.createDataFrame(nodes, "tree string, node long, parent long, role string, text string, score double")
    got = [(r.tree, r.leaf, r["rank"], r.formatted.count("<|im_start|>")) for r in chat.format_chats(df, branches=2).orderBy("tree", "rank").collect()]
    assert got == [("t", 4, 1, 3), ("t", 5, 2, 3), ("u", 1, 1, 1)]


def test_long_threads_take_few_joins(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}", None) for i in range(150)]
    r = chat.digest(chat.format_chats(chat.threads(spark.createDataFrame(rows, CONV)))).first()
    assert r.n_turns == 150 and r.loss_chars == sum(len(f"t{i}") for i in range(1, 150, 2))


def test_a_thread_of_many_turns_comes_back(spark):
    n = 20_000
    rows = [(1, k, "user" if k % 2 else "assistant", f"é{k} <|im_end|> & " * (k % 3)) for k in range(n)]
    got = chat.digest(chat.format_chats(chat.threads(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")), numbered=True)).first()
    said = "".join(t for _, _, r, t in rows if r == "assistant")
    assert got.n_turns == n and got.loss_chars == len(said) and got.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert got.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in rows).encode()).hexdigest()


@pytest.mark.parametrize("texts", [["", "a", "x" * 1023], ["y" * 1024, "z" * 5000, ""], ["😀é" * 700, "<|" * 600]])
def test_spans_are_cut_out_of_blocks(spark, texts):
    text, spans = "".join(texts), []
    for t in texts:
        spans.append((sum(n for _, n in spans), len(t)))
    row = spark.createDataFrame([(text, spans)], "t string, s array<struct<start:int,length:int>>")
    assert row.select(chat.under_mask(row.t, row.s).alias("x")).first().x == texts


def test_replies_in_a_circle_raise(spark):
    kind = "tree string, node long, parent long, role string, text string, score double"
    for rows in ([(1, 2), (2, 1), (3, 1)], [(1, 1)], [(1, 2), (2, 3), (3, 1), (4, None)]):
        with pytest.raises(ValueError, match="lead back"):
            chat.format_chats(spark.createDataFrame([("t", n, p, "user", "x", 0.0) for n, p in rows], kind))


def test_repeated_messages_and_extra_columns(spark):
    rows = [("t", 1, None, "user", "a", 0.5, 1), ("t", 1, None, "user", "a", 0.5, 1), ("t", 1, None, "user", "b", 0.5, 1), ("t", 2, 1, "assistant", None, None, 2), ("t", None, 1, "user", "x", 0.0, 3), (None, 1, None, "user", "x", 0.0, 4), ("t", 2, 1, "assistant", "z", None, 2)]
    df = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double, leaf int").withColumn("depth", chat.F.lit("clash"))
    got = chat.format_chats(df, branches=5).collect()
    assert [(r.tree, r.leaf, r.formatted) for r in got] == [("t", 2, "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n")]


def test_no_chats(spark):
    assert chat.format_chats(chat.threads(spark.createDataFrame([], CONV))).count() == 0


# --- packing ---------------------------------------------------------------------------------------------------------


def check_bins(docs, rows, capacity, conflicts):
    """Every byte has one place, no bin is too full, and no conflict is broken."""
    sizes = Counter((d.doc_id, len((d.text or "").encode())) for d in docs)
    pieces = defaultdict(list)
    bins = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.n_bytes))
        bins[r.bin_id].append(r)
    for doc_id in {d for d, _ in sizes}:
        assert sum(n for _, n in pieces[doc_id]) == sum(n * k for (d, n), k in sizes.items() if d == doc_id)
    text = {d.doc_id: d.text or "" for d in docs}
    source = {d.doc_id: d.source for d in docs}
    for own in bins.values():
        assert sum(r.n_bytes for r in own) + own[0].free == capacity and sorted(r.slot for r in own) == list(range(len(own)))
        if all(r.n_bytes < capacity for r in own):
            assert len({text[r.doc_id] for r in own}) == len(own)
        present = {source[r.doc_id] for r in own}
        assert not any(a in present and b in present for a, b in conflicts)


def test_packing_keeps_all_bytes_and_conflicts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    conflicts = (("src1", "src2"), ("src3", "src4"))
    rows = packing.pack(docs, 4096, conflicts, shard_rows=60, with_text=True).collect()
    held = docs.collect()
    check_bins(held, rows, 4096, conflicts)
    raw = {d.doc_id: (d.text or "").encode() for d in held}
    assert all(bytes(r.piece) == raw[r.doc_id][r.start : r.start + r.n_bytes] for r in rows)


def test_the_tightest_compatible_bin():
    bins, free = packing.best_fit([(7, 1, 1), (6, 2, 1), (3, 1, 1), (3, 0, 2), (2, 0, 1)], 10, {1: 2, 2: 1})
    assert bins == [[0, 4], [1, 2], [3]] and free == [1, 1, 7]


def plain_best_fit(items, capacity, conflicts):
    """Looks at every bin for every item."""
    bins = []
    for k, (size, cluster, source) in enumerate(items):
        against = conflicts.get(source, 0)
        fits = [(capacity - sum(items[i][0] for i in b), j) for j, b in enumerate(bins) if capacity - sum(items[i][0] for i in b) >= size and not any(items[i][1] & cluster or items[i][2] & against for i in b)]
        if fits:
            bins[min(fits)[1]].append(k)
        else:
            bins.append([k])
    return bins


@pytest.mark.parametrize("seed", range(40))
def test_best_fit_equals_a_plain_search(seed):
    rng = np.random.default_rng(seed)
    items = sorted(((int(rng.integers(0, 60)), int(rng.choice([0, 0, 1, 2, 4])), int(rng.choice([0, 1, 2, 4]))) for _ in range(120)), reverse=True)
    conflicts = {1: 2, 2: 5, 4: 2}
    bins, free = packing.best_fit(items, 100, conflicts)
    assert bins == plain_best_fit(items, 100, conflicts) and free == [100 - sum(items[i][0] for i in b) for b in bins]


@pytest.mark.parametrize("seed", range(6))
def test_large_clusters_equal_a_plain_search(seed):
    rng = random.Random(100 + seed)
    items = sorted(((rng.randint(0, 60), rng.choice([0, 1, 1, 1, 2, 4]), rng.choice([0, 1, 1, 2, 4])) for _ in range(220)), reverse=True)
    conflicts = {1: 2, 2: 1} if seed % 2 else {}
    bins, free = packing.best_fit(items, 100, conflicts)
    assert bins == plain_best_fit(items, 100, conflicts) and free == [100 - sum(items[i][0] for i in b) for b in bins]


def test_one_cluster_does_not_walk_past_all_its_bins():
    items = sorted(((300 + i % 500, 1, 0) for i in range(10_000)), reverse=True)
    began = time.perf_counter()
    bins, _ = packing.best_fit(items, 8192, {})
    assert len(bins) == 10_000 and time.perf_counter() - began < 5  # a second at most when the machine is free


def test_packing_equals_a_plain_packing(spark):
    """The whole query, in one shard, against the plain search over all documents."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack(docs, 2048, (("src1", "src2"),)).collect()
    held = sorted(((d.doc_id, (d.text or "").encode(), d.source) for d in docs.collect()), key=lambda d: (-(len(d[1]) % 2048), d[0]))
    rest = [d for d in held if len(d[1]) % 2048 or not d[1]]
    copies = Counter(d[1] for d in held)
    cluster = {t: 1 << i for i, t in enumerate(t for t, n in copies.items() if n > 1)}
    source = {s: 1 << i for i, s in enumerate(sorted({d[2] for d in held if d[2]}))}
    a, b = source["src1"], source["src2"]
    want = plain_best_fit([(len(t) % 2048, cluster.get(t, 0), source.get(s, 0)) for _, t, s in rest], 2048, {a: b, b: a})
    got = defaultdict(list)
    for r in sorted((r for r in rows if r.n_bytes < 2048), key=lambda r: r.slot):
        got[r.bin_id].append(r.doc_id)
    assert Counter(map(tuple, got.values())) == Counter(tuple(rest[i][0] for i in own) for own in want)
    assert sum(r.n_bytes == 2048 for r in rows) == sum(len(d[1]) // 2048 for d in held)


def test_named_clusters_never_share_a_bin(spark):
    docs = spark.createDataFrame([(i, f"text {i}", None, i // 3 if i < 9 else None) for i in range(15)], "doc_id long, text string, source string, component_id long")
    rows = packing.pack(docs, 1000, cluster="component_id").collect()
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r.doc_id)
    assert all(Counter(i // 3 for i in own if i < 9).most_common(1)[0][1] == 1 for own in bins.values() if min(own) < 9) and len(bins) == 3


def test_a_very_long_text_is_cut_once(spark):
    text = "0123456789abcdef" * (1 << 20)
    t = time.time()
    rows = list(packing._shard(0, [(1, "a", len(text), 5, text.encode())], 8192, ()))
    assert len(rows) == 2048 and time.time() - t < 1
    out = packing.pack(spark.createDataFrame([(1, text, "a")], "doc_id long, text string, source string"), with_text=True).collect()
    assert b"".join(bytes(r.piece) for r in sorted(out, key=lambda r: r.start)) == text.encode()


def test_rows_that_repeat_in_full_are_dealt_out(spark):
    docs = spark.createDataFrame([(1, "same", "a")] * 400, "doc_id long, text string, source string").repartition(8)
    rows = packing.pack(docs, 100, shard_rows=50).collect()
    assert len(rows) == 400 and len({r.bin_id for r in rows}) == 400 and len({r.bin_id.split("-")[0] for r in rows}) > 3


def test_packing_messy(messy, empty):
    rows = packing.pack(messy, 512).collect()
    docs = messy.collect()
    assert sum(r.n_bytes for r in rows) == sum(len((d.text or "").encode()) for d in docs)
    assert {r.doc_id for r in rows} == {d.doc_id for d in docs}
    nine = [r.bin_id for r in rows if r.doc_id == 9 and r.n_bytes]
    assert len(nine) == len(set(nine))  # copies never share a bin
    assert packing.pack(empty).count() == 0


# --- mixing ----------------------------------------------------------------------------------------------------------


def test_repetition_limit(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = {r.source: r for r in mixing.plan(docs, repeats=1.5).collect()}
    assert max(r.times for r in plan.values()) == pytest.approx(1.5, abs=1e-4) and min(r.times for r in plan.values()) == pytest.approx(1.0)
    assert sum(r.weight for r in plan.values()) == pytest.approx(1.0, abs=1e-6)
    rows = mixing.mix(docs, repeats=1.5)
    used = {r.source: r.n for r in rows.groupBy("source").agg(mixing.F.sum(mixing.tokens()).alias("n")).collect()}
    largest = max(len((r.text or "").encode()) for r in docs.collect())
    assert all(0 <= plan[s].times * plan[s].tokens - n <= largest + 1 for s, n in used.items())
    assert {r.doc_id for r in rows.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


@pytest.mark.parametrize("how", [{}, {"repeats": 1.2}, {"entropy": 0.97, "repeats": 50.0}, {"budget": 60_000}, {"budget": 40_000, "entropy": 0.9}])
def test_many_sources_have_the_plan_of_few(spark, how):
    docs = spark.createDataFrame([(i, "x" * (1 + i * i % 97), f"s{i % 40}" if i % 41 else None) for i in range(900)] + [(1000, "", "none")], "doc_id long, text string, source string")
    a, b = ({r.source: r for r in mixing.plan(docs, max_sources=m, **how).collect()} for m in (10_000, 3))
    assert a.keys() == b.keys() and len(a) == 42
    for k in a:
        assert a[k].tokens == b[k].tokens and all(a[k][c] == pytest.approx(b[k][c], abs=2e-6, rel=1e-5) for c in ("exponent", "weight", "times"))


def test_fifty_thousand_sources_are_mixed(spark):
    docs = spark.range(100_000).selectExpr("id AS doc_id", "repeat('x', cast(1 + id % 7 AS int)) AS text", "concat('s', id % 50000) AS source")
    rows = mixing.mix(docs)
    few = mixing.mix(docs.filter("doc_id < 3"), max_sources=2)
    assert few.select("doc_id").distinct().count() == 3
    got = rows.groupBy("doc_id").agg(mixing.F.count("*").alias("n"))
    assert got.count() == 100_000 and got.agg(mixing.F.max("n")).first()[0] <= 2


def test_target_entropy(spark):
    docs = spark.createDataFrame([(i, "x" * n, s) for i, (n, s) in enumerate([(900, "a"), (90, "b"), (10, "c")])], "doc_id long, text string, source string")
    for share in (0.5, 0.9):
        w = [r.weight for r in mixing.plan(docs, entropy=share, repeats=1000.0).collect()]
        assert -sum(x * math.log(x) for x in w) / math.log(3) == pytest.approx(share, abs=1e-4)


def test_budget_takes_part_of_the_blocks(spark):
    docs = spark.createDataFrame([(i, "x" * 10, "ab"[i % 2]) for i in range(400)], "doc_id long, text string, source string")
    rows = mixing.mix(docs, budget=1000, block_tokens=100).collect()
    assert Counter(r.source for r in rows) == {"a": 50, "b": 50} and len({r.mix_block for r in rows}) > 1
    assert len({r.doc_id for r in rows}) == 100
    again = mixing.mix(docs, budget=1000, block_tokens=100).collect()
    assert Counter(again) == Counter(rows)


def test_mixing_messy(messy, empty):
    rows = mixing.mix(messy).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in messy.collect()} and {r.source for r in rows} == {"a", "b", "c", None}
    assert mixing.mix(messy).columns == [c for c in messy.columns if c != "mix_epoch"] + ["mix_epoch", "mix_block", "mix_order", "mix_weight"]
    assert mixing.mix(empty).count() == 0
    few, many = ({r.source: r.tokens for r in mixing.plan(messy, max_sources=m).collect()} for m in (10_000, 2))
    assert few == many and {r.doc_id for r in mixing.mix(messy, max_sources=2).collect()} == {r.doc_id for r in messy.collect()}


# --- search ----------------------------------------------------------------------------------------------------------


def brute_search(rows, k=20, every=20):
    whole = lambda x: 64 * int(x) if abs(x) > 2**53 else math.floor(64 * x)
    good = [(i, v, [whole(float(x)) for x in e]) for i, (v, e) in enumerate(rows) if e is not None and v is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, v, q in good:
        if v % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, e, strict=False)), w) for j, w, e in good if j != i)
            out += [(v, r + 1, w, -s) for r, (s, w) in enumerate(scores[:k])]
    return Counter(out)


@pytest.mark.parametrize("block", [4096, 16])
def test_search_is_exact(spark, block):
    rng = np.random.default_rng(3)
    rows = [(int(v), [float(x) for x in rng.normal(0, 1, 12)]) for v in rng.permutation(130)]
    rows += [(40, rows[3][1]), (200, rows[3][1]), (201, None), (220, [None] * 12), (240, [float("nan")] * 12), (260, [1.0] * 5), (280, []), (None, [1.0] * 12)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int")
    got = topk.search(df, rows=block).collect()
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute_search(rows)


def test_groups_of_vectors_are_pruned(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(40, 32)) * 3
    rows = [(i, (centre[int(rng.integers(0, 40))] + rng.normal(size=32) * 0.2).tolist()) for i in range(6000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    shared_dir(spark)
    stored = topk.blocks(table, 20, 64).checkpoint()
    asked, kept = topk.candidates(stored, 20)
    share = kept.count() / (asked.count() * stored.count())
    assert share < 0.3  # of all pairs of queries' packs and blocks
    whole = np.floor(64 * np.array([v for _, v in rows])).astype(int)
    got = defaultdict(list)
    for r in topk.search(table, 20, 20, 64).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    for q in range(0, 6000, 20):
        s = whole @ whole[q]
        want = [int(i) for i in np.lexsort((np.arange(6000), -s)) if i != q][:20]
        assert sorted(got[q]) == [(k + 1, i, int(s[i])) for k, i in enumerate(want)]


def test_fewer_candidates_than_k(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.search(df).collect()] == [(0, 1, 1, 8192)]
    assert topk.search(df.limit(0)).count() == 0 and topk.search(df.filter("vec_id = 0")).count() == 0


def test_large_components_are_exact(spark):
    df = spark.createDataFrame([(0, [3e7, 1.0]), (1, [3e7, 2.0]), (2, [3e7, 3.0])], "vec_id long, embedding array<double>")
    a = 64 * 30_000_000
    assert [(r.vec_id, r.score) for r in topk.search(df).orderBy("rank").collect()] == [(2, a * a + 64 * 192), (1, a * a + 64 * 128)]


def test_any_finite_vector_takes_part(spark):
    """Components of 2^47 and far beyond, whose scores fit a long, and whose products alone do not."""
    rows = [(20, [0.5, 1.0]), (21, [1e15, 1.0]), (22, [3.0, 2.0]), (41, [1e15, 1e15 - 1]), (43, [-(2.0**50), 7.0]), (44, [2.0**57, -(2.0**56)]), (45, [0.01])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.search(df).collect()) == brute_search(rows)
    with pytest.raises(Exception, match="does not fit a long"):
        topk.search(df, every=41).collect()
    far = spark.createDataFrame([(20, [1.0]), (21, [-1e308]), (23, [2.0])], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in topk.search(far, k=1).collect()] == [23]  # what is too low to show is no error


def test_skewed_ids_and_extra_columns(spark):
    rng = np.random.default_rng(5)
    rows = [(int(v), [float(x) for x in rng.normal(0, 1, 6)]) for v in [*range(60), *[7] * 60, 10**15, -(10**15)]]
    df = spark.createDataFrame([(*r, 1, "x", 2, 3.0) for r in rows], "vec_id long, embedding array<double>, block int, rank string, q int, score double")
    got = topk.search(df, rows=8)
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == brute_search(rows)
    assert topk.blocks(df, 20, 8).count() >= 15  # the id that half of the rows have is many blocks


# --- pipeline --------------------------------------------------------------------------------------------------------


def test_pipeline_equals_its_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = corpus_pipeline.run(spark, sf).collect()
    good = quality.judge(docs, quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))).filter("kept")
    left = docs.join(good.select("doc_id"), "doc_id", "left_semi").select(*docs.columns)
    one = left.join(minhash.near_duplicates(left).filter("kept").select("doc_id"), "doc_id", "left_semi").collect()
    clean = {r.doc_id: (pii.redacted(r.text) or "").encode() for r in one}
    times = Counter()
    rebuilt = defaultdict(bytes)
    for r in sorted(got, key=lambda r: r.start):
        times[r.doc_id] += r.n_bytes
        assert clean[r.doc_id][r.start : r.start + r.n_bytes] == bytes(r.piece)
        rebuilt[r.doc_id] += bytes(r.piece)
    assert set(times) == set(clean)
    assert all(times[d] in (len(t), 2 * len(t)) for d, t in clean.items())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "personal_data", "source_mix", "best_fit"]


def test_stages_return_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == 0
