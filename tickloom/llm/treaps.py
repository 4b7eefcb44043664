"""Ranked lexical search through inverted treaps.

build() cuts the documents into segments of about `segment_bytes` where they lie, without a shuffle, and writes for each
segment and term its postings in order of the documents' ids, with the impact of each, in full for all terms. A term's
postings are a treap: search order by document, heap order by impact, which fixes its shape, so a treap's links are made (all
of a segment's at once) when it is opened. search() opens the treaps of asked terms only.

A query walks the treaps of its terms together. A state is a range of documents with the root of each treap's part in that
range; the sum of the roots' weighted impacts is a bound for all documents of the range. A state whose bound is below the
query's k-th score is dropped with all that is below its roots. Else the document of the root that adds most is scored in full
and cuts the range in two; roots that fall out of a half are followed down to the first one inside. The states of a level are
handled together. Where there are many segments, those that a hash picks, about one in SEEDS, are searched first; the k-th
score there is a floor for all others, so what segments give out does not grow with their number.

Scores are those of the contract: w = floor(1000 ln((2N+2)/(2df+1))), times the impact tf * 10^9 div (1000 tf + 12 m), summed
over a query's terms with repeats; equal scores rank by the smaller doc_id.

Edge cases: a text that is null or has no terms counts nowhere; a row without doc_id takes no part; rows that repeat a doc_id
are documents of their own; queries that repeat an item_id are one, with the terms of all its rows; a query without known
terms has no rows; texts are read whole; empty tables give none; extra columns are left out.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._state import shared_dir
from ._text import Words, buffer, pieces, tune

NOT_TERM = np.ones(256, bool)
NOT_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEEDS = 64
ASKED = 200_000  # (query, term) pairs that go to every segment at a time, of some dozen bytes each
INDEX = "segment long, term string, df long, docs array<int>, impact array<int>, ids array<long>"


@dataclass(frozen=True)
class Index:
    """Rows per segment and term, and how many documents and terms there are. A segment's row without a term has its doc_ids."""

    rows: DataFrame
    documents: int
    terms: int


def _own(docs: DataFrame) -> DataFrame:
    return docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def sizes(docs: DataFrame) -> tuple[int, int]:
    """How many documents have a term, and how many terms there are in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = total = 0
        for batch in batches:
            raw, at = buffer(batch.column(1))
            for a, b in pieces(at):
                count = Words(raw[at[a] : at[b]], at[a : b + 1] - at[a], space=NOT_TERM).count
                n, total = n + int(np.count_nonzero(count)), total + int(count.sum())
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total], pa.int64())], ["n", "total"])

    found = _own(docs).mapInArrow(run, "n long, total long").agg(F.sum("n"), F.sum("total")).first()
    return found[0] or 0, found[1] or 0


def _list(counts: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, kind))


def inverted(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]], documents: int, terms: int) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Of some batches (ids, bytes, where texts begin): sorted ids, terms, and for these in turn, how many postings, their
    documents' places among the ids, and impacts."""
    ids = np.concatenate([i for i, _, _ in held])
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    size, begin, runs, got = np.zeros(len(ids), np.int64), 0, [], []
    for own, raw, at in held:
        for a, b in pieces(at):
            text = raw[at[a] : at[b]]
            words = Words(text, at[a : b + 1] - at[a], lower=True, space=NOT_TERM)
            size[place[begin + a : begin + b]] = words.count
            by = np.lexsort((words.hash, words.text))
            h, t = words.hash[by], words.text[by]
            head = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])])) if len(h) else np.zeros(0, np.int64)
            got.append((h[head], place[begin + a + t[head]], np.diff(np.append(head, len(h))), np.full(len(head), len(runs)), words.start[by[head]], words.end[by[head]]))
            runs.append(text)
        begin += len(own)
    h, doc, tf, run, start, end = map(np.concatenate, zip(*got, strict=True))
    _, first, term, df = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    names = [runs[r][a:b].tobytes() for r, a, b in zip(run[first].tolist(), start[first].tolist(), end[first].tolist(), strict=True)]
    by = np.lexsort((doc, term))
    doc, tf = doc[by], tf[by]
    m = 75 + 25 * size[doc] * documents // max(terms, 1)
    return ids[order], [n.lower() for n in names], df, doc, 1_000_000_000 * tf // (1000 * tf + 12 * m)


def build(docs: DataFrame, segment_bytes: int = 24 << 20) -> Index:
    """The index of all documents, written to the shared folder."""
    spark = docs.sparkSession
    tune(spark)
    documents, terms = sizes(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number, names = [], TaskContext.get().partitionId() << 32, INDEX.replace(",", "").split()[::2]

        def flush() -> Iterator[pa.RecordBatch]:
            ids, terms_, df, doc, impact = inverted(held, documents, terms)
            none = [pa.nulls(1, k) for k in (pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *none, _list(np.array([len(ids)]), ids, pa.int64())], names)
            edge = np.concatenate([[0], np.cumsum(df)])
            for a in range(0, len(terms_), 20_000):
                b = min(a + 20_000, len(terms_))
                own = slice(edge[a], edge[b])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(b - a, number)), pa.array([t.decode() for t in terms_[a:b]], pa.string()), pa.array(df[a:b]), _list(df[a:b], doc[own], pa.int32()), _list(df[a:b], impact[own], pa.int32()), pa.nulls(b - a, pa.list_(pa.int64()))], names)

        for batch in batches:
            raw, at = buffer(batch.column(1))
            held.append((batch.column(0).to_numpy(), raw, at))
            if sum(len(r) for _, r, _ in held) > segment_bytes:
                yield from flush()
                held, number = [], number + 1
        if sum(len(i) for i, _, _ in held):
            yield from flush()

    path = f"{shared_dir(spark)}/treaps-{spark.sparkContext.applicationId}-{spark._jvm.java.util.UUID.randomUUID()}"
    _own(docs).mapInArrow(run, INDEX).write.option("compression", "zstd").parquet(path)
    return Index(spark.read.schema(INDEX).parquet(path), documents, terms)


def links(impact: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Left and right children, and roots, of the treaps of lists that begin at some positions, one after the other. Of equal
    impacts the first is above. The nearest larger neighbours are found by pointer jumping."""
    n = len(impact)
    before, after = np.arange(n) - 1, np.arange(n) + 1
    before[starts] = -1
    after[np.append(starts[1:], n) - 1] = -1
    for near, lower in ((before, np.less), (after, np.less_equal)):
        open_ = np.flatnonzero(near >= 0)
        while len(open_ := open_[lower(impact[near[open_]], impact[open_])]):
            near[open_] = near[near[open_]]
            open_ = open_[near[open_] >= 0]
    up = np.where((after < 0) | ((before >= 0) & (impact[before] < impact[after])), before, after)
    left, right, own = np.full(n, -1), np.full(n, -1), np.flatnonzero(up >= 0)
    left[up[own[own < up[own]]]] = own[own < up[own]]
    right[up[own[own > up[own]]]] = own[own > up[own]]
    return left, right, np.flatnonzero(up < 0)


class Segment:
    """The opened treaps of one segment."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, docs: np.ndarray, impact: np.ndarray):
        self.ids, self.docs, self.impact = ids, docs.astype(np.int64), impact.astype(np.int64)
        starts = np.cumsum(counts) - counts
        self.left, self.right, self.root = links(self.impact, starts)
        self.key = np.repeat(np.arange(len(counts)), counts) * len(ids) + self.docs
        self.scored = 0

    def _inside(self, node: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The first nodes, downwards, whose documents lie in a range; -1 where there is none."""
        while True:
            doc = self.docs[node]
            out = np.flatnonzero((node >= 0) & ((doc < low) | (doc >= high)))
            if not len(out):
                return node
            node[out] = np.where(doc[out] < low[out], self.right[node[out]], self.left[node[out]])

    def best(self, terms: np.ndarray, weight: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and documents' places of the k best that reach the floor, best first."""
        best, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
        state, node, term, weight = np.zeros(len(terms), np.int64), self.root[terms], terms, weight
        low, high = np.array([0]), np.array([len(self.ids)])
        while len(node):
            gain = weight * self.impact[node]
            starts = np.flatnonzero(np.concatenate([[True], state[1:] != state[:-1]]))
            able = np.add.reduceat(gain, starts) >= max(floor, 1)
            entry = np.repeat(able, np.diff(np.append(starts, len(state))))
            node, term, weight, gain = node[entry], term[entry], weight[entry], gain[entry]
            if not len(node):
                break
            low, high = low[able], high[able]
            state = np.cumsum(np.concatenate([[False], state[entry][1:] != state[entry][:-1]]))
            order = np.lexsort((gain, state))
            pivot = self.docs[node[order[np.append(np.flatnonzero(np.diff(state)), len(state) - 1)]]]
            at = np.minimum(np.searchsorted(self.key, term * len(self.ids) + pivot[state]), len(self.key) - 1)
            hit = self.key[at] == term * len(self.ids) + pivot[state]
            score = np.zeros(len(pivot), np.int64)
            np.add.at(score, state[hit], weight[hit] * self.impact[at[hit]])
            self.scored += len(pivot)
            good = score >= max(floor, 1)
            best, found = np.concatenate([best, score[good]]), np.concatenate([found, pivot[good]])
            top = np.lexsort((found, -best))[:k]
            best, found = best[top], found[top]
            if len(best) == k:
                floor = max(floor, int(best[-1]))
            halves = []
            for a, b in ((low, pivot), (pivot + 1, high)):
                own = self._inside(node.copy(), a[state], b[state])
                halves.append((own, own >= 0, a, b))
            (na, ka, la, ha), (nb, kb, lb, hb) = halves
            node, weight, term = np.concatenate([na[ka], nb[kb]]), np.concatenate([weight[ka], weight[kb]]), np.concatenate([term[ka], term[kb]])
            state = np.concatenate([state[ka], state[kb] + len(pivot)])
            used = np.flatnonzero(np.bincount(state, minlength=2 * len(pivot)))
            low, high = np.concatenate([la, lb])[used], np.concatenate([ha, hb])[used]
        return best, found


def asked_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times)."""
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    every = items.select("item_id", F.explode(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("term"))
    return every.groupBy("item_id", "term").agg(F.count("*").alias("times"))


def _searched(index: DataFrame, asked: list, floors: dict, k: int) -> DataFrame:
    """(item_id, doc_id, score): the best of each segment that reach their floors, of some segments and queries."""
    by_item: dict = {}
    for row in asked:
        by_item.setdefault(row.item_id, []).append((row.term, row.weight))

    def run(table: pa.Table) -> pa.Table:
        out: list[tuple] = []
        ids = next(x for x in table["ids"].to_pylist() if x is not None)
        own = table.filter(table["term"].is_valid())
        if own.num_rows:
            docs, impact = own["docs"].combine_chunks(), own["impact"].combine_chunks()
            segment = Segment(np.array(ids, np.int64), np.diff(docs.offsets.to_numpy()), docs.flatten().to_numpy(), impact.flatten().to_numpy())
            place = {t: i for i, t in enumerate(own["term"].to_pylist())}
            for item, terms in by_item.items():
                known = [(place[t], w) for t, w in terms if t in place and w]
                if known:
                    t, w = np.array(known, np.int64).T
                    score, at = segment.best(t, w, k, floors.get(item, 1))
                    out += [(item, i, s) for i, s in zip(segment.ids[at].tolist(), score.tolist(), strict=True)]
        item, doc, score = zip(*out, strict=True) if out else ((), (), ())
        return pa.table([pa.array(item, pa.int64()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], ["item_id", "doc_id", "score"])

    return index.groupBy("segment").applyInArrow(run, "item_id long, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def search(index: Index, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each query with a score above 0."""
    asked = asked_terms(items.select(F.col("item_id").cast("long").alias("item_id"), "text")).checkpoint()
    terms = asked.select("term").distinct()
    few = asked.count()
    terms = F.broadcast(terms) if few <= ASKED else terms
    wanted = index.rows.join(terms, "term", "left_semi")
    ratio = F.lit(2 * index.documents + 2) / (2 * F.sum("df") + 1).cast("double")
    weights = wanted.groupBy("term").agg(F.floor(1000 * F.log(ratio)).alias("w"))
    weighed = asked.join(weights, "term").select("item_id", "term", (F.col("times") * F.col("w")).alias("weight")).checkpoint()
    rows = wanted.unionByName(index.rows.filter("term is null"))
    segments = index.rows.filter("term is null").count()
    blocks, results = max(1, -(-few // ASKED)), []
    for b in range(blocks):
        own = weighed.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()
        floors = {}
        if segments > SEEDS:
            seeds = _searched(rows.filter(F.pmod(F.xxhash64("segment"), F.lit(SEEDS)) == 0), own, {}, k)
            floors = {r.item_id: r.score for r in _ranked(seeds, k).filter(F.col("rank") == k).select("item_id", "score").collect()}
        results.append(_searched(rows, own, floors, k))
    every = _ranked(reduce(DataFrame.unionByName, results), k)
    return every.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
