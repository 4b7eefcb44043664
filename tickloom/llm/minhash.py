"""MinHash near-duplicates with min-max hashing.

A document's set holds the distinct shingles of `size` words (A-Z lower-cased); with fewer words the whole sequence is its
one shingle. For each of 64 permutations both the least and the largest value are kept, so 64 evaluations give 128
signature values. Bands of four minima, and bands of four maxima, of different permutations put documents into buckets: at
a similarity of 0.85 all 32 bands miss once in 10^10 pairs.

Documents with equal sets are one class, carried on by its smallest doc_id. Classes that share a bucket are first gathered
into rough clusters through the smallest of each bucket (a superset of all links). A cluster of more than one block whose
buckets have far fewer pairs than all its members is a chain of unlike texts rather than one group: there the pairs of each
bucket are checked by signature, and what these leave connected are its clusters. Inside a cluster every pair counts: the
members are cut into blocks, each pair of blocks is one unit of work of bounded size, and in it a pair is compared unless
its two sides are joined already: first by signature (seven deviations below the wanted similarity), then exactly, on full
sets. A unit takes the member nearest to all others first, so in a group of near copies of one text almost all pairs are
joined before they are looked at, and it returns at most one link per member.

Edge cases: null or empty texts, or texts without words, have an empty set, link with nothing and are kept; rows that
repeat a doc_id are one node, each row with its own set's size; a null doc_id links with nothing, has a null component and
is kept; an empty table gives none; extra columns are left out, or pass through in `keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._state import shared_dir
from ._text import U64, Words, buffer, distinct, mix, pieces, tune, window_hash
from .components import components

PERMUTATIONS, ROWS, BLOCK = 64, 4, 512
FEWER = 16  # pairs of buckets come with more rows than those of a cluster, so they must be this much fewer
SMALL = 1_000_000  # ids that a broadcast may hold, of 8 bytes
_SEEDS = mix(np.arange(1, 2 * PERMUTATIONS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
FACTORS, SHIFTS = _SEEDS[:PERMUTATIONS] | U64(1), _SEEDS[PERMUTATIONS:]


def shingle_sets(raw: np.ndarray, at: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each run of texts: the first and last text, all shingle hashes (with repeats), and where each text's begin."""
    for i, j in pieces(at):
        words = Words(raw[at[i] : at[j]], at[i : j + 1] - at[i], lower=True)
        gram, first = words.grams(size)
        text = words.text[first]
        short = np.flatnonzero((words.count > 0) & (words.count < size))
        if len(short):
            one = np.array([window_hash(words.hash[words.first[k] : words.first[k + 1]], int(words.count[k]))[0] for k in short], U64)
            order = np.argsort(np.concatenate([text, short]), kind="stable")
            gram, text = np.concatenate([gram, one])[order], np.concatenate([text, short])[order]
        yield i, j, gram, np.searchsorted(text, np.arange(j - i + 1))


def signatures(gram: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Minima, then maxima, of each permutation for each text with shingles."""
    full = np.flatnonzero(np.diff(begin))
    out = np.zeros((len(full), 2 * PERMUTATIONS), U64)
    if len(full):
        starts = begin[full]
        for k in range(PERMUTATIONS):
            h = gram * FACTORS[k] + SHIFTS[k]
            out[:, k] = np.minimum.reduceat(h, starts)
            out[:, PERMUTATIONS + k] = np.maximum.reduceat(h, starts)
    return out


def _signed(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, two sums that stand for the set, band keys, and 16 bits of each signature value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = buffer(batch.column(1))
            n = np.zeros(batch.num_rows, np.int64)
            sums = np.zeros((batch.num_rows, 2), U64)
            bands: list[list[int] | None] = [None] * batch.num_rows
            sig: list[bytes | None] = [None] * batch.num_rows
            for i, j, gram, begin in shingle_sets(raw, at, size):
                values = signatures(gram, begin)
                groups = values.reshape(len(values), 2 * PERMUTATIONS // ROWS, ROWS)
                keys = np.full(groups.shape[:2], 0x51, U64) + np.arange(groups.shape[1], dtype=U64)
                for r in range(ROWS):
                    keys = mix(keys * U64(0x9E3779B97F4A7C15) + groups[:, :, r])
                low = mix(values).astype(np.uint16)
                row = 0
                for k in range(j - i):
                    if begin[k] == begin[k + 1]:
                        continue
                    own = distinct(gram[begin[k] : begin[k + 1]])
                    n[i + k] = len(own)
                    sums[i + k] = mix(own).sum(dtype=U64), mix(own ^ U64(0xA5A5A5A5)).sum(dtype=U64)
                    bands[i + k], sig[i + k] = keys[row].view(np.int64), low[row].tobytes()
                    row += 1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(sums[:, 0].view(np.int64)), pa.array(sums[:, 1].view(np.int64)), pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.binary())], ["doc_id", "n_shingles", "s1", "s2", "bands", "sig"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_shingles long, s1 long, s2 long, bands array<long>, sig binary")


def _sets(rows: DataFrame, size: int) -> DataFrame:
    """(cluster, blocks, node, sig, set): the sorted shingle hashes of each row's text. A doc_id may have several texts, so a
    text counts only in the class whose sum (s1) it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = buffer(batch.column(5))
            sums = batch.column(4).to_pylist()
            sets: list[bytes | None] = [None] * batch.num_rows
            for i, j, gram, begin in shingle_sets(raw, at, size):
                for k in range(j - i):
                    own = distinct(gram[begin[k] : begin[k + 1]])
                    if mix(own).sum(dtype=U64).astype(np.int64) == sums[i + k]:
                        sets[i + k] = own.tobytes()
            out = pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sets, pa.binary())], ["cluster", "blocks", "node", "sig", "set"])
            yield out.filter(out.column(4).is_valid())

    return rows.select("cluster", "blocks", "node", "sig", "s1", "text").mapInArrow(run, "cluster long, blocks int, node long, sig binary, set binary")


class _Joined:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.root(x)] = self.root(y)


def links_of_unit(nodes: list[int], side: np.ndarray, sig: np.ndarray, sets: list[np.ndarray] | None, alone: bool, num: int, den: int) -> list[tuple[int, int]]:
    """Links that join what is similar in one unit; only pairs across sides unless the unit is a block with itself. Without
    sets, what may be similar by signature."""
    share = num / den
    least = int(sig.shape[1] * (share - 7 * np.sqrt(share * (1 - share) / PERMUTATIONS)))
    sizes = np.array([len(s) for s in sets]) if sets else np.ones(len(nodes), np.int64)
    alike = np.stack([(sig == s).sum(1, dtype=np.int32) for s in sig])
    joined, found = _Joined(len(nodes)), []
    for x in np.argsort(-alike.sum(1), kind="stable"):
        able = (alike[x] >= least) & (den * np.minimum(sizes, sizes[x]) >= num * np.maximum(sizes, sizes[x]))
        if not alone:
            able &= side != side[x]
        able[x] = False
        for y in np.flatnonzero(able):
            if joined.root(x) == joined.root(y):
                continue
            if sets is None:
                joined.join(x, y)
                found.append((nodes[x], nodes[y]))
                continue
            a, b = (sets[x], sets[y]) if len(sets[x]) < len(sets[y]) else (sets[y], sets[x])
            at = np.searchsorted(b, a)
            both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
            if den * both >= num * (len(a) + len(b) - both):
                joined.join(x, y)
                found.append((nodes[x], nodes[y]))
    return found


def _links(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): enough links to join all that are joined by similar pairs of one cluster; where `set` is null, by pairs whose
    signatures are."""
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    units = sets.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = units.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other", "blocks")
    units = units.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def flush() -> Iterator[pa.RecordBatch]:
            seen = {(x["node"], x["set"]): x for x in held}
            rows = list(seen.values())
            if len(rows) > 1:
                found = links_of_unit([x["node"] for x in rows], np.array([x["own"] for x in rows]), np.stack([np.frombuffer(x["sig"], np.uint16) for x in rows]), [np.frombuffer(x["set"], U64) for x in rows] if rows[0]["set"] is not None else None, rows[0]["i"] == rows[0]["j"], num, den)
                if found:
                    a, b = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            for x in batch.to_pylist():
                if held and any(held[0][k] != x[k] for k in ("cluster", "i", "j")):
                    yield from flush()
                    held = []
                held.append(x)
        yield from flush()

    return units.mapInArrow(run, "a long, b long")


def _blocks(members: DataFrame, by: str) -> DataFrame:
    """How many blocks each group's members are."""
    return members.groupBy(by).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))


def refined(clusters: DataFrame, heads: DataFrame, members: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Rough clusters (node, cluster), with chains of unlike texts taken apart: pairs of one bucket are checked by signature,
    and what they leave connected is a cluster. Every pair that shares a bucket and may be similar stays in one cluster."""
    large = clusters.groupBy("cluster").agg(F.count("*").cast("double").alias("m")).filter(F.col("m") > BLOCK).checkpoint()
    if large.isEmpty():
        return clusters
    n = F.col("n").cast("double")
    buckets = heads.join(clusters, F.col("head") == F.col("node")).groupBy("cluster").agg(F.sum(n * n).alias("pairs"))
    chains = buckets.join(large, "cluster").filter(FEWER * F.col("pairs") < F.col("m") * F.col("m")).select("cluster").checkpoint()
    if chains.isEmpty():
        return clusters
    loose = members.join(clusters.join(chains, "cluster"), "node").select("node", F.col("key").alias("cluster"))
    loose = loose.join(_blocks(loose, "cluster"), "cluster").join(classes.select("node", "sig"), "node").withColumn("set", F.lit(None).cast("binary"))
    apart = components(_links(loose, num, den)).select("node", F.col("root").alias("cluster"))
    return clusters.join(chains, "cluster", "left_anti").select("node", "cluster").unionByName(apart).checkpoint()


def near_duplicates(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): documents linked if den * common >= num * all distinct shingles."""
    spark = docs.sparkSession
    shared_dir(spark)
    tune(spark)
    signed = _signed(docs, size).checkpoint()
    own = ["n_shingles", "s1", "s2"]
    classes = signed.filter("n_shingles > 0 and doc_id is not null").groupBy(*own).agg(F.min("doc_id").alias("node"), F.min_by(F.struct("bands", "sig"), "doc_id").alias("x")).select(*own, "node", "x.bands", "x.sig").checkpoint()
    members = classes.select("node", F.explode("bands").alias("key"))
    heads = members.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("n")).filter("n > 1").checkpoint()
    rough = members.join(heads, "key").filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    # two sets of one doc_id are one node, and are linked whatever their similarity
    clusters = refined(components(rough).withColumnRenamed("root", "cluster").checkpoint(), heads, members, classes, num, den)
    wanted = clusters.join(_blocks(clusters, "cluster"), "cluster").join(classes.select("node", "sig", *own), "node").checkpoint()
    ids = wanted.select("node").distinct()
    texts = docs.select(F.col("doc_id").alias("node"), "text").join(F.broadcast(ids) if wanted.count() <= SMALL else ids, "node", "left_semi")
    texts = wanted.select("cluster", "blocks", "node", "sig", "s1").join(texts, "node")
    links = _links(_sets(texts, size), num, den)
    roots = components(links).withColumnRenamed("root", "component_id")
    named = classes.select(*own, "node").join(roots, "node", "left").select(*own, F.coalesce("component_id", "node").alias("component_id"))
    full = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()  # all that have no set would be one key
    out = signed.filter(full).select("doc_id", *own).join(named, own, "left")
    out = out.unionByName(signed.filter(~full).select("doc_id", *own, F.lit(None).cast("long").alias("component_id")))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of the smallest doc_id of each group, with all their columns. Rows that repeat a doc_id stay or go together."""
    gone = near_duplicates(docs, size, num, den).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
