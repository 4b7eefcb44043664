"""Exact top-k inner products by block-at-a-time pruning.

Vectors become integers, floor(64 x). Rows are put in the order of the nearest of CENTRES sampled vectors, then of a hash, and
cut into blocks by ranges of that order, so that a block's rows are alike where the vectors are in groups at all (the sample
bears on the order only, never on what is found). A block is stored as a matrix (its forward index) with the largest and least value of each dimension. For a query the sum over dimensions of the larger of
q * max and q * min bounds every score in a block. Outlines of blocks (only these bounds) lie on shelves of SHELF blocks, and
each pack of queries meets each shelf once: first to find each query's block with the largest bound, whose k-th score is the
query's floor; then to name the blocks whose bound reaches the floor. Per query these are scored in descending order of
bounds, until bounds fall below its k-th score.

Vectors with a component that a 64-bit product cannot take are in blocks of their own, and are scored with Python's integers.

Edge cases: vectors that are null, or hold null or non-finite components, and rows without a vec_id, take no part; any other
vector does, and a score among the k best that no long can hold raises an error; shorter vectors count as ending in zeros;
rows that repeat a vec_id are rows of their own, and only the query's own row is no candidate; fewer than k candidates are
all returned; an empty table gives none; extra columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._ranges import split
from ._state import shared_dir
from ._text import tune

BLOCK = "block long, dim int, ids binary, rows binary, high binary, low binary, queries binary"
PAIRS, SHELF, PACK, PART = 16, 256, 256, 16
CENTRES = 256
WIDE = 2.0**57  # 64 x of less than this in every component is an exact 64-bit integer


def _record(columns: list[list], kinds: list[pa.DataType], names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names.split())


def usable(vectors: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """The vectors that take part, and which these are."""
    lists = [None if v is None else np.array([np.nan if x is None else x for x in v], float) for v in vectors.to_pylist()]
    good = [i for i, v in enumerate(lists) if v is not None and np.isfinite(v).all()]
    return [lists[i] for i in good], np.array(good, int)


def _floats(m: np.ndarray) -> np.ndarray:
    """Integers as floats; what is past their range is infinite."""
    if m.dtype != object:
        return m.astype(float)
    most = 1 << 1023
    return np.array([float(x) if -most < x < most else (math.inf if x > 0 else -math.inf) for x in m.ravel().tolist()]).reshape(m.shape)


def _padded(vectors: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)))
    for r, v in enumerate(vectors):
        out[r, : len(v)] = v
    return out


def pack(m: np.ndarray) -> bytes:
    """Rows of doubles as their integers of 2 or 8 bytes, or where these overflow as they are; a first byte says which."""
    if m.size and np.abs(m).max() >= WIDE:
        return b"\xff" + m.tobytes()
    whole = np.floor(64.0 * m)
    small = not m.size or np.abs(whole).max() < 1 << 15
    return (b"\2" if small else b"\x08") + whole.astype(np.int16 if small else np.int64).tobytes()


def unpack(b: bytes, dim: int, rows: int) -> np.ndarray:
    """The integers of pack(); Python's own where 64 bits do not hold them."""
    if b[0] != 0xFF:
        return np.frombuffer(b, np.int16 if b[0] == 2 else np.int64, offset=1).reshape(rows, dim)
    exact = [int(x) * 64 if abs(x) >= 2.0**53 else math.floor(64.0 * x) for x in np.frombuffer(b, offset=1).tolist()]
    return np.array(exact, object).reshape(rows, dim)


def _chained(centres: np.ndarray) -> np.ndarray:
    """Centres in an order in which each is followed by the nearest of those that are left, so that neighbours are alike."""
    left, out = list(range(len(centres))), []
    while left:
        apart = ((centres[left] - centres[out[-1]]) ** 2).sum(1) if out else np.zeros(len(left))
        out.append(left.pop(int(np.argmin(apart))))
    return centres[out]


def _ordered(found: DataFrame) -> DataFrame:
    """Adds key: the nearest centre's number, then 32 bits of a hash of vec_id. Centres are the rows of the least hashes."""
    sample = found.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CENTRES).select("embedding").collect()
    centres = _padded(usable(pa.array([r[0] for r in sample], pa.list_(pa.float64())))[0])
    with np.errstate(over="ignore", invalid="ignore"):
        centres = _chained(centres)
        half = (centres * centres).sum(1) / 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, good = usable(batch.column(1))
            m, nearest = _padded(vectors), np.zeros(batch.num_rows, np.int64)
            dim = min(m.shape[1], centres.shape[1])
            if len(good) and len(centres):
                with np.errstate(over="ignore", invalid="ignore"):
                    nearest[good] = (m[:, :dim] @ centres[:, :dim].T - half).argmax(1)
            hashed = batch.column(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((nearest << 32) + hashed.astype(np.int64))], ["vec_id", "embedding", "key"])

    return found.mapInArrow(run, f"vec_id long, embedding {found.schema['embedding'].dataType.simpleString()}, key long")


def blocks(table: DataFrame, every: int, rows: int) -> DataFrame:
    """One row per block of at most `rows` vectors from one range of the order; `queries` has the positions of its queries."""
    found = table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull())
    found = _ordered(found)
    ranges = split(found, "key", F.lit(0), found.count(), rows)
    salt = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(1 << 40))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = ranges.place(batch.column(2).to_numpy(), batch.column(3).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(where, pa.int64())], ["vec_id", "embedding", "range"])

    own = f"vec_id long, embedding {found.schema['embedding'].dataType.simpleString()}, range long"
    dealt = found.select("vec_id", "embedding", "key", salt).mapInArrow(placed, own).repartition(ranges.shards, "range").sortWithinPartitions("range", "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bool], list[tuple[int, np.ndarray]]] = {}
        made: dict[int, int] = {}

        def flush(key: tuple[int, bool]) -> pa.RecordBatch:
            own = held.pop(key)
            m = _padded([v for _, v in own])
            ids = np.array([i for i, _ in own], np.int64)
            made[key[0]] = made.get(key[0], -1) + 1
            exact = unpack(pack(m), m.shape[1], len(m))
            asked = np.flatnonzero(ids % every == 0)
            edge = lambda v, up: np.nextafter(_floats(v), up)
            columns = [[key[0] * 1_000_000 + made[key[0]]], [m.shape[1]], [ids.tobytes()], [pack(m)], [edge(exact.max(0), np.inf).tobytes()], [edge(exact.min(0), -np.inf).tobytes()], [asked.tobytes()]]
            return _record(columns, [pa.int64(), pa.int32(), *[pa.binary()] * 5], "block dim ids rows high low queries")

        for batch in batches:
            vectors, good = usable(batch.column(1))
            ids, at = (np.array(batch.column(i).to_pylist(), np.int64)[good] for i in (0, 2))
            for v, i, k in zip(vectors, ids.tolist(), at.tolist(), strict=True):
                key = (k, bool(len(v) and np.abs(v).max() >= WIDE))
                held.setdefault(key, []).append((i, v))
                if len(held[key]) >= rows:
                    yield flush(key)
            for key in [x for x in held if len(at) and x[0] < at[-1]]:  # rows come in order of ranges
                yield flush(key)
        for key in sorted(held):
            yield flush(key)

    return dealt.mapInArrow(run, BLOCK)


def _scores(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Exact integer products: by floats or 64-bit integers where these are exact, else by Python's integers."""
    dim = min(q.shape[1], m.shape[1])
    q, m = q[:, :dim], m[:, :dim]
    largest = float(np.abs(_floats(q)).max(initial=0)) * float(np.abs(_floats(m)).max(initial=0)) * max(dim, 1)
    if largest < 2.0**53:
        return (q.astype(float) @ m.T.astype(float)).astype(np.int64)
    kind = np.int64 if largest < 2.0**62 else object
    return q.astype(kind) @ m.T.astype(kind) if dim else np.zeros((len(q), len(m)), np.int64)


def _bounds(q: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For queries and blocks (a row each) what no score passes, with room for what floats round."""
    dim = min(q.shape[1], high.shape[1])
    q = _floats(q[:, :dim])
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    with np.errstate(over="ignore", invalid="ignore"):
        out = up @ high[:, :dim].T + down @ low[:, :dim].T
        room = up @ np.abs(high[:, :dim]).T - down @ np.abs(low[:, :dim]).T
        out = out + room * 1e-12 + 0.5
    return np.where(np.isnan(out), np.inf, out)


def _below(x: np.ndarray) -> np.ndarray:
    """Floats that are not above some integers."""
    f = _floats(x)
    return np.where(np.isfinite(f), f - np.abs(f) * 2.0**-50, np.where(f > 0, 1e308, f))


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties by id."""
    own = np.arange(len(score))
    if len(own) > k and score.dtype != object:
        own = np.flatnonzero(score >= np.partition(score, -k)[-k])
    return np.array(sorted(own.tolist(), key=lambda i: (-score[i], ids[i])), int)[:k] if score.dtype == object else own[np.lexsort((ids[own], -score[own]))[:k]]


def _stack(rows: list[bytes]) -> np.ndarray:
    return _padded([np.frombuffer(r) for r in rows])


def candidates(stored: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Packs of queries, and (pack, block, bounds, floors): the pairs in which some query's bound reaches its floor."""

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                asked = np.frombuffer(x["queries"], np.int64)
                ids = np.frombuffer(x["ids"], np.int64)
                width = {2: 2, 8: 8, 255: 8}[x["rows"][0]] * x["dim"]
                for a in range(0, len(asked), PACK):
                    own = asked[a : a + PACK]
                    body = x["rows"][:1] + b"".join(x["rows"][1 + width * i : 1 + width * (i + 1)] for i in own.tolist())
                    yield _record([[x["block"] * 4096 + a // PACK], [x["block"]], [x["dim"]], [own.tobytes()], [ids[own].tobytes()], [body]], [pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 3], "q home qdim qat qids qrows")

    asked = stored.select("block", "dim", "ids", "rows", "queries").mapInArrow(packs, "q long, home long, qdim int, qat binary, qids binary, qrows binary").checkpoint()
    shelves = max(1, -(-stored.count() // SHELF))
    outlines = stored.select(F.pmod(F.xxhash64("block"), F.lit(shelves)).alias("shelf"), "block", "high", "low")
    outlines = outlines.groupBy("shelf").agg(F.collect_list(F.struct("block", "high", "low")).alias("outlines"))  # about SHELF of them
    meet = asked.withColumn("shelf", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shelves - 1).cast("long")))).join(outlines, "shelf")

    def queries(x: dict) -> np.ndarray:
        return unpack(x["qrows"], x["qdim"], len(x["qids"]) // 8)

    def shelf_bounds(x: dict) -> np.ndarray:
        return _bounds(queries(x), _stack([o["high"] for o in x["outlines"]]), _stack([o["low"] for o in x["outlines"]]))

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                b = shelf_bounds(x)
                at = b.argmax(1)
                n = len(b)
                yield _record([[x["q"]] * n, list(range(n)), [x["outlines"][j]["block"] for j in at.tolist()], b[np.arange(n), at].tolist()], [pa.int64(), pa.int32(), pa.int64(), pa.float64()], "q i block bound")

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                own = np.array(x["own"])
                m = unpack(x["rows"], x["dim"], len(x["ids"]) // 8)
                s = _scores(queries(x)[own], m)
                at, out = np.frombuffer(x["qat"], np.int64)[own], []
                for row, mine in zip(s, at.tolist(), strict=True):
                    row = np.delete(row, mine) if x["home"] == x["block"] else row
                    out.append(-np.inf if len(row) < k else float(_below(np.sort(row)[-k : len(row) - k + 1])[0]))
                yield _record([[x["q"]] * len(own), own.tolist(), out], [pa.int64(), pa.int32(), pa.float64()], "q i floor")

    first = meet.mapInArrow(highest, "q long, i int, block long, bound double").groupBy("q", "i").agg(F.max_by("block", F.struct("bound", "block")).alias("block"))
    first = first.groupBy("q", "block").agg(F.collect_list("i").alias("own"))  # PACK of them at most
    least = first.join(asked, "q").join(stored.select("block", "dim", "ids", "rows"), "block").mapInArrow(floors, "q long, i int, floor double")
    least = least.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("i", "floor"))).alias("floors"))

    def reaches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                b, floor = shelf_bounds(x), np.array([f["floor"] for f in x["floors"]])
                own = np.flatnonzero((b >= floor[:, None]).any(0))
                if len(own):
                    yield _record([[x["q"]] * len(own), [x["outlines"][j]["block"] for j in own.tolist()], [b[:, j].tobytes() for j in own.tolist()], [floor.tobytes()] * len(own)], [pa.int64(), pa.int64(), pa.binary(), pa.binary()], "q block bounds floors")

    return asked, meet.join(least, "q").mapInArrow(reaches, "q long, block long, bounds binary, floors binary")


def search(table: DataFrame, every: int = 20, k: int = 20, rows: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best rows. Queries are the rows whose vec_id `every` divides."""
    spark = table.sparkSession
    shared_dir(spark)
    tune(spark, PAIRS)
    stored = blocks(table, every, rows).checkpoint()
    asked, kept = candidates(stored, k)
    parts = max(1, -(-stored.count() // PART))
    full = kept.withColumn("part", F.pmod(F.hash("block"), F.lit(parts))).join(asked, "q").join(stored.select("block", "dim", "ids", "rows"), "block")
    full = full.repartition("q", "part").sortWithinPartitions("q", "part", "block")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[dict]) -> Iterator[pa.RecordBatch]:
            one = held[0]
            qids, qat = np.frombuffer(one["qids"], np.int64), np.frombuffer(one["qat"], np.int64)
            q, floor = unpack(one["qrows"], one["qdim"], len(qids)), np.frombuffer(one["floors"])
            matrix = [unpack(x["rows"], x["dim"], len(x["ids"]) // 8) for x in held]
            ids, bounds = [np.frombuffer(x["ids"], np.int64) for x in held], np.stack([np.frombuffer(x["bounds"]) for x in held])
            out: list[tuple] = []
            for i in range(len(qids)):
                best, names, least = np.zeros(0, np.int64), np.zeros(0, np.int64), floor[i]
                for j in np.argsort(-bounds[:, i], kind="stable").tolist():
                    if bounds[j, i] < least:
                        break
                    s, own = _scores(q[i : i + 1], matrix[j])[0], ids[j]
                    if held[j]["block"] == one["home"]:
                        s, own = np.delete(s, qat[i]), np.delete(own, qat[i])
                    best, names = np.concatenate([best, s]), np.concatenate([names, own])
                    top = _best(best, names, k)
                    best, names = best[top], names[top]
                    if len(best) == k:
                        least = max(least, float(_below(best[-1:])[0]))
                for s, own in zip(best.tolist(), names.tolist(), strict=True):
                    fits = -(2**63) <= s < 2**63
                    out.append((int(qids[i]), one["q"], i, own, s if fits else None, None if fits else float(s > 0)))
            if out:
                yield _record([list(c) for c in zip(*out, strict=True)], [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64()], "query_id q i vec_id score over")

        key, held = None, []
        for batch in batches:
            for x in batch.to_pylist():
                if key != (x["q"], x["part"]):
                    if held:
                        yield from flush(held)
                    key, held = (x["q"], x["part"]), []
                held.append(x)
        if held:
            yield from flush(held)

    found = full.mapInArrow(score, "query_id long, q long, i int, vec_id long, score long, over double")
    # what no long can hold sorts before or after all that one can; among the k best it is an error
    rank = F.row_number().over(Window.partitionBy("q", "i").orderBy(F.desc(F.coalesce(F.col("over") * 2 - 1, F.lit(0.0))), F.desc("score"), "vec_id"))
    value = F.when(F.col("over").isNull(), F.col("score")).otherwise(F.raise_error(F.lit("a score does not fit a long")).cast("long"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", value.alias("score"))
