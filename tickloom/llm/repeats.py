"""Windows of text that occur more than once, found with difference-cover samples and sorted names.

Units are bytes or words. A window is `window` units of one document. A difference cover of the residues modulo a period has
for any two residues a shift that takes both into the cover. So two equal windows share, at some shift below the period, two
positions that are both sampled, and the `window - period + 1` units from there are equal.

Rounds, over shards of the documents (about `shard_bytes` each):
0. Whole texts: of exact copies only the smallest doc_id goes on.
1. Sampled prefixes, at cover positions only. A prefix is named by its 64-bit key; keys are sorted and merged by their first
   bits only, which is enough to put out what has no equal.
2. Only if a job is `deeper`: recursion. The names at i, i + period and i + 2 periods are a triple, which stands for
   2 periods more than a sample; triples are named by a key of the three full names, sorted and merged like samples. Windows
   inside such a prefix that a smaller document has too are settled, and are not looked at again.
3. Every other suffix that can reach a shared sample is named to the full depth of the window. Names are sorted and merged
   across shards; equal neighbours are equal windows.
In each round a shard sends its distinct keys, sorted and delta-coded, in slices by range of keys. A part merges the slices
of all shards and answers with two bits a key, held by another shard and held by a smaller document's shard. So no key's occurrences are ever gathered: a passage that a third of all documents hold is one key a shard.
A part holds about PART_BYTES of keys, so a round has shards x parts rows while slices are long, and never more rows
than keys.

Shards are ranges of doc_id where order counts, cut by bytes; a doc_id that alone holds more than a shard is several shards
of the same rank. Elsewhere they are dealt by a hash of doc_id and text. Within a shard rows are ordered by (null, doc_id, text),
whatever order they arrive in, so every round sees the same shard, also after a lost task.

What is taken for equal has equal keys of 64 bits: windows in round 3, and in round 2 triples of names, each of which is a key
of 64 bits. The cut keys of round 1 are never proof, they only let more windows through than need be. Two different strings
among n get one key with a chance of about n^2 / 2^65, and a triple has four keys that may fail so, three names and its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._ranges import Ranges, split
from ._text import BYTE_CODE, U64, Words, buffer, distinct, mix, pieces, power, tune

MAIL = "part long, shard int, body binary"
#: Perfect difference covers, period to residues.
COVERS = {21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27)}
PART_BYTES = 64 << 20
EARLIER = 1 << 40  # added to the part of answers of an earlier round
_TRIPLE = U64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Job:
    """What repeats: the units, the window and the cover's period; by_order: only windows that a smaller document has;
    deeper: triples of names settle what they can."""

    words: bool
    window: int
    period: int
    by_order: bool
    deeper: bool = False

    @property
    def sample(self) -> int:
        return self.window - self.period + 1


def pack_names(names: np.ndarray, base: int) -> bytes:
    """Sorted distinct names as differences of as few bytes as the largest needs."""
    gaps = np.diff(names, prepend=U64(base))
    width = max(1, (int(gaps.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack_names(body: bytes, base: int) -> np.ndarray:
    """What pack_names() was given."""
    width = body[0]
    wide = np.zeros(((len(body) - 1) // width, 8), np.uint8)
    wide[:, :width] = np.frombuffer(body, np.uint8, offset=1).reshape(-1, width)
    return np.cumsum(wide.view("<u8").ravel(), dtype=U64) + U64(base)


def _edges(parts: int, bits: int) -> list[int]:
    return [(k << bits) // parts for k in range(parts + 1)]


def _requests(shard: int, names: np.ndarray, parts: int, bits: int) -> Iterator[tuple[int, int, bytes]]:
    """Sorted distinct names below 2^bits, by part."""
    edges = _edges(parts, bits)
    cut = np.searchsorted(names, np.array(edges[:-1], U64)).tolist() + [len(names)]
    for k in range(parts):
        if cut[k] < cut[k + 1]:
            yield k, shard, pack_names(names[cut[k] : cut[k + 1]], edges[k])


def _mail(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    part, shard, body = zip(*rows, strict=True) if rows else ([], [], [])
    return pa.table([pa.array(part, pa.int64()), pa.array(shard, pa.int32()), pa.array(body, pa.binary())], ["part", "shard", "body"])


def merged(part: int, got: list[tuple[int, bytes]], parts: int, bits: int, rank: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """The answers of one part to all its requests (shard, body): packed bits held by another shard, and held by
    one of smaller rank."""
    got.sort()
    base = _edges(parts, bits)[part]
    lists = [unpack_names(body, base) for _, body in got]
    keys = np.concatenate(lists)
    order = np.argsort(keys, kind="stable")  # equal keys stay in the order of shards, whose ranks ascend
    keys, own = keys[order], np.repeat(rank[[k for k, _ in got]], [len(x) for x in lists])[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    length = np.diff(np.append(first, len(keys)))
    other, lower = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    other[order] = np.repeat(length > 1, length)
    lower[order] = own > np.repeat(own[first], length)
    at = 0
    for (shard, _), mine in zip(got, lists, strict=True):
        end = at + len(mine)
        yield part, shard, np.packbits(other[at:end]).tobytes() + np.packbits(lower[at:end]).tobytes()
        at = end


def _answers(mail: DataFrame, parts: int, bits: int, rank: np.ndarray) -> DataFrame:
    """merged() for every part. Mail of negative part passes through: it is what a shard keeps for its next round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = -1, []
        for batch in batches:
            for part, shard, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part < 0:
                    yield from _mail([(part, shard, body)]).to_batches()
                    continue
                if part != now and held:
                    yield from _mail(list(merged(now, held, parts, bits, rank))).to_batches()
                    held = []
                now = part
                held.append((shard, body))
        if held:
            yield from _mail(list(merged(now, held, parts, bits, rank))).to_batches()

    return mail.repartition(max(parts, 1), "part").sortWithinPartitions("part").mapInArrow(run, MAIL)


def _bits(inbox: pa.Table, counts: list[int], offset: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Both answers for all keys sent, in order. counts: keys sent to each part."""
    n = sum(counts)
    other, lower, at = np.zeros(n, bool), np.zeros(n, bool), np.cumsum([0, *counts])
    for part, body in zip(inbox["part"].to_pylist(), inbox["body"].to_pylist(), strict=True):
        k = part - offset
        if part >= 0 and 0 <= k < len(counts):
            n = counts[k]
            size = -(-n // 8)
            other[at[k] : at[k + 1]] = np.unpackbits(np.frombuffer(body, np.uint8, size), count=n)
            lower[at[k] : at[k + 1]] = np.unpackbits(np.frombuffer(body, np.uint8, size, size), count=n)
    return other, lower


def _kept(inbox: pa.Table) -> bytes:
    return next(b for p, b in zip(inbox["part"].to_pylist(), inbox["body"].to_pylist(), strict=True) if p < 0)


class Run:
    """Some documents: their indices, where their units begin (one more entry at the end), and names of any windows."""

    def __init__(self, docs: np.ndarray, first: np.ndarray, code: np.ndarray):
        self.docs, self.first, self.count = docs, first, np.diff(first)
        self.total = np.zeros(len(code) + 1, U64)
        np.cumsum(code * power("up", max(1, len(code)))[: len(code)], out=self.total[1:])

    def __len__(self) -> int:
        return len(self.total) - 1

    def names(self, at: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the windows of a length that begin at some units."""
        if not len(at):
            return np.zeros(0, U64)
        return mix((self.total[at + length] - self.total[at]) * power("down", len(self))[at] + U64(length))

    def docs_at(self, at: np.ndarray) -> np.ndarray:
        """Indices of the documents that some units, in order, are in."""
        return np.repeat(self.docs, np.diff(np.searchsorted(at, self.first)))


class Shard:
    """The documents of one shard by doc_id, nulls last, ties by text: the same in every round, however its rows arrive."""

    def __init__(self, table: pa.Table, job: Job):
        ids, texts = [], []
        for n, id_body, body in zip(table["bytes"].to_pylist(), table["ids"].to_pylist(), table["texts"].to_pylist(), strict=True):
            rows = np.frombuffer(id_body, np.int64).reshape(3, -1)  # id, whether it is null, length
            raw = pa.decompress(body, decompressed_size=n, codec="zstd").to_pybytes() if n else b""
            at = np.cumsum([0, *rows[2]])
            ids += zip(rows[1].tolist(), rows[0].tolist(), strict=True)
            texts += [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        self.null = np.array([bool(ids[i][0]) for i in order], bool)
        self.id = np.array([ids[i][1] for i in order], np.int64)
        self.text = [texts[i] for i in order]
        self.job = job

    def text_names(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct names of whole texts, each document's name's index, and each name's count."""
        names = np.array([int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "big") for t in self.text], U64)
        return np.unique(names, return_inverse=True, return_counts=True)

    def runs(self, skip: np.ndarray) -> Iterator[Run]:
        """Runs of the documents that are not skipped, small enough for a processor's cache."""
        own = np.flatnonzero(~skip)
        at = np.cumsum([0, *(len(self.text[i]) for i in own)])
        for a, b in pieces(at, 1 << 18):
            raw = np.frombuffer(b"".join(self.text[i] for i in own[a:b]), np.uint8)
            if self.job.words:
                words = Words(raw, at[a : b + 1] - at[a])
                yield Run(own[a:b], words.first, words.hash)
            else:
                yield Run(own[a:b], at[a : b + 1] - at[a], BYTE_CODE[raw])

    def samples(self, skip: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, Run]]:
        """For each run: names of the samples, and the units at which they are."""
        cover = np.array(COVERS[self.job.period])
        grid = cover
        for run in self.runs(skip):
            longest = int(run.count.max(initial=0))
            if grid[-1] < longest:
                grid = (np.arange(longest // self.job.period + 2)[:, None] * self.job.period + cover).ravel()
            k = np.searchsorted(grid, run.count - self.job.sample, "right")
            at = np.concatenate([np.zeros(0, np.int64), *(grid[:n] + a for a, n in zip(run.first.tolist(), k.tolist(), strict=False))])
            yield run.names(at, self.job.sample), at, run

    def suffixes(self, skip: np.ndarray, maybe: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, Run]]:
        """For each run: names of the windows that may repeat, and their units."""
        for run, open_ in zip(self.runs(skip), maybe, strict=True):
            at = np.flatnonzero(open_)
            yield run.names(at, self.job.window), at, run

    def triples(self, runs: list[tuple[np.ndarray, np.ndarray, Run]], shared: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each run: keys of the triples of shared samples' names a period apart, their units, and their documents' indices."""
        step, begin = len(COVERS[self.job.period]), 0
        for mine, at, run in runs:
            open_ = shared[begin : begin + len(mine)]
            begin += len(mine)
            doc = run.docs_at(at)
            n = max(0, len(at) - 2 * step)
            k = np.flatnonzero(open_[:n] & open_[step : step + n] & open_[2 * step :][:n] & (doc[:n] == doc[2 * step :][:n]))
            key = mix(mix(mix(mine[k]) * _TRIPLE + mine[k + step]) * _TRIPLE + mine[k + 2 * step])
            yield key, at[k], doc[k].astype(np.int32)

    def settled(self, hit: np.ndarray, run: Run) -> np.ndarray:
        """The units of a run from which a whole window lies within one of the triples' prefixes."""
        change = np.zeros(len(run) + 1, np.int32)
        np.add.at(change, hit, 1)
        np.add.at(change, hit + 2 * self.job.period + self.job.sample - self.job.window + 1, -1)
        return np.cumsum(change[:-1]) > 0

    def reach(self, hit: np.ndarray, run: Run) -> np.ndarray:
        """The units of a run from which a whole window takes in one of the sampled units."""
        change = np.zeros(len(run) + 1, np.int32)
        change[hit + 1] -= 1
        np.add.at(change, np.maximum(hit - self.job.period + 1, 0), 1)
        out = np.cumsum(change[:-1]) > 0
        for a, b in zip(run.first[:-1].tolist(), run.first[1:].tolist(), strict=True):
            out[max(a, b - self.job.window + 1) : b] = False
        return out


def _sent(names: np.ndarray, parts: int, bits: int) -> list[int]:
    return np.diff([*np.searchsorted(names, np.array(_edges(parts, bits)[:-1], U64)), len(names)]).tolist()


def _copies(shard: Shard, inbox: pa.Table, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """For each document: whether its text occurs elsewhere, and whether in a smaller document or an earlier row."""
    names, which, count = shard.text_names()
    other, lower = _bits(inbox, _sent(names, parts, 64))
    first = np.full(len(names), -1)
    first[which[::-1]] = np.arange(len(which))[::-1]
    return (other | (count > 1))[which], lower[which] | (first[which] != np.arange(len(which)))


def _flags(*marks: np.ndarray) -> bytes:
    return pa.compress(b"".join(np.packbits(m).tobytes() for m in marks), codec="zstd", asbytes=True)


def _unflag(body: bytes, *lengths: int) -> list[np.ndarray]:
    sizes = [-(-n // 8) for n in lengths]
    raw = np.frombuffer(pa.decompress(body, decompressed_size=sum(sizes), codec="zstd").to_pybytes(), np.uint8) if sum(sizes) else np.zeros(0, np.uint8)
    ends = np.cumsum([0, *sizes])
    return [np.unpackbits(raw[a:b], count=n).astype(bool) for a, b, n in zip(ends[:-1], ends[1:], lengths, strict=True)]


def _concat(arrays: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, kind)


def _shared(shard: Shard, skip: np.ndarray, inbox: pa.Table, parts: int, bits: int, offset: int = 0) -> tuple[list, np.ndarray]:
    """The samples of a shard's runs, and which of them may be shared."""
    runs = list(shard.samples(skip))
    keys, which, count = np.unique(_concat([n for n, _, _ in runs], U64) >> U64(64 - bits), return_inverse=True, return_counts=True)
    other, _ = _bits(inbox, _sent(keys, parts, bits), offset)
    return runs, (other | (count > 1))[which]


def find(docs: DataFrame, job: Job, finish: Callable[[Shard, np.ndarray, np.ndarray, list], pa.Table], fields: str, shard_bytes: int = 16 << 20) -> DataFrame:
    """finish(shard, elsewhere, skip, marks) makes a shard's result. elsewhere: texts that occur elsewhere; skip: exact
    copies of a smaller document (or, with equal ids, of an earlier row); marks: for each run of the other documents, as
    Shard.runs() gives them, the units at which a repeated window starts. A run's sums are not kept from round to round."""
    spark = docs.sparkSession
    tune(spark)
    units = max(1, docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 1)
    if job.by_order:
        ranges = split(docs.filter("doc_id is not null"), "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)), units, shard_bytes)
    else:
        ranges = Ranges.unordered(-(-units // shard_bytes))
    shards, rank = ranges.shards, ranges.rank
    parts = max(64, units * 8 // (24 if job.words else 4) // PART_BYTES)  # a key of 8 bytes for about 24, or 4, bytes of text
    bits = min(64, units.bit_length() - 2 + 11)  # a sample meets a stranger with a chance of about 2^-11

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def flush(k: int) -> pa.RecordBatch:
            rows = held.pop(k)[1]
            ids = np.array([[r[0] or 0 for r in rows], [r[0] is None for r in rows], [len(r[1]) for r in rows]], np.int64)
            raw = b"".join(r[1] for r in rows)
            return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([len(raw)], pa.int64()), pa.array([ids.tobytes()], pa.binary()), pa.array([pa.compress(raw, codec="zstd", asbytes=True)], pa.binary())], ["shard", "bytes", "ids", "texts"])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            raw, at = buffer(batch.column(1))
            view, salt = raw.tobytes(), batch.column(2).to_numpy(zero_copy_only=False)
            where = ranges.place(np.array([i or 0 for i in ids], np.int64), salt) if job.by_order else salt % shards
            for i, k in enumerate(where.tolist()):
                mine = held.setdefault(k, [0, []])
                mine[1].append((ids[i], view[at[i] : at[i + 1]]))
                mine[0] += int(at[i + 1] - at[i])
                if mine[0] > 4 << 20:
                    yield flush(k)
            if sum(x[0] for x in held.values()) > 32 << 20:
                for k in list(held):
                    yield flush(k)
        for k in list(held):
            yield flush(k)

    salt = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40))
    dealt = docs.select(F.col("doc_id").cast("long"), "text", salt).mapInArrow(deal, "shard int, bytes long, ids binary, texts binary").repartition(shards, "shard")

    def number(table: pa.Table) -> int:
        return table["shard"][0].as_py()

    def whole_texts(table: pa.Table) -> pa.Table:
        names, _, _ = Shard(table, job).text_names()
        return _mail(list(_requests(number(table), names, parts, 64)))

    def sampled(table: pa.Table, inbox: pa.Table) -> pa.Table:
        shard, k = Shard(table, job), number(table)
        elsewhere, skip = _copies(shard, inbox, parts)
        names = distinct(_concat([distinct(n >> U64(64 - bits)) for n, _, _ in shard.samples(skip)], U64))
        return _mail([(-1 - k, k, _flags(elsewhere, skip)), *_requests(k, names, parts, bits)])

    def tripled(table: pa.Table, inbox: pa.Table) -> pa.Table:
        shard, k = Shard(table, job), number(table)
        _, skip = _unflag(_kept(inbox), len(shard.text), len(shard.text))
        keys = distinct(_concat([x for x, _, _ in shard.triples(*_shared(shard, skip, inbox, parts, bits))], U64))
        return _mail([(-1 - k, k, _kept(inbox)), *_requests(k, keys, parts, 64)])

    def deep(table: pa.Table, inbox: pa.Table) -> pa.Table:
        shard, k = Shard(table, job), number(table)
        elsewhere, skip = _unflag(_kept(inbox), len(shard.text), len(shard.text))
        runs, shared = _shared(shard, skip, inbox, parts, bits, EARLIER if job.deeper else 0)
        maybe, settled, at = [], [], 0
        if job.deeper:
            triples = list(shard.triples(runs, shared))
            keys, first, which = np.unique(_concat([x for x, _, _ in triples], U64), return_index=True, return_inverse=True)
            doc = shard.id[_concat([d for _, _, d in triples], np.int32)]
            hit = _bits(inbox, _sent(keys, parts, 64))[1][which] | (doc > doc[first][which])
            for (own, where, _), (_, _, run) in zip(triples, runs, strict=True):
                settled.append(shard.settled(where[hit[at : at + len(own)]], run))
                at += len(own)
            del triples, keys, first, which, doc, hit
        at = 0
        for i, (own, where, run) in enumerate(runs):
            open_ = shard.reach(where[shared[at : at + len(own)]], run)
            maybe.append(open_ & ~settled[i] if job.deeper else open_)
            at += len(own)
        del runs, shared
        names = distinct(_concat([n for n, _, _ in shard.suffixes(skip, maybe)], U64))
        lengths = np.array([len(shard.text), *map(len, maybe)], np.int64).tobytes()
        return _mail([(-1 - k, k, len(lengths).to_bytes(4, "big") + lengths + _flags(elsewhere, skip, *maybe, *settled)), *_requests(k, names, parts, 64)])

    def last(table: pa.Table, inbox: pa.Table) -> pa.Table:
        shard = Shard(table, job)
        body = _kept(inbox)
        size = int.from_bytes(body[:4], "big")
        n, *lengths = np.frombuffer(body, np.int64, size // 8, 4).tolist()
        elsewhere, skip, *rest = _unflag(body[4 + size :], n, n, *lengths, *(lengths if job.deeper else []))
        maybe, settled = rest[: len(lengths)], rest[len(lengths) :]
        runs = [(own, at, run.docs_at(at).astype(np.int32)) for own, at, run in shard.suffixes(skip, maybe)]
        names, first, which, count = np.unique(_concat([x for x, _, _ in runs], U64), return_index=True, return_inverse=True, return_counts=True)
        other, lower = _bits(inbox, _sent(names, parts, 64))
        if job.by_order:
            doc = shard.id[_concat([d for _, _, d in runs], np.int32)]
            hit = lower[which] | (doc > doc[first][which])
        else:
            hit = (other | (count > 1))[which]
        marks, at = [], 0
        for i, ((own, where, _), open_) in enumerate(zip(runs, maybe, strict=True)):
            mark = settled[i] if job.deeper else np.zeros(len(open_), bool)
            mark[where[hit[at : at + len(own)]]] = True
            at += len(own)
            marks.append(mark)
        return finish(shard, elsewhere, skip, marks)

    def turn(answers: DataFrame, f: Callable, out: str) -> DataFrame:
        return dealt.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(f, out)

    answers = _answers(dealt.groupBy("shard").applyInArrow(whole_texts, MAIL), parts, 64, rank)
    answers = _answers(turn(answers, sampled, MAIL), parts, bits, rank)
    if job.deeper:
        again = answers.filter("part >= 0").withColumn("part", F.col("part") + EARLIER)
        answers = _answers(turn(answers, tripled, MAIL), parts, 64, rank).unionByName(again)
    answers = _answers(turn(answers, deep, MAIL), parts, 64, rank)
    return turn(answers, last, fields)


def covered(marks: np.ndarray, window: int) -> np.ndarray:
    """Units that a marked window covers."""
    change = np.zeros(len(marks) + window + 1, np.int32)
    at = np.flatnonzero(marks)
    change[at] += 1
    change[at + window] -= 1
    return np.cumsum(change)[: len(marks)] > 0


def frame(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.Table:
    """A table of rows."""
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds))


def ids(shard: Shard) -> list[int | None]:
    """The documents' ids."""
    return [None if n else i for i, n in zip(shard.id.tolist(), shard.null.tolist(), strict=True)]
