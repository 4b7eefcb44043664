"""Rows dealt to shards of a bounded size, and mail between shards and parts.

A shard holds some rows, a part holds a range or a hash bucket of keys. A shard asks a part about its distinct keys with one
row of mail, and the part answers with one row. So what is common has one request a shard, however often it occurs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAIL = "part long, shard int, body binary"
HELD = 32 << 20  # bytes that a task gathers before it hands out blocks
LEVEL = 6  # of compression: a tenth smaller than the usual one, for a second of CPU per 100 MB


def squeezed(*arrays: np.ndarray) -> bytes:
    """Some arrays of one kind as compressed bytes: how many, their lengths in bytes, then their bytes."""
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64).tobytes()
    return pa.Codec("zstd", LEVEL).compress(head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays), asbytes=True) + np.int64(len(head) + sum(a.nbytes for a in arrays)).tobytes()


def opened(body: bytes) -> list[np.ndarray]:
    """What squeezed() was given, as bytes."""
    raw = np.frombuffer(pa.decompress(body[:-8], decompressed_size=int(np.frombuffer(body[-8:], np.int64)[0]), codec="zstd"), np.uint8)
    n = int(raw[:8].view(np.int64)[0])
    ends = np.cumsum([8 + 8 * n, *raw[8 : 8 + 8 * n].view(np.int64).tolist()])
    return [raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def mail(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    """Rows of (part, shard, body)."""
    part, shard, body = zip(*rows, strict=True) if rows else ([], [], [])
    return pa.table([pa.array(part, pa.int64()), pa.array(shard, pa.int32()), pa.array(body, pa.binary())], ["part", "shard", "body"])


def packed(rows: pa.Table) -> bytes:
    """Rows as one compressed block."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", LEVEL))) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def unpacked(block: pa.Buffer) -> pa.Table:
    """What packed() was given."""
    return pa.ipc.open_stream(block).read_all()


def deal(rows: DataFrame, salt: Column, shards: int) -> DataFrame:
    """(shard, block): rows by a salt, in compressed blocks; a task hands out blocks whenever it has gathered HELD bytes."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            every = pa.Table.from_batches(held).combine_chunks()
            own = every["_salt"].to_numpy() % shards
            order = np.argsort(own, kind="stable")
            every, own = every.select(names).take(pa.array(order)), own[order]
            edges = np.flatnonzero(np.diff(own, prepend=-1, append=-1))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([own[a]], pa.int32()), pa.array([packed(every.slice(a, b - a))], pa.binary())], ["shard", "block"])

        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) > HELD:
                yield from flush()
                held = []
        if sum(b.num_rows for b in held):
            yield from flush()

    salted = rows.withColumn("_salt", F.pmod(salt, F.lit(1 << 40)))
    return salted.mapInArrow(run, "shard int, block binary").repartition(shards, "shard")


def rows_of(blocks: pa.Table) -> pa.Table:
    """The rows of one shard, in no certain order."""
    return pa.concat_tables([unpacked(b.as_buffer()) for b in blocks["block"].combine_chunks()]).combine_chunks()


def shard_of(blocks: pa.Table) -> int:
    """Which shard some blocks are of."""
    return blocks["shard"][0].as_py()


def answered(requests: DataFrame, parts: int, answer: Callable[[Iterator[tuple[int, int, bytes]]], Iterator[tuple[int, int, bytes]]]) -> DataFrame:
    """Mail brought to its parts, and what a task's answer() makes of the rows (part, shard, body) there, by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        came = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for row in answer(came):
            yield from mail([row]).to_batches()

    return requests.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(run, MAIL)
