"""Best-fit packing under conflicts.

A document is its bytes. Whole runs of `capacity` bytes fill bins of their own; what is left of each document is packed,
longest first, into bins ordered by what they have left. A bin carries a bitmap of its sources and its clusters of
duplicates. The search starts at the tightest bin with room and goes on to the next until one has neither the document's
cluster nor a source that conflicts with its own; else a bin is opened. Bins that the cluster is in are passed by bisection. Clusters are those of the column `cluster`, such as a
component of near copies, and where that is null or not named, exact copies.

Documents are dealt by a hash into shards of about `shard_rows`, or with text of about `shard_bytes` if these are more, each
packed on its own, one after the other, so a shard is the most that a task holds, whatever the size of a source or of a group
of copies. The hash takes in the partition that a row comes from, so that rows which repeat in full are dealt out too; the
same files give the same bins. Bitmaps number the clusters within a shard.

Edge cases: null or empty texts take 0 bytes and still get a place; rows that repeat a doc_id conflict through their text;
a null source conflicts with none; an empty table gives no bins; other columns are left out.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import tune

FIELDS = "bin_id string, slot int, doc_id long, start long, n_bytes long, free long"


def best_fit(items: list[tuple[int, int, int]], capacity: int, conflicts: dict[int, int]) -> tuple[list[list[int]], list[int]]:
    """Bins (indices into items) and what each has left. items: (bytes, cluster or 0, source bitmap), the longest first."""
    left: list[tuple[int, int]] = []  # (residual, bin), ascending
    having: dict[int, list[tuple[int, int]]] = {}  # the same of the bins that a cluster is in
    clusters: list[list[int]] = []
    sources: list[int] = []
    bins: list[list[int]] = []
    for k, (size, cluster, source) in enumerate(items):
        against, own = conflicts.get(source, 0), having.get(cluster, [])
        i = bisect.bisect_left(left, (size, -1))
        while i < len(left):
            # the bins that the cluster is in are some of these, in the same order: up to the first that it is not in, both
            # lists are the same from here, and from there on they differ at each step
            j = bisect.bisect_left(own, left[i])
            i += bisect.bisect_left(range(min(len(own) - j, len(left) - i)), True, key=lambda d, i=i, j=j: own[j + d] != left[i + d])
            if i < len(left) and not sources[left[i][1]] & against:
                break
            i += 1
        if i < len(left):
            residual, b = left.pop(i)
            for c in clusters[b]:
                having[c].pop(bisect.bisect_left(having[c], (residual, b)))
        else:
            residual, b = capacity, len(bins)
            bins.append([])
            clusters.append([])
            sources.append(0)
        bins[b].append(k)
        if cluster:
            clusters[b].append(cluster)
        sources[b] |= source
        bisect.insort(left, (residual - size, b))
        for c in clusters[b]:
            bisect.insort(having.setdefault(c, []), (residual - size, b))
    free = dict((b, r) for r, b in left)
    return bins, [free[b] for b in range(len(bins))]


def _shard(shard: int, rows: list[tuple], capacity: int, pairs: tuple[tuple[str, str], ...]) -> Iterator[tuple]:
    """Rows of the result for one shard. rows: (doc_id, source, length, cluster, bytes of the text or None)."""
    rows.sort(key=lambda r: (-(r[2] % capacity), r[0] is None, r[0] or 0, r[3], r[1] or "", r[4] or b""))
    copies = Counter(r[3] for r in rows)
    bit = {h: 1 << i for i, h in enumerate(sorted(h for h, n in copies.items() if n > 1))}
    source = {s: 1 << i for i, s in enumerate(sorted({r[1] for r in rows if r[1] is not None}))}
    against: dict[int, int] = {}
    for a, b in pairs:
        if a in source and b in source:
            against[source[a]] = against.get(source[a], 0) | source[b]
            against[source[b]] = against.get(source[b], 0) | source[a]
    whole = 0
    for doc_id, _, n, _, text in rows:
        for piece in range(n // capacity):
            yield f"{shard}-w{whole}", 0, doc_id, piece * capacity, capacity, 0, text
            whole += 1
    rest = [r for r in rows if r[2] % capacity or not r[2]]
    bins, free = best_fit([(r[2] % capacity, bit.get(r[3], 0), source.get(r[1], 0)) for r in rest], capacity, against)
    for b, own in enumerate(bins):
        for slot, k in enumerate(own):
            doc_id, _, n, _, text = rest[k]
            yield f"{shard}-{b}", slot, doc_id, n - n % capacity, n % capacity, free[b], text


def pack(docs: DataFrame, capacity: int = 8192, source_conflicts: tuple[tuple[str, str], ...] = (), shard_rows: int = 10_000, with_text: bool = False, cluster: str | None = None, shard_bytes: int = 64 << 20) -> DataFrame:
    """One row per piece: its bin, slot, document, first byte and length, and the bytes that its bin has left. with_text
    adds the piece's own bytes."""
    tune(docs.sparkSession)
    length = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    size = docs.agg(F.count("*").alias("rows"), F.sum(length).alias("bytes")).first()
    shards = max(1, -(-size["rows"] // shard_rows), -(-(size["bytes"] or 0) // shard_bytes) if with_text else 0)
    text = F.coalesce("text", F.lit("")).cast("binary") if with_text else F.lit(None).cast("binary")
    copies = F.xxhash64(F.coalesce("text", F.lit("")))
    group = copies if cluster is None else F.when(F.col(cluster).isNull(), copies).otherwise(F.xxhash64(F.lit("cluster"), F.col(cluster)))
    shard = F.pmod(F.xxhash64("doc_id", length, copies, F.spark_partition_id()), F.lit(shards)).cast("int")
    rows = docs.select("doc_id", "source", length.alias("n"), group.alias("h"), text.alias("text"), shard.alias("shard")).repartition(shards, "shard").sortWithinPartitions("shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(k: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
            out, size = [], 0
            for row in _shard(k, held, capacity, source_conflicts):
                piece = row[6][row[3] : row[3] + row[4]] if with_text else None
                out.append((*row[:6], piece))
                size += 64 + len(piece or b"")
                if size > 4 << 20:
                    yield batch_of(out)
                    out, size = [], 0
            if out:
                yield batch_of(out)

        now, held = -1, []
        for batch in batches:
            doc_id, source, n, h, body, shard = (c.to_pylist() for c in batch.columns)
            for k, *row in zip(shard, doc_id, source, n, h, body, strict=True):
                if k != now and held:
                    yield from packed(now, held)
                    held = []
                now = k
                held.append(tuple(row))
        if held:
            yield from packed(now, held)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))[: 7 if with_text else 6]
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = [f.split()[0] for f in FIELDS.split(", ")] + ["piece"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names[: len(columns)])

    return rows.mapInArrow(run, FIELDS + (", piece binary" if with_text else ""))
