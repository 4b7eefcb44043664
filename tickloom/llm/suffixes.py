"""Suffix-array dedup of bytes with a difference cover, to the depth that the removal needs.

A byte goes if it is covered by a string of 50 bytes that also starts in a document with a smaller doc_id. That needs the
suffix array no deeper than 50 bytes. Suffixes at cover positions modulo 21 are sorted by their first 30 bytes and named;
triples of names 21 bytes apart are sorted and named in turn, which is one step of recursion and stands for 72 bytes; the
remaining suffixes, which no longer prefix has settled, are merged by their first 50 bytes, and adjacent ones with equal
prefixes compared (see repeats). Sort keys are hashes of the prefixes, so equal prefixes are neighbours, but unequal ones are
not in alphabetical order, which nothing here asks for.

Edge cases: a null or empty text has no bytes; a null doc_id is smaller than none and larger than none, so its text neither
loses bytes nor takes any; rows that repeat a doc_id leave each other alone; a text below 50 bytes stays; very long texts are
read whole; an empty table gives none; extra columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import Job, Shard, covered, find, frame, ids

FIELDS = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "kept_bytes": pa.binary()}
TYPES = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary"


def remove_repeats(docs: DataFrame, with_bytes: bool = True, shard_bytes: int = 8 << 20) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_bytes); kept_bytes is null unless with_bytes."""
    job = Job(words=False, window=50, period=21, by_order=True, deeper=True)

    def finish(shard: Shard, elsewhere: np.ndarray, skip: np.ndarray, marks: list) -> pa.Table:
        gone: dict[int, np.ndarray] = {}
        for run, mark in zip(shard.runs(skip), marks, strict=True):
            gone.update(zip(run.docs.tolist(), np.split(covered(mark, job.window), run.first[1:-1]), strict=True))
        # the first row of each text in the shard stands for later ones; of equal ids, it is not a smaller document
        out, first = [], {}
        for i, (doc_id, text) in enumerate(zip(ids(shard), shard.text, strict=True)):
            if i in gone:
                mask = gone[i]
                first.setdefault(text, i)
            elif len(text) < job.window:
                mask = np.zeros(len(text), bool)
            elif text in first and shard.id[first[text]] == shard.id[i]:
                mask = gone[first[text]]
            else:
                mask = np.ones(len(text), bool)
            kept = np.frombuffer(text, np.uint8)[~mask].tobytes()
            spans = int(np.count_nonzero(np.diff(mask.astype(np.int8), prepend=0) == 1))
            out.append((doc_id, len(text), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if with_bytes else None))
        return frame(out, FIELDS)

    found = find(docs.filter("doc_id is not null"), job, finish, TYPES, shard_bytes)
    text = F.coalesce(F.col("text"), F.lit(""))
    alone = docs.filter("doc_id is null").select(F.lit(None).cast("long"), F.octet_length(text).cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long"), F.sha2(text, 256), text.cast("binary") if with_bytes else F.lit(None).cast("binary"))
    return found.union(alone)
