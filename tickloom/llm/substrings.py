"""Substring dedup of words with difference-cover anchors.

Windows of 15 words are hashed only at places whose remainder modulo 21 is in a difference cover. Any two equal windows of 35
words share an aligned pair of such anchors; where an anchor is shared, the windows around it are extended to 35 words and
compared (see repeats).

Edge cases: null or empty texts have no words; texts below 35 words stay; rows that repeat a text (or a doc_id) count as
occurrences of each other; a null doc_id is a document like others; very long texts are read whole; an empty table gives
none; extra columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .repeats import Job, Shard, covered, find, frame, ids

FIELDS = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "kept_text": pa.string()}
TYPES = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def remove_repeats(docs: DataFrame, window: int = 35, with_text: bool = True, shard_bytes: int = 16 << 20) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text); kept_text is null unless with_text."""
    job = Job(words=True, window=window, period=21, by_order=False)

    def finish(shard: Shard, elsewhere: np.ndarray, skip: np.ndarray, marks: list) -> pa.Table:
        gone: dict[int, np.ndarray] = {}
        for run, mark in zip(shard.runs(skip), marks, strict=True):
            gone.update(zip(run.docs.tolist(), np.split(covered(mark, window), run.first[1:-1]), strict=True))
        out = []
        for i, (doc_id, text) in enumerate(zip(ids(shard), shard.text, strict=True)):
            words = text.split()
            all_gone = elsewhere[i] and len(words) >= window
            mask = np.full(len(words), all_gone) if all_gone or i not in gone else gone[i]
            kept = b" ".join(w for w, m in zip(words, mask.tolist(), strict=True) if not m)
            out.append((doc_id, len(words), int(mask.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
        return frame(out, FIELDS)

    return find(docs, job, finish, TYPES, shard_bytes)
