"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the model goes on across a whitespace marker, so a text may be cut before each run of markers, and around line
breaks where no piece has one; the pieces of a chunk do not depend on what stands beside it. Each shard of texts sends its
distinct chunks, once each, to parts by hash; a part segments each distinct chunk once, with the sentencepiece library, and
sends the ids back in the order in which they were asked for; the shard joins them by position. So a common chunk is one
request a shard, and the library sees it once. (A part's distinct chunks are in its task's memory: parts are as many as
PART_BYTES of text asks for.) Mail has shards x parts rows while slices are long, and never more rows than chunks.

A model must leave texts as they are but for markers (no character map, extra spaces kept, markers before words) and its
pieces must not cross markers; another one raises ValueError, as nothing else would be exact.

Edge cases: a null text is an empty one, and an empty text has no ids and decodes to an empty text; a text is never cut for
its length, also one that is a single chunk; rows that repeat are encoded each; a null doc_id is kept; control strings such
as </s> in a text are ordinary text; an empty table gives none; extra columns are left out.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shards import MAIL, answered, deal, mail, opened, rows_of, shard_of, squeezed
from ._text import tune

MARK = "▁"
PART_BYTES = 64 << 20


def read_model(path: str | None = None) -> bytes:
    """A model file's bytes, which go to tasks with their code; without a path, the public model."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as f:
        return f.read()


class Model:
    """A model, how its texts are cut into chunks, and the ids of a chunk."""

    def __init__(self, body: bytes):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(body)
        rules = proto.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("the model changes texts by more than whitespace markers")
        words = [p.piece for p in proto.pieces if p.type not in (2, 3, 6)]  # fixed values: unknown, control, byte
        if any(MARK in p.lstrip(MARK) for p in words):
            raise ValueError("pieces of the model cross whitespace markers")
        lines = not any("\n" in p for p in words)
        self.find = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n" if lines else f"{MARK}+[^{MARK}]*|[^{MARK}]+").findall
        self.kind = "H" if len(proto.pieces) <= 1 << 16 else "i"  # of an id on its way
        self.width = array(self.kind).itemsize
        self.prefix = MARK if rules.add_dummy_prefix else ""
        self.decoder = SentencePieceProcessor(model_proto=body)
        rules.add_dummy_prefix = False
        self.encoder = SentencePieceProcessor(model_proto=proto.SerializeToString())  # of chunks, which have their markers

    def chunks(self, text: str) -> list[str]:
        """A text's chunks in order."""
        return self.find(self.prefix + text.replace(" ", MARK)) if text else []

    def ids(self, chunks: list[str]) -> list[list[int]]:
        """The ids of each of some chunks."""
        return self.encoder.encode(chunks, num_threads=1)


@lru_cache(maxsize=2)
def opened_model(body: bytes) -> Model:
    """One model a worker."""
    return Model(body)


def _slices(chunks: list[str], parts: int) -> Iterator[tuple[int, list[str]]]:
    """Distinct chunks by part, in a fixed order."""
    by: dict[int, list[str]] = {}
    for c in chunks:
        by.setdefault(zlib.crc32(c.encode()) % parts, []).append(c)
    for part in sorted(by):
        yield part, sorted(by[part])


def _strings(chunks: list[str]) -> bytes:
    raw = [c.encode() for c in chunks]
    return squeezed(np.array([len(r) for r in raw], np.int32), np.frombuffer(b"".join(raw), np.uint8))


def _unstring(body: bytes) -> list[str]:
    lengths, raw = opened(body)
    ends, view = np.cumsum(lengths.view(np.int32)).tolist(), raw.tobytes()
    return [view[a:b].decode() for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _listed(counts: np.ndarray, flat: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(flat, pa.int32()))


def encode(docs: DataFrame, model: bytes | None = None, shard_bytes: int = 6 << 20) -> DataFrame:
    """(doc_id, ids): what the library gives for each whole text, without begin or end."""
    tune(docs.sparkSession)
    body = model or read_model()
    opened_model(body)  # an unfit model fails here
    kind = docs.schema["doc_id"].dataType.simpleString()
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 1
    shards, parts = max(1, -(-total // shard_bytes)), max(64, total // PART_BYTES)
    dealt = deal(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), F.xxhash64("doc_id", "text"), shards)

    def ask(blocks: pa.Table) -> pa.Table:
        m, seen = opened_model(body), set()
        for text in rows_of(blocks)["text"].to_pylist():
            seen.update(m.chunks(text))
        return mail([(part, shard_of(blocks), _strings(own)) for part, own in _slices(list(seen), parts)])

    def answer(came: Iterator[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, bytes]]:
        m, now, table = opened_model(body), -1, {}
        for part, shard, asked in came:
            if part != now:
                now, table = part, {}
            chunks = _unstring(asked)
            new = [c for c in chunks if c not in table]
            table.update(zip(new, (array(m.kind, x).tobytes() for x in m.ids(new)), strict=True))
            got = [table[c] for c in chunks]
            yield part, shard, squeezed(np.array([len(x) for x in got], np.int32) // m.width, np.frombuffer(b"".join(got), np.uint8))

    def join(blocks: pa.Table, inbox: pa.Table) -> pa.Table:
        m, place, rows = opened_model(body), defaultdict(), rows_of(blocks)
        place.default_factory = place.__len__  # a new chunk's place is the number of those before it
        if not rows.num_rows:
            return pa.table({"doc_id": rows["doc_id"], "ids": _listed(np.zeros(0, np.int64), np.zeros(0, np.int32))})
        at = [np.fromiter(map(place.__getitem__, m.chunks(text)), np.int32) for text in rows["text"].to_pylist()]
        bodies = dict(zip(inbox["part"].to_pylist(), inbox["body"].to_pylist(), strict=True))
        counts, flat, own = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], []
        for part, chunks in _slices(list(place), parts):
            n, x = opened(bodies[part])
            counts.append(n.view(np.int32))
            flat.append(x.view(m.kind).astype(np.int32))
            own += [place[c] for c in chunks]
        counts, flat = np.concatenate(counts), np.concatenate(flat)
        back = np.empty(len(own), np.int64)
        back[own] = np.arange(len(own))
        begin = np.cumsum(counts, dtype=np.int64) - counts
        where = back[np.concatenate(at)]
        length = counts[where].astype(np.int64)
        ends = np.cumsum(length)
        ids = flat[np.repeat(begin[where] - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)]
        edge = np.cumsum([0, *map(len, at)])
        return pa.table({"doc_id": rows["doc_id"], "ids": _listed(np.diff(np.concatenate([[0], ends])[edge]), ids)})

    requests = dealt.groupBy("shard").applyInArrow(ask, MAIL)
    return dealt.groupBy("shard").cogroup(answered(requests, parts, answer).groupBy("shard")).applyInArrow(join, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, model: bytes | None = None) -> DataFrame:
    """Adds text: what the library's decode(ids) gives for each row's ids; null ids count as none."""
    tune(encoded.sparkSession)
    body, names = model or read_model(), encoded.columns
    from pyspark.sql.types import StringType, StructType

    fields = StructType([*encoded.schema.fields]).add("text", StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = opened_model(body).decoder
        for batch in batches:
            ids = batch.column(names.index("ids")).fill_null([])
            edges, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
            texts = [decoder.decode(flat[a:b].tolist()) if a < b else "" for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, "text"])

    return encoded.mapInArrow(run, fields)


def digest(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded documents; both read back from the ids."""
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decode(encoded).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
