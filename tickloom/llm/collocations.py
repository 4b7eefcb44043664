"""Phrase collocations per language: phrases of 2 to 5 words that occur together far more often than their parts would.

Texts are split into pieces, and identical pieces become one with a multiplicity. Distinct pieces are dealt to shards. A shard
sorts the hashes of its n-grams, cut to so many bits that there are several cells for each n-gram of the corpus, adds up the
multiplicities of equal ones and sends them to the parts that own these cells. A part adds up all shards' cells and answers
with a bit a cell: could a frequent phrase be in here? No phrase is lost by that, as a cell's total is at least that of each
phrase in it. What is in such a cell is then counted by its full text: shards send each phrase once with its local count, in
one block for each hash bucket, and a bucket's task counts them in duckdb, which goes to disk beyond `memory`. Cuts and the phrases
inside longer ones are lookups by phrase, as shuffled joins. So memory is bounded by shards and parts, whose number grows with
the corpus, and a word or phrase that is everywhere is one row a shard. (N-grams are told apart in a shard by 64-bit hashes.)

Arithmetic: products are decimals of up to 38 digits, divided as such; a * n of 10^35 and more (a language of over 3 * 10^17
words) ends in an error, not in a rounded score.

Edge cases: a null text is empty, a null lang is "und"; empty pieces have no words; a text is never cut for its length, also
one that is a single piece; doc_id does not matter, rows that repeat count each; an empty table gives none; extra columns are
left out.
"""

from __future__ import annotations

import hashlib
import itertools
import string
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shards import MAIL, answered, deal, mail, opened, packed, rows_of, shard_of, squeezed, unpacked
from ._state import shared_dir
from ._text import U64, Words, buffer, mix, pieces as runs_of, tune
from .repeats import _edges, pack_names, unpack_names

LONGEST, PART_BYTES = 5, 64 << 20
FEW = 1_000_000  # languages whose totals may be broadcast, of some dozen bytes each
COUNTS = "lang string, words int, phrase string, f long"


def pieces(docs: DataFrame) -> DataFrame:
    """(lang, piece, copies): distinct pieces, lower case, words with one space between."""
    lower = F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    every = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.explode(F.split(lower, r"[.,;:!?\x0A-\x0D]")).alias("piece"))
    return every.select("lang", F.trim(F.regexp_replace("piece", r"[\x20\x09]+", " ")).alias("piece")).filter("piece <> ''").groupBy("lang", "piece").agg(F.count("*").alias("copies"))


class Grams:
    """The n-grams of one shard's pieces, in runs: hashes that tell languages apart, first words, and multiplicities."""

    def __init__(self, blocks: pa.Table):
        rows = rows_of(blocks)
        raw, at = buffer(rows["piece"])
        self.langs = rows["lang"].combine_chunks().dictionary_encode()
        salts = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in self.langs.dictionary.to_pylist()], U64)
        self.lang, copies = self.langs.indices.to_numpy(), rows["copies"].to_numpy()
        self.runs = []
        for a, b in runs_of(at):
            own = raw[at[a] : at[b]]
            words = Words(own, at[a : b + 1] - at[a])
            self.runs.append((a, own, words, mix(words.hash + salts[self.lang[a:b]][words.text]), copies[a:b]))

    def of(self, n: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each run: hashes, first words, multiplicities."""
        out = []
        for _, _, words, base, copies in self.runs:
            h, first = words.grams(n, base)
            out.append((h, first, copies[words.text[first]]))
        return out

    def totals(self) -> list[tuple[str, int]]:
        """Words of each language."""
        n = np.zeros(len(self.langs.dictionary), np.int64)
        for a, _, words, _, copies in self.runs:
            np.add.at(n, self.lang[a : a + len(copies)], words.count * copies)
        return list(zip(self.langs.dictionary.to_pylist(), n.tolist(), strict=True))


def added(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their weights."""
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(weights, first) if len(first) else weights


def _cells(grams: Grams, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    one = [added(h >> U64(64 - bits), w) for h, _, w in grams.of(n)]
    return added(np.concatenate([k for k, _ in one] or [np.zeros(0, U64)]), np.concatenate([w for _, w in one] or [np.zeros(0, np.int64)]))


def counted(rows: list[tuple]) -> pa.Table:
    """Rows of COUNTS."""
    kinds = {"lang": pa.string(), "words": pa.int32(), "phrase": pa.string(), "f": pa.int64()}
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)], list(kinds))


def _cut(keys: np.ndarray, parts: int, bits: int) -> list[int]:
    return [*np.searchsorted(keys, np.array(_edges(parts, bits)[:-1], U64)).tolist(), len(keys)]


def counts(docs: DataFrame, least: int = 100, shard_bytes: int = 8 << 20, memory: str = "256MB", bits: int | None = None) -> DataFrame:
    """(lang, words, phrase, f): all phrases of 1 to 5 words with f >= least, and a language's number of words with words 0
    and a null phrase. bits: there are 2^bits cells; by default about as many as bytes of text."""
    tune(docs.sparkSession, 2048)
    units = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 1
    shards, parts, bits = max(1, -(-units // shard_bytes)), max(16, units // PART_BYTES), bits or max(16, units.bit_length() - 1)
    dealt = deal(pieces(docs), F.xxhash64("lang", "piece"), shards)

    def ask(blocks: pa.Table) -> pa.Table:
        grams, out = Grams(blocks), []
        for n in range(1, LONGEST + 1):
            keys, weights = _cells(grams, n, bits)
            cut, edges = _cut(keys, parts, bits), _edges(parts, bits)
            out += [((n - 1) * parts + k, shard_of(blocks), squeezed(np.frombuffer(pack_names(keys[a:b], edges[k]), np.uint8), weights[a:b])) for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if a < b]
        return mail(out)

    def answer(came: Iterator[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, bytes]]:
        now, held = -1, []

        def flush() -> Iterator[tuple[int, int, bytes]]:
            keys = [unpack_names(names.tobytes(), _edges(parts, bits)[now % parts]) for _, names, _ in held]
            every, total = added(np.concatenate(keys), np.concatenate([w.view(np.int64) for _, _, w in held]))
            often = every[total >= least]
            for (shard, _, _), own in zip(held, keys, strict=True):
                yield now, shard, squeezed(np.packbits(np.isin(own, often, assume_unique=True)))

        for part, shard, body in came:
            if part != now and held:
                yield from flush()
                held = []
            now = part
            held.append((shard, *opened(body)))
        if held:
            yield from flush()

    def tell(blocks: pa.Table, inbox: pa.Table) -> pa.Table:
        grams, bodies = Grams(blocks), dict(zip(inbox["part"].to_pylist(), inbox["body"].to_pylist(), strict=True))
        out = [(zlib.crc32(lang.encode()) % parts, lang, 0, None, total) for lang, total in grams.totals()]
        for n in range(1, LONGEST + 1):
            keys, _ = _cells(grams, n, bits)
            cut, often = _cut(keys, parts, bits), np.zeros(len(keys), bool)
            for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
                if a < b:
                    often[a:b] = np.unpackbits(opened(bodies[(n - 1) * parts + k])[0], count=b - a)
            found = []
            for i, (h, first, w) in enumerate(grams.of(n)):
                hit = np.flatnonzero(often[np.searchsorted(keys, h >> U64(64 - bits))])
                found.append((h[hit], np.full(len(hit), i), first[hit], w[hit]))
            h, run, first, w = map(np.concatenate, zip(*found, strict=True))
            order = np.argsort(h, kind="stable")
            head = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]])) if len(h) else np.zeros(0, np.int64)
            sums = np.add.reduceat(w[order], head) if len(head) else w
            names = grams.langs.dictionary.to_pylist()
            to = (h[order[head]] % U64(parts)).tolist()
            for k_, i, f in zip(to, order[head].tolist(), sums.tolist(), strict=True):
                a, own, words, _, _ = grams.runs[run[i]]
                k = first[i]
                out.append((k_, names[grams.lang[a + words.text[k]]], n, own[words.start[k] : words.end[k + n - 1]].tobytes().decode(), f))
        out.sort(key=lambda row: row[0])
        return mail([(part, shard_of(blocks), packed(counted([row[1:] for row in own]))) for part, own in itertools.groupby(out, lambda row: row[0])])

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        with tempfile.TemporaryDirectory() as scratch, duckdb.connect(f"{scratch}/counts.db", config={"threads": 1, "memory_limit": memory, "temp_directory": scratch}) as db:
            db.execute("CREATE TABLE t (lang VARCHAR, words INTEGER, phrase VARCHAR, f BIGINT)")
            for batch in batches:
                for block in batch.column(2):
                    own = unpacked(block.as_buffer())  # noqa: F841  duckdb reads it by its name
                    db.execute("INSERT INTO t SELECT * FROM own")
            found = db.execute(f"SELECT lang, words, phrase, CAST(sum(f) AS BIGINT) AS f FROM t GROUP BY ALL HAVING sum(f) >= {int(least)} OR words = 0")
            while rows := found.fetchmany(10_000):
                yield from counted(rows).to_batches()

    requests = dealt.groupBy("shard").applyInArrow(ask, MAIL)
    told = dealt.groupBy("shard").cogroup(answered(requests, LONGEST * parts, answer).groupBy("shard")).applyInArrow(tell, MAIL)
    return told.repartition(parts, "part").mapInArrow(bucket, COUNTS)


def score(a: str, n: str, parts: str) -> str:
    """floor(1000 * a * n / parts) of whole numbers, whose products may pass 64 bits."""
    return f"(CAST(1000 AS DECIMAL(4, 0)) * (CAST({a} AS DECIMAL(19, 0)) * CAST({n} AS DECIMAL(19, 0)))) div ({parts})"


def phrases(found: DataFrame, first: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases by their weakest cut, of what counts() gives."""
    totals = found.filter("words = 0").select("lang", F.col("f").alias("n"))
    known = found.filter("words > 0").select("lang", "phrase", "f")
    own = found.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    def joined(begin, length):
        return F.array_join(F.slice("w", begin, length), " ")

    cuts = own.select("lang", "phrase", "a", "words", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("left"), joined(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    for part, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(part), F.col("f").alias(name)), ["lang", part])
    cuts = cuts.join(F.broadcast(totals) if totals.count() <= FEW else totals, "lang")
    scored = cuts.withColumn("score", F.expr(score("a", "n", "CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0))")))
    weakest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("x")).select("lang", "phrase", "x.*")
    spans = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(i).alias("i")) for m in range(2, LONGEST) for i in range(1, LONGEST - m + 2)])
    inner = own.filter("words > 2").select("lang", "w", "words", "a", F.explode(spans).alias("s")).filter("s.m < words AND s.i + s.m - 1 <= words")
    inside = inner.groupBy("lang", joined(F.col("s.i"), F.col("s.m")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = weakest.join(inside, ["lang", "phrase"], "left").filter("longer IS NULL OR longer < a")
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return kept.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= first).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame, least: int = 100, first: int = 2000, shard_bytes: int = 8 << 20) -> DataFrame:
    """phrases() of counts() of some documents."""
    shared_dir(docs.sparkSession)
    return phrases(counts(docs, least, shard_bytes).checkpoint(), first)
