"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the whole corpus.

Word unigrams and bigrams are hashed into `buckets` cells. The raw multinomial counts every document; the target one
counts every labelled, trusted document (quality 1, not toxic). A text's
score is the sum of its log ratios divided by (its n-grams + `prior`), so short texts stay near 0. `strength` counts are
added to the target's and the expected count of each cell, so rare cells say little. Half of the target gives the ratios,
the other half, which the ratios have not seen, the threshold: the `lost` quantile of its scores. A document is kept if it
passes the base rules and scores no less.

Edge cases: a null or empty text has no words and fails the base rule of 20 words; rows with equal or null doc_id are
judged one by one; no labels at all gives ratios of 0, and then only the base rules decide; extra columns pass through.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._state import shared_dir
from ._text import SPACE, U64, Words, buffer, mix, pieces, tune

SLICE = 4096
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True  # fixed values of the contract
FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double"


@dataclass(frozen=True)
class Model:
    """Log ratio of each cell, and the score from which a text is kept."""

    ratio: np.ndarray
    prior: float
    threshold: float


def _cells(words: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Cell and text of every n-gram: even cells hold unigrams, odd ones bigrams."""
    pair, at = words.grams(2)
    half = U64(buckets // 2)
    cell = np.concatenate([(words.hash % half) * U64(2), (pair % half) * U64(2) + U64(1)]).astype(np.int64)
    return cell, np.concatenate([words.text, words.text[at]])


def count_cells(docs: DataFrame, buckets: int) -> np.ndarray:
    """Counts of all cells over all documents. A task adds up its own texts and sends `buckets` counts in slices."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            raw, at = buffer(batch.column(0))
            for i, j in pieces(at):
                words = Words(raw[at[i] : at[j]], at[i : j + 1] - at[i])
                total += np.bincount(_cells(words, buckets)[0], minlength=buckets)
        if total.any():
            parts = total.reshape(-1, SLICE)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["slice", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[k] = total.get(k, 0) + np.frombuffer(counts, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["slice", "counts"])

    fields = "slice int, counts binary"
    sums = docs.select("text").mapInArrow(partial, fields).repartition(buckets // SLICE, "slice").mapInArrow(merge, fields)
    out = np.zeros((buckets // SLICE, SLICE), np.int64)
    for row in sums.collect():  # buckets / SLICE rows, whatever the corpus
        out[row["slice"]] = np.frombuffer(row["counts"], np.int64)
    return out.ravel()


def _trusted(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose doc_id is labelled and trusted. Labels grow with the corpus, so the join is the same at every size: rows
    and labels are dealt by doc_id, and no labels are broadcast."""
    good = labels.filter((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col("doc_id").isNotNull()).select("doc_id")
    return rows.join(good.hint("shuffle_hash"), "doc_id", "left_semi")


def half() -> Column:
    """Which half of the target a document is in, if it is trusted."""
    return F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(2)).alias("half")


def target(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts of all labelled, trusted documents, and which half of the target each is in."""
    return _trusted(docs.select("doc_id", "text", half()), labels)


def held_scores(docs: DataFrame, labels: DataFrame, model: Model) -> DataFrame:
    """Scores of the other half of the target. Texts are judged where they are read, and only scores meet the labels."""
    return _trusted(judge(docs.filter(half() == 1), model).filter(~F.col("base_failed")).select("doc_id", "score"), labels).select("score")


def quantile(rows: DataFrame, share: float) -> float | None:
    """The exact quantile of the one column of rows, between its two neighbours in proportion. Rows are written once, as they
    are counted before the lowest are taken; two of them come to the driver."""
    path, (name,) = f"{shared_dir(rows.sparkSession)}/scores-{uuid.uuid4().hex}", rows.columns
    rows.write.parquet(path)
    held = rows.sparkSession.read.schema(rows.schema).parquet(path).filter(F.col(name).isNotNull())
    at = (held.count() - 1) * share
    if at < 0:
        return None
    low = int(at)
    near = [r[0] for r in held.orderBy(name).limit(low + 2).orderBy(F.desc(name)).limit(2).collect()][::-1]
    return float(near[0] + (near[-1] - near[0]) * (at - low)) if at > low else float(held.orderBy(name).limit(low + 1).agg(F.max(name)).first()[0])


def fit(docs: DataFrame, labels: DataFrame, buckets: int = 1 << 17, strength: float = 5.0, prior: float = 60.0, lost: float = 0.0005) -> Model:
    """Counts of the whole corpus and of half the target, their log ratios, and the threshold from the other half."""
    tune(docs.sparkSession)
    raw = count_cells(docs, buckets).astype(float)
    goal = count_cells(target(docs, labels).filter("half = 0"), buckets).astype(float)
    if not goal.any():
        return Model(np.zeros(buckets, np.float32), prior, -np.inf)
    expected = goal.sum() * raw / raw.sum()
    model = Model(np.log((goal + strength) / (expected + strength)).astype(np.float32), prior, -np.inf)
    cut = quantile(held_scores(docs, labels, model), lost)
    return Model(model.ratio, prior, -np.inf if cut is None else cut)


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def features(texts: pa.Array, model: Model) -> dict[str, np.ndarray]:
    """Base counts, score and verdict of each text."""
    raw_all, at_all = buffer(texts)
    out: dict[str, list[np.ndarray]] = {k.split()[0]: [] for k in FIELDS.split(", ")}
    for i, j in pieces(at_all):
        raw, at, n = raw_all[at_all[i] : at_all[j]], at_all[i : j + 1] - at_all[i], j - i
        words = Words(raw, at)
        inside = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(~SPACE[raw] & ((raw & 0xC0) != 0x80), out=inside[1:])
        marks = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(SYMBOL[raw], out=marks[1:])
        again = np.zeros(len(words.hash) + 1, np.int64)
        eight, first = words.grams(8)
        if len(eight):
            key = mix(eight ^ (words.text[first].astype(U64) * U64(0x9E3779B97F4A7C15)))
            order = np.argsort(key, kind="stable")
            same = key[order][1:] == key[order][:-1]
            hit = np.zeros(len(key), bool)
            hit[order[1:][same]] = True
            hit[order[:-1][same]] = True
            np.add.at(again, first[hit], 1)
            np.add.at(again, first[hit] + 8, -1)
        covered = np.concatenate([[0], np.cumsum(np.cumsum(again[:-1]) > 0)])
        cell, text = _cells(words, len(model.ratio))
        total = np.bincount(text, model.ratio[cell], minlength=n)
        score = total / (np.bincount(text, minlength=n) + model.prior)
        n_words, repeats = words.count, np.diff(covered[words.first])
        failed = (n_words < 20) | (100 * repeats > 30 * n_words)
        view = raw.tobytes()
        lines = np.array([_dup_lines(view[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], np.int64)
        for k, v in (("n_words", n_words), ("word_chars", np.diff(inside[at])), ("n_symbols", np.diff(marks[at])), ("n_dup_lines", lines), ("n_repeat_words", repeats), ("base_failed", failed), ("kept", ~failed & (score >= model.threshold)), ("score", score)):
            out[k].append(v)
    return {k: np.concatenate(v) if v else np.zeros(0, bool if k in ("base_failed", "kept") else float if k == "score" else np.int64) for k, v in out.items()}


def judge(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in `keep`, then counts, verdict and score of each document, in one pass without a shuffle."""
    tune(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = features(batch.column(len(keep)), shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *map(pa.array, found.values())], [*keep, *found])

    own = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    return docs.select(*keep, "text").mapInArrow(run, f"{own}, {FIELDS}")


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that pass, with all their columns."""
    tune(docs.sparkSession)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(features(batch.column(at), shared.value)["kept"]))

    return docs.mapInArrow(run, docs.schema)
