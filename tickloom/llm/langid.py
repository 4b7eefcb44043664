"""Language identification by a byte convolutional network.

Bytes are embedded; filters of width 2, 3 and 4 slide over windows of `WINDOW` bytes; the maximum of each filter over a
window feeds a softmax. The network is trained in numpy (Adam, fixed seed) on windows spread over a bounded sample of
labelled texts: of each language the same number of rows at most, `per_lang`, or less where languages are so many that this
would pass `max_rows` in all (but one at least), the first by a hash of doc_id, never a held-out one. No language is left out.
A prediction reads every byte of a text in windows and averages their probabilities.

Edge cases: a null text, or one without a letter, gets `und` and score 0; rows without labels are not learned from; with no
labelled row at all every text is `und`; rows with equal or null doc_id are judged one by one (null is not held out and not
learned from); extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._state import shared_dir
from ._text import buffer, tune

WINDOW, WIDTHS, EACH, DEPTH = 128, (2, 3, 4), 12, 8
UNKNOWN = "und"


@dataclass(frozen=True)
class Network:
    """Parameters; `dense` has a last row for the bias."""

    langs: tuple[str, ...]
    embed: np.ndarray
    conv: np.ndarray
    dense: np.ndarray


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id's text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def windows(text: bytes) -> np.ndarray:
    """All windows of a text: side by side, the last one moved back to end with it; a short text is padded with zeros."""
    n = len(text)
    if n <= WINDOW:
        return np.frombuffer(text.ljust(WINDOW, b"\0"), np.uint8)[None]
    raw = np.frombuffer(text, np.uint8)
    whole = raw[: n // WINDOW * WINDOW].reshape(-1, WINDOW)
    return whole if n % WINDOW == 0 else np.vstack([whole, raw[-WINDOW:]])


def _unfold(embed: np.ndarray, batch: np.ndarray) -> np.ndarray:
    e, span = embed[batch], WINDOW - max(WIDTHS) + 1
    return np.concatenate([e[:, k : k + span] for k in range(max(WIDTHS))], axis=2)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def probabilities(net: Network, batch: np.ndarray) -> np.ndarray:
    """Language probabilities of each window."""
    out = [np.zeros((0, len(net.langs)), np.float32)]
    for i in range(0, len(batch), 128):
        cols = _unfold(net.embed, batch[i : i + 128])
        pooled = np.maximum((cols.reshape(-1, cols.shape[2]) @ net.conv).reshape(*cols.shape[:2], -1).max(1), 0)
        out.append(_softmax(pooled @ net.dense[:-1] + net.dense[-1]))
    return np.concatenate(out)


def train(x: np.ndarray, y: np.ndarray, langs: tuple[str, ...], epochs: int = 6, seed: int = 5) -> Network:
    """Minimise cross-entropy with Adam; languages weigh the same whatever their number of windows."""
    rng = np.random.default_rng(seed)
    filters, reach = EACH * len(WIDTHS), max(WIDTHS)
    mask = np.zeros((reach * DEPTH, filters), np.float32)
    for k, w in enumerate(WIDTHS):
        mask[: w * DEPTH, k * EACH : (k + 1) * EACH] = 1
    p = [rng.normal(0, 0.3, (256, DEPTH)), rng.normal(0, 0.2, mask.shape) * mask, np.vstack([rng.normal(0, 0.2, (filters, len(langs))), np.zeros((1, len(langs)))])]
    p = [v.astype(np.float32) for v in p]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    weight = (len(y) / (len(langs) * np.maximum(np.bincount(y, minlength=len(langs)), 1))).astype(np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(order), 64):
            own = order[i : i + 64]
            xb, yb = x[own], y[own]
            n = len(own)
            cols = _unfold(p[0], xb)
            act = (cols.reshape(-1, cols.shape[2]) @ p[1]).reshape(n, cols.shape[1], filters)
            at = act.argmax(1)
            top = np.take_along_axis(act, at[:, None], 1)[:, 0]
            pooled = np.maximum(top, 0)
            d = _softmax(pooled @ p[2][:-1] + p[2][-1])
            d[np.arange(n), yb] -= 1
            d *= weight[yb][:, None] / n
            g2 = np.vstack([pooled.T @ d, d.sum(0)])
            dt = (d @ p[2][:-1].T) * (top > 0)
            seen = cols[np.arange(n)[:, None], at]
            g1 = np.einsum("nf,nfc->cf", dt, seen) * mask
            back = (dt[:, :, None] * p[1].T[None]).reshape(n, filters, reach, DEPTH)
            which = xb[np.arange(n)[:, None, None], at[:, :, None] + np.arange(reach)]
            g0 = np.zeros_like(p[0])
            np.add.at(g0, which.ravel(), back.reshape(-1, DEPTH))
            step += 1
            for k, g in enumerate((g0, g1, g2)):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - 0.004 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Network(langs, *(a.astype(np.float32) for a in p))


def fit(docs: DataFrame, per_lang: int = 800, max_rows: int = 20_000, per_doc: int = 4) -> Network | None:
    """Train on the bounded sample; None if no row has a label."""
    tune(docs.sparkSession)
    shared_dir(docs.sparkSession)
    usable = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
    counts = usable.groupBy("lang").agg(F.count("*").alias("_n")).checkpoint()
    langs = counts.count()
    each = max(1, min(per_lang, max_rows // max(1, langs)))
    order = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    # about twice as many rows as are wanted and 50 more come to the sort, so that it is small
    near = usable.join(F.broadcast(counts) if langs <= 100_000 else counts, "lang").filter(order * F.col("_n") <= F.lit((2 * each + 50) * float(1 << 40)))
    best = Window.partitionBy("lang").orderBy(order, "doc_id", "text")
    drawn = near.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= each)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for doc_id, text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                w = windows(text.encode())
                for k in np.unique(np.linspace(0, len(w) - 1, per_doc).astype(int)):
                    kept.append((doc_id, int(k), lang, w[k].tobytes()))
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept, strict=True), (pa.int64(), pa.int32(), pa.string(), pa.binary()), strict=True)], ["doc_id", "k", "lang", "window"])

    rows = drawn.select(F.col("doc_id").cast("long"), "text", "lang").mapInArrow(spread, "doc_id long, k int, lang string, window binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["doc_id"], r["k"], r["lang"], r["window"]))
    langs = tuple(sorted({r["lang"] for r in rows}))
    x = np.frombuffer(b"".join(bytes(r["window"]) for r in rows), np.uint8).reshape(-1, WINDOW)
    number = {lang: i for i, lang in enumerate(langs)}
    return train(x, np.array([number[r["lang"]] for r in rows]), langs)


def predict(docs: DataFrame, net: Network | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in `keep`, the predicted language and its probability, in one pass without a shuffle."""
    tune(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            raw, at = buffer(batch.column(len(keep)))
            view, langs, scores = raw.tobytes(), [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
            own = [i for i in range(batch.num_rows) if net is not None and at[i] < at[i + 1] and any(map(str.isalpha, view[at[i] : at[i + 1]].decode()))]
            first = 0
            while first < len(own):  # windows of some texts at a time, whatever their length
                held, size, last = [], 0, first
                while last < len(own) and (last == first or size < 8192):
                    held.append(windows(view[at[own[last]] : at[own[last] + 1]]))
                    size += len(held[-1])
                    last += 1
                p = probabilities(net, np.concatenate(held))
                begin = np.cumsum([0, *map(len, held)])
                mean = np.add.reduceat(p.astype(float), begin[:-1]) / np.diff(begin)[:, None]
                for i, row in zip(own[first:last], mean, strict=True):
                    langs[i], scores[i] = net.langs[int(row.argmax())], float(min(1.0, row.max()))
                first = last
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*keep, "lang_pred", "score"])

    own = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    return docs.select(*keep, "text").mapInArrow(run, f"{own}, lang_pred string, score double")
