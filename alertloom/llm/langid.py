"""Language identification with a byte convolutional network.

Texts are cut into fixed-length windows of bytes (ASCII upper case folded). Filters of several
widths run over one-hot bytes, so a filter is a table of weights by byte and place; the maximum
over places of each filter goes through a rectifier into a softmax layer. The network is
trained in numpy on the driver, on a bounded sample of labelled windows, and applied in batches:
pairs of bytes index precomputed sums, and the probabilities of all windows of a text are averaged.

Nulls: a null or letterless text is ``und`` with score 0. A null doc_id or lang is never
learned from, and a null doc_id is not held out. Repeated rows get equal predictions. With
nothing to learn from, all texts are ``und``. Memory depends on the longest text only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom.llm.common import LOWER, label_sample, text_chunks, without

WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 8
#: Labelled documents per language in the training sample, and windows taken from each.
SAMPLE_PER_LANGUAGE = 800
WINDOWS_PER_TEXT = 3
EPOCHS = 8
UNDETERMINED = "und"
#: Least score of an accepted document: with four languages, less is close to no choice at all.
LEAST_SCORE = 0.3
ADDED = ("held_out", "lang_pred", "score")


def held_out(doc_id: str = "doc_id"):
    """Rows never learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


@dataclass
class ByteConvNet:
    languages: list[str]
    filters: dict[int, np.ndarray]  # by width: width x 256 x filters
    offsets: dict[int, np.ndarray]
    dense: np.ndarray
    bias: np.ndarray

    def pair_tables(self) -> dict[int, list[np.ndarray]]:
        """For each width sums over pairs of bytes, indexed by first + 256 * second, and a last single byte."""
        tables = {}
        for w, t in self.filters.items():
            parts = [(t[j][None, :, :] + t[j + 1][:, None, :]).reshape(65536, -1) for j in range(0, w - 1, 2)]
            tables[w] = parts + ([t[w - 1]] if w % 2 else [])
        return tables

    def pooled(self, windows: np.ndarray, tables: dict[int, list[np.ndarray]]) -> np.ndarray:
        x = windows.astype(np.intp)
        pairs = x[:, :-1] + 256 * x[:, 1:]
        out = []
        for w, parts in tables.items():
            n = windows.shape[1] - w + 1
            total = None
            for k, table in enumerate(parts):
                index = (x if len(table) == 256 else pairs)[:, 2 * k : 2 * k + n]
                total = table[index] if total is None else total + table[index]
            out.append(np.maximum(total.max(axis=1) + self.offsets[w], 0))
        return np.concatenate(out, axis=1)

    def probabilities(self, windows: np.ndarray, tables: dict[int, list[np.ndarray]], batch: int = 256) -> np.ndarray:
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for i in range(0, len(windows), batch):
            out[i : i + batch] = _softmax(self.pooled(windows[i : i + batch], tables) @ self.dense + self.bias)
        return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts, zero behind a text's end, and the number of windows of each text.

    Windows overlap by the widest filter less one, so that no place is missed.
    """
    lengths = np.diff(offsets)
    counts = np.maximum(1, -(-lengths // window))
    text = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[text] + nth * window
    index = start[:, None] + np.arange(window + max(WIDTHS) - 1)
    inside = index < offsets[text + 1][:, None]
    folded = np.append(LOWER[data], np.uint8(0))
    return np.where(inside, folded[np.where(inside, index, len(data))], 0).astype(np.uint8), counts


def train(
    texts: Sequence[bytes], labels: Sequence[str], epochs: int = EPOCHS, filters: int = FILTERS, seed: int = 7
) -> ByteConvNet | None:
    """Fits the network to windows and their languages by Adam; None if there is nothing to learn."""
    languages = sorted(set(labels))
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    data = np.frombuffer(b"".join(texts), np.uint8)
    x, counts = windows_of(data, np.cumsum([0, *map(len, texts)]))
    y = np.repeat(np.array([languages.index(v) for v in labels]), counts)
    net = ByteConvNet(
        languages,
        {w: rng.normal(0, 0.3, (w, 256, filters)).astype(np.float32) for w in WIDTHS},
        {w: np.zeros(filters, np.float32) for w in WIDTHS},
        rng.normal(0, 0.3, (filters * len(WIDTHS), len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    weights = [*net.filters.values(), *net.offsets.values(), net.dense, net.bias]
    first, second, step = [np.zeros_like(v) for v in weights], [np.zeros_like(v) for v in weights], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(order), 128):
            rows = order[i : i + 128]
            bx, by = x[rows].astype(np.intp), y[rows]
            pooled, best = [], {}
            for w in WIDTHS:
                n = bx.shape[1] - w + 1
                conv = sum(net.filters[w][j][bx[:, j : j + n]] for j in range(w))
                best[w] = conv.argmax(axis=1)
                pooled.append(np.take_along_axis(conv, best[w][:, None, :], 1)[:, 0, :] + net.offsets[w])
            raw = np.concatenate(pooled, axis=1)
            active = np.maximum(raw, 0)
            back = _softmax(active @ net.dense + net.bias)
            back[np.arange(len(by)), by] -= 1
            back /= len(by)
            grads: list[np.ndarray] = []
            deep = (back @ net.dense.T) * (raw > 0)
            for k, w in enumerate(WIDTHS):
                g = np.zeros_like(net.filters[w])
                part = deep[:, k * filters : (k + 1) * filters]
                for j in range(w):
                    hit = np.take_along_axis(bx, best[w] + j, 1)
                    np.add.at(g[j], (hit, np.arange(filters)[None, :]), part)
                grads.append(g)
            grads += [deep[:, k * filters : (k + 1) * filters].sum(0) for k in range(len(WIDTHS))]
            grads += [active.T @ back, back.sum(0)]
            step += 1
            for v, g, m, s in zip(weights, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return net


def training_windows(
    docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, per_text: int = WINDOWS_PER_TEXT
) -> tuple[list[bytes], list[str]]:
    """Windows of a bounded sample: the ``per_language`` labelled rows of least hash, all of them not held out.

    Ranks are taken over ids alone; the sample is at most ``per_language`` rows per language, so it
    can be broadcast to pick the texts. Windows are taken at places drawn from the id's hash.
    """
    known = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out())
    picked = label_sample(known, "lang", per_language)
    chosen = known.select("doc_id", "lang", "text").join(F.broadcast(picked), ["doc_id", "lang"])
    span = F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1
    cuts = [
        F.substring("text", (F.pmod(F.xxhash64("doc_id", F.lit(k)), span) + 1).cast("int"), F.lit(WINDOW))
        for k in range(per_text)
    ]
    rows = chosen.filter("text rlike '\\\\p{L}'").select("lang", F.array(*cuts).alias("cuts")).collect()
    pairs = sorted({(c.encode()[:WINDOW], r.lang) for r in rows for c in r.cuts})
    return [t for t, _ in pairs], [v for _, v in pairs]


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    ascii_letter = (LOWER[data] >= 97) & (LOWER[data] <= 122)
    upto = np.append(0, np.cumsum(ascii_letter))
    found = upto[offsets[1:]] > upto[offsets[:-1]]
    for i in np.flatnonzero(~found):
        text = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
        found[i] = any(map(str.isalpha, text))
    return found


def predictor(net: ByteConvNet | None, keep: Sequence[str]):
    """Function for ``mapInArrow``: columns ``keep`` with ``lang_pred`` and ``score``."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.pair_tables() if net else None
        for batch, data, offsets in text_chunks(batches):
            n = batch.num_rows
            lang, score = np.full(n, UNDETERMINED, object), np.zeros(n)
            if net:
                x, counts = windows_of(data, offsets)
                p = np.add.reduceat(net.probabilities(x, tables), np.cumsum(counts) - counts, axis=0)
                p /= counts[:, None]
                letters = _has_letter(data, offsets)
                best = p.argmax(axis=1)
                lang = np.where(letters, np.array(net.languages, object)[best], UNDETERMINED)
                score = np.where(letters, np.clip(p[np.arange(n), best], 0, 1), 0.0)
            columns = [batch.column(c) for c in keep] + [pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "lang_pred", "score"])

    return predict


def identify(docs: DataFrame, net: ByteConvNet | None, keep: Sequence[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``lang_pred`` and ``score``. One pass, no shuffle."""
    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(predictor(net, list(keep)), f"{schema}, lang_pred string, score double")


def with_language(docs: DataFrame, train_on: DataFrame | None = None) -> DataFrame:
    """All columns of ``docs`` with ``held_out, lang_pred, score``; learns from ``train_on`` (``docs`` itself)."""
    net = train(*training_windows(docs if train_on is None else train_on))
    rows = without(docs, ADDED)
    found = identify(rows, net, rows.columns)
    return found.withColumn("held_out", held_out()).select(*[f"`{c}`" for c in rows.columns], *ADDED)


def accepted(docs: DataFrame, languages: Sequence[str] | None = None, least_score: float = LEAST_SCORE) -> DataFrame:
    """Rows of ``docs`` in one of ``languages`` (all learned ones by default), told with ``least_score`` or more.

    Learns from ``docs``. If no network can be fitted, as no row has a usable label, a letter in the text is enough.
    """
    net = train(*training_windows(docs))
    if net is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    # other names on the way, as columns of docs may be called like results
    names = {c: c if c == "text" else f"_{i}" for i, c in enumerate(docs.columns)}
    found = identify(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), net, list(names.values()))
    fine = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score)
    if languages is not None:
        fine &= F.col("lang_pred").isin(*languages)
    return found.filter(fine).select(*[F.col(n).alias(c) for c, n in names.items()])


def op10_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    net = train(*training_windows(docs))
    found = identify(docs.select("doc_id", "text"), net, ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
