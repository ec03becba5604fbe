"""Language identification with a small convolutional network over bytes.

Bytes are embedded, filters of several widths run over fixed-length windows,
each filter keeps its maximum, and a softmax layer names the language.  The
network is written and trained in numpy, on at most ``train_windows`` windows of
each of at most ``train_docs`` labelled documents per language.  Both are picked
by keyed hashes, documents over the whole table and windows over the whole text;
these bounds are the only places where rows or windows are left out, and only for
fitting.  Every window of every text is then classified in batches; a document's
language has the greatest sum of its windows' log probabilities, and its score is
the mean of the windows' probabilities of that language.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
rows with a null label are not learnt from; with no labelled row every text is
``und``; rows that share an id are classified each by its own text; an empty
table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidalrec.llm.common import load, mix64


@dataclass(frozen=True)
class ByteCnn:
    window: int = 256
    embed: int = 8
    filters: int = 16
    widths: tuple[int, ...] = (2, 3, 4)
    train_docs: int = 400        # per language
    train_windows: int = 4       # per document
    steps: int = 500
    batch: int = 64
    rate: float = 0.01
    seed: int = 10


UNKNOWN = "und"
Weights = dict[str, np.ndarray]


def windows_of(text: bytes, size: int) -> np.ndarray:
    """(n, size) bytes: consecutive windows over the whole text, the last one padded with 0.

    A window is cut at any byte; text under one window long makes one window.
    """
    n = max(1, -(-len(text) // size))
    out = np.zeros(n * size, np.uint8)
    out[:len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, size)


def picked_windows(text: bytes, p: ByteCnn) -> np.ndarray:
    """At most ``train_windows`` windows of a text, those of the least hashes of text, seed and place.

    A short end is left out where there are whole windows.
    """
    n = max(1, len(text) // p.window)
    key = np.uint64(xxhash.xxh3_64_intdigest(text, p.seed))
    at = np.sort(np.argsort(mix64(np.arange(n, dtype=np.uint64) + key), kind="stable")[:p.train_windows])
    return np.concatenate([windows_of(text[i * p.window:(i + 1) * p.window], p.window) for i in at])


def init(p: ByteCnn, n_classes: int) -> Weights:
    rng = np.random.default_rng(p.seed)
    w: Weights = {"E": rng.normal(0, 0.5, (256, p.embed)).astype(np.float32)}
    w["E"][0] = 0
    for k in p.widths:
        w[f"K{k}"] = rng.normal(0, (k * p.embed) ** -0.5, (k * p.embed, p.filters)).astype(np.float32)
        w[f"b{k}"] = np.zeros(p.filters, np.float32)
    w["W"] = rng.normal(0, 0.1, (len(p.widths) * p.filters, n_classes)).astype(np.float32)
    w["c"] = np.zeros(n_classes, np.float32)
    return w


def _grams(e: np.ndarray, k: int) -> np.ndarray:
    """(n, positions, k * embed) view of every run of k embedded bytes."""
    n, size, d = e.shape
    return np.lib.stride_tricks.as_strided(
        e, (n, size - k + 1, k * d), (e.strides[0], e.strides[1], e.strides[2]), writeable=False)


def forward(w: Weights, p: ByteCnn, x: np.ndarray) -> tuple[np.ndarray, list]:
    """Log probabilities of windows and what backward needs."""
    e = np.ascontiguousarray(w["E"][x])
    pooled, kept = [], []
    for k in p.widths:
        g = _grams(e, k)
        a = g.reshape(-1, g.shape[2]) @ w[f"K{k}"]
        a = a.reshape(len(x), -1, p.filters)
        top = a.argmax(axis=1)
        best = np.take_along_axis(a, top[:, None, :], 1)[:, 0, :] + w[f"b{k}"]
        pooled.append(np.maximum(best, 0))
        kept.append((k, top, best > 0))
    h = np.concatenate(pooled, axis=1)
    z = h @ w["W"] + w["c"]
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True)), [e, h, kept]


def backward(w: Weights, p: ByteCnn, x: np.ndarray, y: np.ndarray, logp: np.ndarray, state: list) -> Weights:
    """Gradients of the mean cross-entropy."""
    e, h, kept = state
    dz = np.exp(logp)
    dz[np.arange(len(y)), y] -= 1
    dz /= len(y)
    g: Weights = {"W": h.T @ dz, "c": dz.sum(axis=0), "E": np.zeros_like(w["E"])}
    dh = dz @ w["W"].T
    rows = np.arange(len(x))[:, None, None]
    for j, (k, top, alive) in enumerate(kept):
        d = dh[:, j * p.filters:(j + 1) * p.filters] * alive
        at = top[:, :, None] + np.arange(k)                      # (n, filters, k) positions of the winners
        won = e[rows, at].reshape(len(x), p.filters, k * p.embed)
        g[f"K{k}"] = np.einsum("nfd,nf->df", won, d)
        g[f"b{k}"] = d.sum(axis=0)
        de = (d[:, :, None] * w[f"K{k}"].T[None]).reshape(-1, p.embed)
        np.add.at(g["E"], x[rows, at].reshape(-1), de)
    g["E"][0] = 0
    return g


def train(x: np.ndarray, y: np.ndarray, n_classes: int, p: ByteCnn) -> Weights:
    """Adam on mini-batches that hold every class equally often."""
    w = init(p, n_classes)
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v = {k: np.zeros_like(a) for k, a in w.items()}
    rng = np.random.default_rng(p.seed)
    of = [np.flatnonzero(y == c) for c in range(n_classes)]
    for t in range(1, p.steps + 1):
        pick = np.array([rng.choice(of[c]) for c in rng.integers(0, n_classes, p.batch)])
        logp, state = forward(w, p, x[pick])
        rate = p.rate * min(1.0, 2 * (1 - t / (p.steps + 1)))
        for k, g in backward(w, p, x[pick], y[pick], logp, state).items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            w[k] = (w[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-8)).astype(np.float32)
    return w


def fit(rows: DataFrame, p: ByteCnn) -> tuple[Weights | None, list[str]]:
    """Network and its languages from (text, lang) rows; at most ``train_docs`` texts per language are read.

    Equal texts of a language count once.  A first pass counts its different
    texts, a second keeps those whose hash falls below a threshold that lets
    about twice ``train_docs`` through; the picked windows of these are what
    reaches the driver.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [picked_windows(t.encode(), p).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kept, pa.binary())],
                                             names=["lang", "h", "windows"])

    keyed = rows.where("lang is not null and text is not null").select(
        "lang", "text", F.xxhash64("text", F.lit(p.seed)).alias("h"))
    counts = keyed.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    share = F.shiftrightunsigned("h", 1) / F.lit(2.0**63)
    few = keyed.join(F.broadcast(counts), "lang").where(share * F.col("n") < 2 * p.train_docs)
    some = few.select("lang", "h", "text").mapInArrow(cut, "lang string, h long, windows binary").groupBy("lang", "h").agg(
        F.min("windows").alias("windows")).toPandas()
    some = some.sort_values(["lang", "h"]).groupby("lang").head(p.train_docs)
    langs = sorted(some["lang"].unique())
    if not langs:
        return None, []
    x, y = [], []
    for lang, kept in zip(some["lang"], some["windows"]):
        x.append(np.frombuffer(kept, np.uint8).reshape(-1, p.window))
        y += [langs.index(lang)] * len(x[-1])
    return train(np.concatenate(x), np.array(y), len(langs), p), langs


def classify(docs: DataFrame, weights: Weights | None, langs: list[str], p: ByteCnn) -> DataFrame:
    """(doc_id, lang_pred, score) of rows (doc_id, text); score is the mean probability over the windows."""
    model = docs.sparkSession.sparkContext.broadcast(weights)  # a few 10 KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for batch in batches:
            pred = [UNKNOWN] * batch.num_rows
            score = [0.0] * batch.num_rows
            sums, shares = np.zeros((2, batch.num_rows, max(1, len(langs))))
            n_windows = np.zeros(batch.num_rows)
            todo, owner, count = [], [], 0

            def flush() -> None:
                nonlocal todo, owner, count
                if todo:
                    logp, at = forward(w, p, np.concatenate(todo))[0], np.concatenate(owner)
                    np.add.at(sums, at, logp)
                    np.add.at(shares, at, np.exp(logp))
                    np.add.at(n_windows, at, 1)
                todo, owner, count = [], [], 0

            usable = np.zeros(batch.num_rows, bool)
            for i, text in enumerate(batch.column(1).to_pylist()):
                if w is None or text is None or not any(map(str.isalpha, text)):
                    continue
                usable[i] = True
                win = windows_of(text.encode(), p.window)
                if len(win) > 1 and 2 * (len(text.encode()) % p.window or p.window) < p.window:
                    win = win[:-1] if len(win) > 1 else win  # placed below: the short end shares the window before
                    tail = np.frombuffer(text.encode()[-p.window:], np.uint8)[None]
                    win = np.concatenate([win, tail])
                for j in range(0, len(win), 256):
                    todo.append(win[j:j + 256])
                    owner.append(np.full(len(todo[-1]), i))
                    count += len(todo[-1])
                    if count >= 256:
                        flush()
            flush()
            for i in np.flatnonzero(usable):
                best = int(sums[i].argmax())
                pred[i], score[i] = langs[best], min(1.0, float(shares[i, best] / n_windows[i]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.mapInArrow(run, "doc_id long, lang_pred string, score double")


def op10_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those outside the held-out third."""
    p = ByteCnn()
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    weights, langs = fit(docs.where(~held_out).select("text", "lang"), p)
    out = classify(docs.select("doc_id", "text"), weights, langs, p)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
