"""Language identification: a byte convolutional network trained in numpy, applied to fixed-length windows.

A text is cut into windows of 128 bytes (A-Z folded, the last one padded). Bytes are
embedded, filters of widths 2, 3 and 4 slide over a window, the largest
response of each filter goes through a softmax layer. A text's probabilities are
the mean over all its windows, weighted by their bytes.

The network learns on the driver from at most ``PER_LANGUAGE`` excerpts of
``EXCERPT`` characters per language, chosen by a hash of the key, wherever they lie
in a text; prediction reads every byte of every text.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so
is every text if there is nothing to learn from. Ties go to the first language
in alphabetical order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from tidewell.llm.arrays import FOLD, flat, free_name, per_slice

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBED = 6
PER_LANGUAGE = 600
EXCERPT = 400
UNDETERMINED = "und"


@dataclass
class Network:
    """Learned weights; ``filters`` of narrow widths are zero beyond their width."""

    languages: list[str]
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    out: np.ndarray

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """(n, places, widest * EMBED) inputs of the filters."""
        embedded = self.embed[windows].reshape(len(windows), -1)
        places = windows.shape[1] - WIDTHS[-1] + 1
        shape = (len(windows), places, WIDTHS[-1] * EMBED)
        steps = (embedded.strides[0], EMBED * embedded.itemsize, embedded.itemsize)
        return np.ascontiguousarray(np.lib.stride_tricks.as_strided(embedded, shape, steps))

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        pooled = (self.columns(windows) @ self.filters).max(axis=1)
        return softmax(np.maximum(pooled + self.bias, 0) @ self.dense + self.out)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def cut_windows(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, text of each, bytes in each)."""
    lengths = np.diff(bounds)
    per_text = -(-lengths // WINDOW)
    text = np.repeat(np.arange(len(lengths)), per_text)
    number = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    start = bounds[text] + number * WINDOW
    filled = np.minimum(WINDOW, bounds[text + 1] - start)
    padded = np.concatenate([FOLD[data], np.zeros(WINDOW, np.uint8)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[start]
    short = np.flatnonzero(filled < WINDOW)
    windows[short] = np.where(np.arange(WINDOW) < filled[short, None], windows[short], 0)
    return windows, text, filled


def train(texts: list[str], labels: list[str], epochs: int = 8, batch: int = 64, rate: float = 4e-3) -> Network | None:
    """Fit by Adam on the cross entropy of single windows."""
    languages = sorted(set(labels))
    if not languages:
        return None
    windows, owner, filled = cut_windows(*flat(pa.array(texts, pa.large_string())))
    target = np.array([languages.index(x) for x in labels], np.int64)[owner]
    full = filled >= min(WINDOW // 2, filled.max(initial=0))
    windows, target = windows[full], target[full]
    rng = np.random.default_rng(7)
    n_filters, span = FILTERS * len(WIDTHS), WIDTHS[-1] * EMBED
    allowed = np.concatenate([np.repeat((np.arange(span) < w * EMBED)[:, None], FILTERS, 1) for w in WIDTHS], axis=1)

    def normal(*shape):
        return rng.normal(0, shape[0] ** -0.5, shape).astype(np.float32)

    net = Network(languages, normal(256, EMBED) * 8, normal(span, n_filters) * allowed,
                  np.zeros(n_filters, np.float32), normal(n_filters, len(languages)), np.zeros(len(languages), np.float32))
    names = ("embed", "filters", "bias", "dense", "out")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for lo in range(0, len(order), batch):
            rows = order[lo : lo + batch]
            x, y, n = windows[rows], target[rows], len(rows)
            columns = net.columns(x)
            response = columns @ net.filters
            place = response.argmax(axis=1)
            pooled = np.take_along_axis(response, place[:, None, :], axis=1)[:, 0] + net.bias
            hidden = np.maximum(pooled, 0)
            loss = softmax(hidden @ net.dense + net.out)
            loss[np.arange(n), y] -= 1
            loss /= n
            back = (loss @ net.dense.T) * (pooled > 0)
            seen = columns[np.arange(n)[:, None], place]
            grads = {
                "dense": hidden.T @ loss, "out": loss.sum(axis=0), "bias": back.sum(axis=0),
                "filters": np.einsum("nf,nfs->sf", back, seen, optimize=True) * allowed,
                "embed": np.zeros_like(net.embed),
            }
            into = (back[:, :, None] * net.filters.T[None]).reshape(n, n_filters, WIDTHS[-1], EMBED)
            at = x[np.arange(n)[:, None, None], place[:, :, None] + np.arange(WIDTHS[-1])]
            np.add.at(grads["embed"], at, into)
            step += 1
            for k in names:
                g = grads[k].astype(np.float32)
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                move = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                setattr(net, k, getattr(net, k) - np.float32(rate) * move)
    return net


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", learn: Column | None = None,
        per_language: int = PER_LANGUAGE) -> Network | None:
    """Train on a bounded sample of the labelled rows of ``docs`` that ``learn`` allows."""
    rows = docs.where(learn) if learn is not None else docs
    order = F.xxhash64(F.col(key).cast("string"))
    length = F.char_length(F.col(text))
    start = F.pmod(order, F.greatest(length - EXCERPT, F.lit(1))).cast("int") + 1
    rows = rows.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(lang).alias("lang"), order.alias("place"), F.substring(F.col(text), start, F.lit(EXCERPT)).alias("text")
    )
    ranked = rows.withColumn("nth", F.row_number().over(W.partitionBy("lang").orderBy("place", "text")))
    sample = ranked.where(F.col("nth") <= per_language).orderBy("lang", "nth").select("text", "lang").collect()
    return train([r["text"] for r in sample], [r["lang"] for r in sample])


def predict(docs: DataFrame, network: Network | None, keep: list[str], text: str = "text",
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Columns ``keep`` of every row, and the language and its probability."""
    letters = free_name(docs, "has_letter")
    source = docs.select(*dict.fromkeys([*keep, text]))
    kept = source.select(*keep).schema.fields
    source = source.withColumn(letters, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))

    def make():
        def work(batch, texts):
            n = len(texts)
            found, score = np.array([UNDETERMINED] * n, object), np.zeros(n)
            if network is not None:
                windows, owner, filled = cut_windows(*flat(texts))
                total = np.zeros((n, len(network.languages)))
                for lo in range(0, len(windows), 64):
                    part = slice(lo, lo + 64)
                    chance = network.probabilities(windows[part]) * filled[part, None]
                    edge = np.flatnonzero(np.diff(owner[part], prepend=-1))
                    total[owner[part][edge]] += np.add.reduceat(chance, edge, axis=0)
                has = np.asarray(batch.column(letters)) & (total.sum(axis=1) > 0)
                best = total.argmax(axis=1)
                found[has] = np.array(network.languages, object)[best[has]]
                score[has] = total[has, best[has]] / total[has].sum(axis=1)
            columns = [batch.column(f.name) for f in kept]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, pa.string()), pa.array(np.clip(score, 0, 1))], [*keep, *names]
            )

        return work

    schema = T.StructType([*kept, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return source.mapInArrow(per_slice(make, text), schema)


def learn_fold(key: str = "doc_id") -> Column:
    """True for rows to learn from: crc32 of the key as text, modulo 3, is not 1."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 3 != 1


def keep_identified(docs: DataFrame, network: Network | None, text: str = "text", lang: str = "lang",
                    least: float = 0.3) -> DataFrame:
    """``docs`` without the rows whose language is undetermined or less likely than ``least``; fills null languages."""
    pred = free_name(docs, "lang_pred")
    score = free_name(docs, "score")
    found = predict(docs, network, docs.columns, text, (pred, score))
    found = found.where((F.col(pred) != UNDETERMINED) & (F.col(score) >= least))
    return found.withColumn(lang, F.coalesce(lang, pred)).select(*docs.columns)
