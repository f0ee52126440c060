"""Language identification by a byte convolutional network trained in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstrata.llm.common import text_batches
from marketstrata.llm.sampling import fold, sampled_texts

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 8
PER_LANGUAGE = 1500
PIECES = 12
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")  # letters, and number signs such as a superscript two
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


@dataclass(frozen=True)
class LanguageModel:
    """``tables[j]``: weights of byte values at offset ``j``, of the filters at least ``j + 1`` wide."""

    languages: tuple[str, ...]
    tables: tuple[np.ndarray, ...] = ()
    bias: np.ndarray | None = None
    dense: np.ndarray | None = None
    dense_bias: np.ndarray | None = None


def has_letters(text: str) -> bool:
    return any(sign[0].isalpha() for sign in _LETTER.finditer(text))


def _first(offset: int) -> int:
    """Of the filters, ordered by width, the first that reaches this offset."""
    return FILTERS * sum(w <= offset for w in WIDTHS)


def cut_windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Fixed-length windows over whole texts, zero-padded at the end, and the text each belongs to.

    Neighbours share as many bytes as the widest filter needs; a short text is one window.
    """
    step, tail = WINDOW - max(WIDTHS) + 1, max(WIDTHS) - 1
    counts = np.array([max(1, -(-(len(t) - tail) // step)) for t in texts], dtype=np.int64)
    out = np.zeros((counts.sum(), WINDOW), np.uint8)
    at = 0
    for text, n in zip(texts, counts.tolist(), strict=True):
        data = np.zeros(n * step + tail, np.uint8)
        raw = np.frombuffer(text, np.uint8)[: len(data)]
        data[: len(raw)] = _FOLD[raw]
        out[at : at + n] = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[::step][:n]
        at += n
    return out, np.repeat(np.arange(len(texts)), counts)


def _convolve(model: LanguageModel, x: np.ndarray) -> np.ndarray:
    """Filter responses at every position; a one-hot byte times a filter is a row of its table."""
    span = x.shape[1] - max(WIDTHS) + 1
    out = model.tables[0][x[:, :span]]
    for j in range(1, max(WIDTHS)):
        out[:, :, _first(j) :] += model.tables[j][x[:, j : j + span]]
    return out


def window_logits(model: LanguageModel, x: np.ndarray) -> np.ndarray:
    pooled = np.maximum(_convolve(model, x).max(axis=1) + model.bias, 0)
    return pooled @ model.dense + model.dense_bias


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def fit_language(sample: pd.DataFrame, epochs: int = 8, batch: int = 128, rate: float = 0.01, seed: int = 3) -> LanguageModel:
    """Adam on the cross-entropy of windows; classes weigh equally whatever their number of windows."""
    sample = sample[sample.text.map(has_letters)]
    languages = tuple(sorted(sample.label.unique())) if len(sample) else ()
    if len(languages) < 2:
        return LanguageModel(languages)
    x, owner = cut_windows([t.encode() for t in sample.text])
    y = sample.label.map({name: k for k, name in enumerate(languages)}).to_numpy()[owner]
    weight = (len(y) / (len(languages) * np.maximum(np.bincount(y, minlength=len(languages)), 1)))[y].astype(np.float32)
    rng = np.random.default_rng(seed)
    total = FILTERS * len(WIDTHS)
    p = {f"t{j}": rng.normal(0, 0.3, (256, total - _first(j))).astype(np.float32) for j in range(max(WIDTHS))}
    p |= {"b": np.zeros(total, np.float32), "d": rng.normal(0, 0.2, (total, len(languages))).astype(np.float32)}
    p["c"] = np.zeros(len(languages), np.float32)
    first, second, step = ({k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0)
    model = lambda: LanguageModel(languages, tuple(p[f"t{j}"] for j in range(max(WIDTHS))), p["b"], p["d"], p["c"])
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            xb = x[pick]
            maps = _convolve(model(), xb)
            where = maps.argmax(axis=1)
            pooled = np.maximum(np.take_along_axis(maps, where[:, None], 1)[:, 0] + p["b"], 0)
            out = np.exp(_log_softmax(pooled @ p["d"] + p["c"]))
            out[np.arange(len(pick)), y[pick]] -= 1
            out *= (weight[pick] / len(pick))[:, None]
            back = (out @ p["d"].T) * (pooled > 0)
            grad = {"d": pooled.T @ out, "c": out.sum(axis=0), "b": back.sum(axis=0)}
            rows = np.arange(len(pick))[:, None]
            for j in range(max(WIDTHS)):
                k = _first(j)
                grad[f"t{j}"] = np.zeros_like(p[f"t{j}"])
                np.add.at(grad[f"t{j}"], (xb[rows, where[:, k:] + j], np.arange(total - k)[None, :]), back[:, k:])
            step += 1
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] = p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model()


def train_language(
    documents: DataFrame, text: str = "text", lang: str = "lang", id_column: str = "doc_id", held_out_fold: int = 1, folds: int = 3
) -> LanguageModel:
    """Fit on at most ``PER_LANGUAGE`` documents a language outside the held-out fold; NULL languages do not count.

    The bound is on rows; of a long text ``PIECES`` stretches, spread evenly over it, are used. Without any such
    document every prediction is ``und``.
    """
    known = documents.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & (fold(id_column, folds) != held_out_fold))
    sample = sampled_texts(
        documents.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text")),
        known.select(F.col(id_column).alias("id"), F.col(lang).cast("string").alias("label")),
        PER_LANGUAGE,
        PIECES,
        40,
    )
    return fit_language(sample)


def classify(model: LanguageModel, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and score of each whole text; no letter, or nothing learned: ``und`` and 0.

    The language has the greatest mean log-probability over the windows; the score is its mean probability.
    """
    found = [(UNKNOWN, 0.0)] * len(texts)
    at = [k for k, t in enumerate(texts) if t and has_letters(t)]
    if not model.languages or not at:
        return found
    if len(model.languages) == 1:
        for k in at:
            found[k] = (model.languages[0], 1.0)
        return found
    x, owner = cut_windows([texts[k].encode() for k in at])
    logs = np.concatenate([_log_softmax(window_logits(model, x[i : i + 64])) for i in range(0, len(x), 64)])
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    sizes = np.diff(np.append(starts, len(owner)))[:, None]
    best = (np.add.reduceat(logs, starts) / sizes).argmax(axis=1)
    mean = np.add.reduceat(np.exp(logs), starts) / sizes
    for k, b, row in zip(at, best.tolist(), mean, strict=True):
        found[k] = (model.languages[b], min(1.0, float(row[b])))
    return found


def identify_language(documents: DataFrame, model: LanguageModel, text: str = "text", id_column: str = "doc_id", folds: int = 3) -> DataFrame:
    """``id, held_out, lang_pred, score`` of every row, from its whole text alone, where it is read.

    ``held_out`` is false for a NULL id; ids and rows may repeat; other columns are not read, whatever their names. Of
    equally likely languages the first by name is taken. An empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            found = [x for a, b in text_batches(texts) for x in classify(model, texts[a:b])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=["id", "held_out", "lang_pred", "score"],
            )

    kind = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(
        F.col(id_column).alias("id"), F.coalesce(fold(id_column, folds) == 1, F.lit(False)).alias("held_out"), F.col(text).cast("string")
    )
    return rows.mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("id", id_column)
