"""Toxicity by compression distance: two zstandard dictionaries and calibrated window gains."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstrata.llm.sampling import fold, sampled_texts

WINDOW_WORDS = 12
PER_CLASS = 4000
PIECES = 200
ORDINARY_BYTES = 9000
_STEMS = (4, 5, 6, 7, 8, 9)


@dataclass(frozen=True)
class ToxicityModel:
    """Content of the two dictionaries, and the calibration of the gains (``weights`` empty: nothing learned)."""

    ordinary: bytes
    toxic: bytes
    centre: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()


def windows(text: str, width: int = WINDOW_WORDS) -> list[bytes]:
    words = text.lower().split()
    return [f" {' '.join(words[i : i + width])} ".encode() for i in range(0, max(1, len(words)), width)]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters.from_level(
        3, strategy=zstandard.STRATEGY_BTOPT, min_match=3, write_content_size=0, write_checksum=0, write_dict_id=0
    )
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(compression_params=parameters, dict_data=held)


class Scorer:
    """Gains of the toxic over the ordinary dictionary, and the calibrated score."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.ordinary, self.toxic = _compressor(model.ordinary).compress, _compressor(model.toxic).compress

    def gains(self, text: str) -> list[float]:
        """Features of one whole text: greatest and mean gains in bytes a window, and counts of clear gains."""
        ordinary, toxic = self.ordinary, self.toxic
        g = np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(text)])
        top = -np.sort(-g)[:4]
        counts = [math.log1p(int((g >= k).sum())) for k in (1, 2, 3, 4, 6)]
        return [float(top[0]), float(top[:2].mean()), float(top.mean()), float(g.mean()), math.log(len(g)), *counts]

    def score(self, text: str) -> float:
        m = self.model
        if not m.weights:
            return 0.0
        x = (np.array(self.gains(text)) - m.centre) / m.scale
        return float(1 / (1 + math.exp(-max(-50.0, min(50.0, float(x @ np.array(m.weights[:-1])) + m.weights[-1])))))


def _stems(word: str) -> set[str]:
    return {word[:k] for k in _STEMS} | {word}


def toxic_content(toxic: list[str], ordinary: list[str], support: float = 0.02, odds: float = 40.0) -> bytes:
    """Dictionary content learned from toxic text: stems in many toxic and hardly any ordinary documents.

    Copies of a text count once. The odds are taken at a lower bound of the toxic count, which keeps out stems
    that are there by chance.
    """
    toxic, ordinary = list(set(toxic)), list(set(ordinary))
    count = [Counter(), Counter()]
    for side, texts in enumerate((ordinary, toxic)):
        for text in texts:
            count[side].update({p for w in set(text.lower().split()) for p in _stems(w)})
    least = max(4, support * len(toxic))
    kept = {
        p
        for p, n in count[1].items()
        if len(p) > 3
        and n >= least
        and ((n - 1.5 * math.sqrt(n)) / (len(toxic) + 1)) / ((count[0][p] + 0.5) / (len(ordinary) + 1)) > odds
    }
    short = {p for p in kept if not any(p[:k] in kept for k in range(4, len(p)))}
    whole = {max((w for w in count[1] if w.startswith(p)), key=lambda w: (count[1][w] * math.sqrt(len(w)), w)) for p in short}
    return f" {' '.join(sorted(short | whole))} ".encode()


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton steps."""
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack(((x - centre) / scale, np.ones(len(x))))
    w = np.zeros(z.shape[1])
    ridge = 0.05 * np.eye(len(w))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (p - y) + ridge @ w)
        w -= np.clip(step, -2, 2)
    return centre, scale, w


def fit_toxicity(sample: pd.DataFrame) -> ToxicityModel:
    """Train on ``text`` and ``label`` (1 toxic, 0 ordinary): dictionaries on one half, calibration on the other.

    The ordinary dictionary is trained by zstandard; the toxic one puts the learned stems before the same
    content, so that ordinary windows have equal lengths under both and only toxic stems make a gain.
    """
    toxic, ordinary = (list(sample.text[sample.label == k]) for k in (1, 0))
    if len(toxic) < 4 or len(ordinary) < 4:
        return ToxicityModel(b" ", b" ")
    content = toxic_content(toxic[0::2], ordinary[0::2])
    pieces = [w for t in ordinary[0::2] for w in windows(t)[:40]][:60_000]
    try:
        base = zstandard.train_dictionary(16_384, pieces).as_bytes()[-ORDINARY_BYTES:]
    except zstandard.ZstdError:
        base = b"".join(pieces)[-ORDINARY_BYTES:]  # too few samples to train on
    bare = Scorer(ToxicityModel(base, content + base))
    texts = toxic[1::2] + ordinary[1::2]
    y = np.array([1.0] * len(toxic[1::2]) + [0.0] * len(ordinary[1::2]))
    centre, scale, w = _calibrate(np.array([bare.gains(t) for t in texts]), y)
    return ToxicityModel(base, content + base, tuple(centre.tolist()), tuple(scale.tolist()), tuple(w.tolist()))


def train_toxicity(
    documents: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id", label: str = "toxic", held_out_fold: int = 0, folds: int = 5
) -> ToxicityModel:
    """Fit on at most ``PER_CLASS`` labelled documents a class outside the held-out fold.

    Labels other than 0 and 1, NULL ids and NULL texts are not learned from; of conflicting labels the
    greatest counts. Without enough of both classes every score is 0.
    """
    known = labels.filter(F.col(label).isin(0, 1) & (fold(id_column, folds) != held_out_fold))
    sample = sampled_texts(
        documents.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text")),
        known.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label")),
        PER_CLASS,
        PIECES,
        WINDOW_WORDS,
    )
    return fit_toxicity(sample)


def score_toxicity(documents: DataFrame, model: ToxicityModel, text: str = "text", id_column: str = "doc_id", folds: int = 5) -> DataFrame:
    """``id, held_out, score, predicted`` of every row, from its whole text alone; NULL is empty.

    ``held_out`` is false for a NULL id. Rows are scored where they are read, by themselves, so repeated rows have
    equal scores and ids may repeat. Other columns are not read, whatever their names. An empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            scores = [scorer.score(t or "") for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64())], names=["id", "held_out", "score"]
            )

    kind = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(
        F.col(id_column).alias("id"), F.coalesce(fold(id_column, folds) == 0, F.lit(False)).alias("held_out"), F.col(text).cast("string")
    )
    scored = rows.mapInArrow(run, f"id {kind}, held_out boolean, score double")
    return scored.select(F.col("id").alias(id_column), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(documents: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """The rows, with all their columns, that score below 0.5; NULL and empty texts are judged like others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            yield batch.filter(pa.array([scorer.score(t or "") < 0.5 for t in texts], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
