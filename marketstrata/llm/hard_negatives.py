"""Hard negatives by the threshold algorithm over per-dimension sorted lists of each shard of candidates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from marketstrata.session import stored

#: Components held by one side of a cell: candidates of a shard, anchors of a block.
CELL_VALUES = 2_000_000
#: Entries of each list read before the threshold is looked at first; doubled from look to look.
FIRST_DEPTH = 64


class SortedLists:
    """The candidates of a shard, and for each dimension the candidates in ascending order of that component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").T.copy()
        self.greatest = int(np.abs(vectors).max(initial=0))
        self.float = vectors.astype(float)

    def search(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[float, float]], k: int) -> list[list[tuple[int, int]]]:
        """For each window of scores (both ends included) the first ``k`` allowed ``(score, id)`` in it.

        Reads all lists from the end that suits the anchor's sign, scores every candidate met by its whole vector,
        and stops once the threshold, the score that an unmet candidate can have at most, is strictly below what each
        window still takes; a tie may go to a smaller id, so equality reads on. Scores are integers; where
        they could leave 64 bits there is no threshold and all candidates are scored, modulo 2**64.
        """
        n, dims = self.vectors.shape
        bound = self.greatest * int(np.abs(anchor).max(initial=0)) * max(dims, 1)
        exact = bound < 1 << 53
        rising = np.flatnonzero(anchor < 0)
        falling = np.flatnonzero(anchor > 0)
        lists = len(rising) + len(falling) > 0
        met = np.zeros(n, bool)
        best: list[list[tuple[int, int]]] = [[] for _ in windows]
        depth, step = 0, FIRST_DEPTH
        while depth < n:
            end = min(depth + step, n) if lists else n
            before = met.copy()
            if end == n:
                met[:] = True
            else:
                met[self.order[rising, depth:end].ravel()] = True
                met[self.order[falling, n - end : n - depth].ravel()] = True
            fresh = np.flatnonzero(met & ~before & allowed)
            score = (self.float[fresh] @ anchor.astype(float)).astype(np.int64) if exact else self.vectors[fresh] @ anchor
            for w, (low, high) in enumerate(windows):
                inside = np.flatnonzero((score >= low) & (score <= high))
                if len(inside) > k:
                    inside = inside[np.lexsort((self.ids[fresh[inside]], -score[inside]))[:k]]
                found = best[w] + list(zip(score[inside].tolist(), self.ids[fresh[inside]].tolist(), strict=True))
                best[w] = sorted(found, key=lambda x: (-x[0], x[1]))[:k]
            depth, step = end, 2 * step
            if depth < n and bound < 1 << 62:
                last = self.vectors[self.order[rising, depth - 1], rising] @ anchor[rising]
                last += self.vectors[self.order[falling, n - depth], falling] @ anchor[falling]
                if all(last < (b[-1][0] if len(b) == k else low) for b, (low, _) in zip(best, windows, strict=True)):
                    break
        return best


def _matrix(lists: pd.Series) -> np.ndarray:
    return np.array(lists.tolist(), dtype=np.int64).reshape(len(lists), -1)


def integer_vectors(rows: DataFrame, vec_id: str, label: Column, vector: str, scale: int) -> DataFrame:
    """``id, label, vector, dims, row``: the rows that take part, repeated ones once, components times ``scale`` rounded down."""
    x = F.col(vector)
    fit = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = rows.filter(F.col(vec_id).isNotNull() & label.isNotNull() & F.coalesce(fit, F.lit(False)))
    picked = whole.select(
        F.col(vec_id).cast("long").alias("id"),
        label.cast("long").alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("vector"),
    ).distinct()
    # Stored, so that the numbers of the rows stay what they are.
    return stored(picked.select("*", F.size("vector").alias("dims"), F.monotonically_increasing_id().alias("row")), "vectors")


def _cells(rows: DataFrame, anchors: DataFrame, by: list[str]) -> tuple[GroupedData, GroupedData]:
    """Both sides dealt to cells: a shard of candidates and a block of anchors that agree in ``by``; sizes are bounded."""
    per = F.greatest(F.lit(1), F.floor(F.lit(CELL_VALUES) / F.greatest(F.first("dims"), F.lit(1))))
    count = lambda df, name: df.groupBy(*by).agg(F.ceil(F.count("*") / per).cast("int").alias(name))
    sizes = count(rows, "shards").join(count(anchors, "blocks"), by)
    own = lambda n, seed: F.pmod(F.xxhash64("row", F.lit(seed)), n)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n).cast("long") - 1))
    left = rows.join(sizes, by).withColumn("shard", own(F.col("shards"), 1)).withColumn("block", every("blocks"))
    right = anchors.join(sizes, by).withColumn("block", own(F.col("blocks"), 2)).withColumn("shard", every("shards"))
    left, right = left.drop("shards", "blocks"), right.drop("shards", "blocks")
    return left.groupBy(*by, "shard", "block"), _named_a(right).groupBy(*[f"a_{c}" for c in (*by, "shard", "block")])


def _named_a(df: DataFrame) -> DataFrame:
    """Both sides come from one table; names of their own keep them apart."""
    return df.select(*[F.col(c).alias(f"a_{c}") for c in df.columns])


def _first(found: DataFrame, by: list[str], score: str, other: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(other))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest_positives(rows: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """``row, positive_id, positive_score``: the first ``k`` rows of each anchor's label with another id."""

    def run(candidates: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(candidates) and len(block):
            shard = SortedLists(candidates.id.to_numpy(), _matrix(candidates.vector))
            for row, own, vector in zip(block.a_row, block.a_id, _matrix(block.a_vector), strict=True):
                [best] = shard.search(vector, shard.ids != own, [(-np.inf, np.inf)], k)
                out += [(row, other, score) for score, other in best]
        return pd.DataFrame(out, columns=["row", "positive_id", "positive_score"])

    left, right = _cells(rows, anchors, ["dims", "label"])
    found = left.cogroup(right).applyInPandas(run, "row long, positive_id long, positive_score long")
    return _first(found, ["row"], "positive_score", "positive_id", k).drop("rank")


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    vec_id: str = "vec_id",
    label: Column | None = None,
    vector: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """For each anchor and positive the hardest negatives in the window ``low`` to ``high`` percent of the positive's score.

    ``anchors`` picks the anchors by ``id``, ``label``; scores are inner products of vectors of ``scale`` times the
    components, rounded down. Positives are the first rows of the anchor's label with another id, negatives rows of
    other labels; greater scores come first, ties by smaller id. A positive with a score below 0 has no window.
    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; pairs without a negative
    have no row.

    Rows with a NULL id, label, vector or component, or a component that is not finite, take no part; rows repeated in
    full count once; unlike rows of one id are rows of their own; vectors meet only vectors of their length, and those
    without components all score 0. An empty table, or one without anchors, gives no rows. Other columns are not read.

    Candidates are dealt to shards and anchors to blocks of bounded size, also within a label that holds most rows.
    Each cell runs the threshold algorithm over its shard's lists; a shard sends its first few per anchor and window.
    """
    table = integer_vectors(rows, vec_id, F.col("label") if label is None else label, vector, scale)
    chosen = table.filter(anchors)
    best = stored(nearest_positives(table, chosen, positives), "positives")
    wanted = best.groupBy("row").agg(F.collect_set("positive_score").alias("scores"))
    asking = chosen.join(wanted, "row").select("row", "dims", "label", "vector", "scores")

    def run(candidates: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(candidates) and len(block):
            shard, labels = SortedLists(candidates.id.to_numpy(), _matrix(candidates.vector)), candidates.label.to_numpy()
            for row, own, vector, scores in zip(block.a_row, block.a_label, _matrix(block.a_vector), block.a_scores, strict=True):
                asked = sorted(int(s) for s in scores if s >= 0)
                # Whole scores from low * s / 100 up to high * s / 100.
                windows = [(-(-low * s // 100), high * s // 100) for s in asked]
                for s, found in zip(asked, shard.search(vector, labels != own, windows, negatives), strict=True):
                    out += [(row, s, other, score) for score, other in found]
        return pd.DataFrame(out, columns=["row", "positive_score", "negative_id", "negative_score"])

    left, right = _cells(table, asking, ["dims"])
    kind = "row long, positive_score long, negative_id long, negative_score long"
    found = left.cogroup(right).applyInPandas(run, kind)
    hardest = _first(found, ["row", "positive_score"], "negative_score", "negative_id", negatives)
    names = chosen.select("row", F.col("id").alias("anchor_id"))
    return best.join(hardest, ["row", "positive_score"]).join(names, "row").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
