"""Bounded, reproducible training samples."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; NULL for a NULL id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds


def sampled_texts(documents: DataFrame, labels: DataFrame, per_class: int, pieces: int, width: int) -> pd.DataFrame:
    """``id, label, text`` of at most ``per_class`` labelled documents of each class, on the driver.

    ``documents`` has ``id, text``, ``labels`` has ``id, label``. The choice goes by a hash of the id, over the
    labels alone; the ids, bounded by the parameters, are then broadcast to the texts, which are not shuffled.
    A large class is first cut by its size to about twice its share of the sample, so that only those rows are
    ranked in one task.
    Of a text at most ``pieces`` stretches of ``width`` words, evenly spread over all of it, are returned.
    """
    named = labels.filter("id IS NOT NULL AND label IS NOT NULL").groupBy("id").agg(F.max("label").alias("label"))
    named = named.withColumn("key", F.xxhash64("id", F.lit(5)))
    sizes = named.groupBy("label").agg(F.count("*").alias("size"))
    place = F.col("key") / F.lit(2.0**64) + 0.5  # 0 to 1 in the order of the keys
    # A row a class, as many as the model itself holds; without the hint rows would be dealt by class first.
    near = named.join(F.broadcast(sizes), "label").filter(place * F.col("size") <= 2 * per_class + 100)
    order = Window.partitionBy("label").orderBy("key", "id")
    chosen = near.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_class).select("id", "label")

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = []
            for text in pdf.text:
                words = text.split()
                starts = range(0, len(words), width)
                if len(starts) > pieces:
                    starts = [starts[k * len(starts) // pieces] for k in range(pieces)]
                    words = [w for s in starts for w in words[s : s + width]]
                texts.append(" ".join(words))
            yield pd.DataFrame({"id": pdf.id, "label": pdf.label, "text": texts})

    rows = documents.filter("text IS NOT NULL").join(F.broadcast(chosen), "id").select("id", "label", "text")
    kinds = f"id {labels.schema['id'].dataType.simpleString()}, label {labels.schema['label'].dataType.simpleString()}, text string"
    return rows.mapInPandas(spread, kinds).toPandas().sort_values(["id", "text"], ignore_index=True)
