"""Documents dealt into chunks of bounded text, in doc_id order.

route numbers the chunks so that a smaller (route, place in chunk) means an earlier document: smaller doc_id first,
null doc_ids first of all. Rows that share a doc_id fall into one chunk and are ordered by text. The limits between
chunks are quantiles of doc_id; at most LIMITS of them reach the driver, and finer chunks divide the span between
two limits evenly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import CHUNK_BYTES, parts_for, text_bytes

LIMITS = 1000


def dealt(documents: DataFrame, chunk: int = CHUNK_BYTES) -> tuple[DataFrame, int]:
    """doc_id, text (null: empty), route; and the number of routes of rows with a doc_id."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = parts_for(text_bytes(docs), chunk)
    coarse = min(parts, LIMITS)
    cuts = []
    if coarse > 1:
        row = docs.agg(F.percentile_approx("doc_id", [i / coarse for i in range(1, coarse)], 10000).alias("q")).first()
        cuts = sorted(set(row["q"] or []))
    fine = -(-parts // coarse)
    cuts_ = np.array(cuts, np.int64)

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        v = ids.to_numpy(np.int64)
        at = np.searchsorted(cuts_, v, "right")
        if fine == 1 or len(cuts_) < 2:
            return pd.Series(at * fine, dtype="int32")
        low = cuts_[np.clip(at - 1, 0, len(cuts_) - 1)]
        high = cuts_[np.clip(at, 0, len(cuts_) - 1)]
        share = np.clip((v - low) / np.maximum(high - low, 1), 0, 1)
        inner = (at > 0) & (at < len(cuts_))
        return pd.Series(at * fine + np.where(inner, np.minimum((share * fine).astype(np.int64), fine - 1), 0), dtype="int32")

    nameless = F.lit(-1) - F.pmod(F.xxhash64("text"), F.lit(parts)).cast("int")
    route = F.when(F.col("doc_id").isNull(), nameless).otherwise(place(F.coalesce("doc_id", F.lit(0))))
    return docs.select("doc_id", "text", route.alias("route")), (len(cuts) + 1) * fine


def in_order(table: pa.Table) -> pa.Table:
    """The rows of a chunk (doc_id, text) in document order; the place of a row is its index here."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")]) if len(table) > 1 else table
