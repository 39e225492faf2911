"""Document fingerprints: threshold-scaled sketches of five-word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range, so its size
follows the document's, sketches of parts merge by union, and containment can be estimated
between documents of very unequal length.  A text with words but no hash below the
threshold keeps its lowest one; in a merge that one yields to any hash below.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from citewell.llm.common import WordHashes, map_rows, whole

SHINGLE = 5
#: One hash in so many is kept.
SCALE = 8
_BELOW = np.uint64((1 << 64) // SCALE)
_LOWEST_KEY = -(1 << 63)


def sketch(text: str, hashes: WordHashes) -> np.ndarray:
    """Sorted kept hashes; empty only for a text without words.  Case and kind of space don't matter."""
    found = np.unique(hashes.shingles(text.lower().split(), SHINGLE))
    return found[: max(int(np.searchsorted(found, _BELOW)), min(len(found), 1))]


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of two parts' shingles together."""
    both = np.union1d(a, b)
    return both[: max(int(np.searchsorted(both, _BELOW)), min(len(both), 1))]


def to_text(values: np.ndarray) -> str:
    return base64.b64encode(values.astype("<u8").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u8")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common shingles among all of both; two empty sketches are alike."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common) if len(a) or len(b) else 1.0


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of ``a``'s shingles that ``b`` has, whatever ``b``'s length; 1 for an empty ``a``."""
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 1.0


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), column: str = "text") -> DataFrame:
    """``keep`` and fingerprint of every row; null counts as empty, the fingerprint of which is empty."""
    kinds = dict(docs.dtypes)
    schema = "".join(f"`{k}` {kinds[k]}, " for k in keep) + "fingerprint string"

    def start():
        hashes = WordHashes()
        return lambda *row: (*row[:-1], to_text(sketch(row[-1] or "", hashes)))

    return map_rows(docs.select(*keep, F.col(column)), schema, start)


def edited(text: str, following: str) -> str:
    """The last quarter replaced by the first as many code points of another text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


_COMPARED = (
    "doc_id {}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, held_by_edited double"
)


def compared_with_next(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, with their likeness, and that to the next document.

    Next is ascending by key, the first after the last; rows of one key follow by text, a null
    key comes first, null text is empty.  A single row is its own next.  An empty table gives an
    empty one; other columns are left out.

    Texts are shuffled once: key ranges (bounds from quantiles, as many as shuffle partitions)
    become buckets, the first rows of a bucket also go to the bucket before, and each bucket is
    read in order with two texts in memory.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).alias("doc_id"), whole(column).alias("text")).withColumn(
        "__key", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST_KEY))
    )
    shares = [i / buckets for i in range(1, buckets)] or [0.5]
    found = rows.agg(F.min("__key").alias("first"), F.percentile_approx("__key", shares, 20 * buckets).alias("bounds")).first()
    first, bounds = found.first, np.array(sorted(set(found.bounds or ())), np.int64)
    last = len(bounds)

    @F.pandas_udf("long")
    def place(keys: pd.Series) -> pd.Series:
        """Twice the bucket, and one more for the first key of a bucket."""
        at = np.searchsorted(bounds, keys.to_numpy(), side="right")
        starts = np.r_[_LOWEST_KEY, bounds][at] == keys.to_numpy()
        return pd.Series(2 * at + (starts & (at > 0)))

    placed = rows.withColumn("__place", place("__key"))
    own = F.expr("__place div 2")
    # A row is at home in its bucket (0) or a guest that only follows the bucket's last row (1).
    homes = F.array_compact(F.array(
        F.struct(own.alias("bucket"), F.lit(0).alias("guest")),
        F.when(F.col("__place") % 2 == 1, F.struct((own - 1).alias("bucket"), F.lit(1).alias("guest"))),
        F.when(F.col("__key") == F.lit(first), F.struct(F.lit(last).cast("long").alias("bucket"), F.lit(1).alias("guest"))),
    ))
    dealt = (
        placed.select("doc_id", "text", "__key", F.explode(homes).alias("__home"))
        .select("__home.bucket", "__home.guest", "__key", "doc_id", "text")
        .repartition(buckets, "bucket").sortWithinPartitions("bucket", "guest", "__key", "text")
        .select("bucket", "guest", "doc_id", "text")
    )
    schema = _COMPARED.format(dict(docs.dtypes)[key])
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, before, made = WordHashes(), None, []

        def closed(row, text, kept, next_text, next_kept):
            other = edited(text, next_text)
            other_kept = sketch(other, hashes)
            return (
                row, len(text), hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(), to_text(kept),
                to_text(other_kept), likeness(kept, other_kept), likeness(kept, next_kept), containment(kept, other_kept),
            )

        def packed():
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*made), out)], schema=out)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for bucket, guest, row, text in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    kept = None
                    if before and before[0] == bucket:
                        kept = sketch(text, hashes)
                        made.append(closed(*before[1:], text, kept))
                    if guest:
                        before = None
                    else:
                        before = bucket, row, text, sketch(text, hashes) if kept is None else kept
                if made:
                    yield packed()
                    made = []

    return dealt.mapInArrow(run, schema)
