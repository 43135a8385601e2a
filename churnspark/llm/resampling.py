"""Importance resampling towards a target distribution of hashed word runs.

Features are runs of up to ``most`` words (A-Z lower-cased, joined by one space) and fall into ``buckets`` by the CRC-32 of
their UTF-8 bytes. The checksums of a slice of text are computed by length: the distinct features of one length form a
two-dimensional uint8 array, all checksums advance together column by column, and the results are scattered back to the
occurrences. A bucket's gain is the logarithm of its share in the target over its share in the documents, add-one smoothed;
a document's weight is the sum over its features, its score adds Gumbel noise that depends on the id, and the documents
with the highest scores are drawn: sampling without replacement in proportion to the importance.

Counts cover every document. A task adds up its texts in one array of ``buckets`` numbers and sends one row per bucket; the
gains, ``buckets`` numbers, are the only thing that is handed to tasks.

Null and empty texts have no features and weight 0. A null id is the empty string for the noise and sorts first. Rows with
equal id and text count each and get ranks one after another. Columns of docs that are called like results are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.llm.tables import computed, expanded, fresh, small_batches, text_key, written
from churnspark.llm.textcode import NORMAL, Words, chunks, encoded
from churnspark.operators.rank import running_totals

BUCKETS = 10_000
MOST = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
# Longer features (a text without a blank) are too few to fill columns; each is summed on its own.
WIDEST = 256


def _crc_table() -> np.ndarray:
    """Checksum of every byte, by eight steps of the reflected polynomial."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c


_CRC = _crc_table()


def crc_rows(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of every row of a uint8 array, all rows advancing one column at a time."""
    c = np.full(len(matrix), 0xFFFFFFFF, np.uint32)
    for column in matrix.T:
        c = _CRC[(c ^ column) & np.uint32(0xFF)] ^ (c >> np.uint32(8))
    return c ^ np.uint32(0xFFFFFFFF)


def _distinct(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows, and for every row the number of its equal; rows of up to eight bytes compare as one integer."""
    m, width = matrix.shape
    if width <= 8:
        wide = np.zeros((m, 8), np.uint8)
        wide[:, :width] = matrix
        codes = wide.view(np.uint64).ravel()
    else:
        codes = np.ascontiguousarray(matrix).view(np.dtype((np.void, width))).ravel()
    _, at, inverse = np.unique(codes, return_index=True, return_inverse=True)
    return matrix[at], inverse


def checksums(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of the byte runs data[begin:end], computed by length."""
    out = np.empty(len(begin), np.uint32)
    length = end - begin
    order = np.argsort(length, kind="stable")
    edges = np.flatnonzero(np.diff(length[order], prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(order)]):
        mine, width = order[a:b], int(length[order[a]])
        if width > WIDEST:
            out[mine] = [zlib.crc32(data[i:i + width].tobytes()) for i in begin[mine]]
            continue
        rows, equal = _distinct(data[begin[mine][:, None] + np.arange(width)])
        out[mine] = crc_rows(rows)[equal]
    return out


def word_runs(texts: list[bytes], most: int) -> tuple[np.ndarray, ...]:
    """Words of every text; bytes with one blank between words; begin, end and text number of the runs of 1 to ``most`` words."""
    words = Words(texts, NORMAL)
    data = np.frombuffer(words.buffer, np.uint8)
    keep = data != 0x20
    keep[words.end[words.end < len(data)]] = True
    place = np.cumsum(keep) - 1
    begin, end = place[words.begin], place[words.end - 1] + 1
    text = np.searchsorted(words.first, np.arange(len(begin)), side="right") - 1
    last = words.first[text + 1]  # number of the first word past the text
    at = np.arange(len(begin))
    starts, ends, owners = [], [], []
    for n in range(1, most + 1):
        whole = at[at + n <= last]
        starts.append(begin[whole])
        ends.append(end[whole + n - 1])
        owners.append(text[whole])
    return np.diff(words.first), data[keep], np.concatenate(starts), np.concatenate(ends), np.concatenate(owners)


def _slices(texts: list[str | None], most: int, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slices of a batch: words of every text, then text number and bucket of every feature."""
    for _, some in chunks(pd.Series(texts), encoded(texts)):
        words, data, begin, end, text = word_runs(some, most)
        yield words, text, (checksums(data, begin, end) % np.uint32(buckets)).astype(np.int64)


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS, most: int = MOST) -> DataFrame:
    """(bucket, n): occurrences of the features of all texts; empty buckets are left out."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, bucket in _slices(b.column(0).to_pylist(), most, buckets):
                total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    return texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text", buckets: int = BUCKETS,
          most: int = MOST) -> DataFrame:
    """(bucket, gain) for every bucket: floor(1000 ln) of the smoothed share in the target over that in the documents."""
    counted = [bucket_counts(docs, text_col, buckets, most).withColumn("t", F.lit(0)),
               bucket_counts(target, target_col, buckets, most).withColumn("t", F.lit(1))]
    every = docs.sparkSession.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).cast("long").alias("n"), F.lit(0).alias("t"))
    n = F.sum(F.when(F.col("t") == 0, F.col("n")).otherwise(0)).alias("s"), F.sum(F.when(F.col("t") == 1, F.col("n")).otherwise(0)).alias("t")
    both = written(every.unionByName(counted[0]).unionByName(counted[1]).groupBy("bucket").agg(*n), "bucket_counts")
    totals = both.agg(F.struct((F.sum("s") + buckets).alias("s"), (F.sum("t") + buckets).alias("t"))).scalar()
    wide = both.withColumn("all", totals)
    up = (F.col("t") + 1).cast("double") * F.col("all.s").cast("double")
    down = (F.col("s") + 1).cast("double") * F.col("all.t").cast("double")
    return wide.select("bucket", F.floor(1000 * F.ln(up / down)).cast("long").alias("gain"))


def noise(id_col: str = "doc_id", seed: int = SEED) -> Column:
    """floor(1000 x a Gumbel number) that depends on the id and the seed alone."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / float(2 ** 32)))).cast("long")


def scored(docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text", id_col: str = "doc_id",
           seed: int = SEED, buckets: int = BUCKETS, most: int = MOST) -> DataFrame:
    """``docs`` with n_words, n_features, weight and score (all long)."""
    small_batches(docs.sparkSession)
    rows = gains(docs, target, text_col, target_col, buckets, most).collect()  # one for each bucket
    gain = np.zeros(buckets, np.int64)
    for r in rows:
        gain[r["bucket"]] = r["gain"]

    def run(texts: list[str | None]) -> list[list]:
        words, features, weight = [], [], []
        for count, text, bucket in _slices(texts, most, buckets):
            words += count.tolist()
            features += np.bincount(text, minlength=len(count)).tolist()
            weight += np.bincount(text, gain[bucket], len(count)).astype(np.int64).tolist()  # exact: below 2**53
        return [words, features, weight]

    out = computed(docs.drop("score", "rank"), [F.col(f"`{text_col}`").cast("string")], run, "n_words long, n_features long, weight long")
    return out.withColumn("score", F.col("weight") + noise(id_col, seed))


def ranked(units: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``units`` (doc, key, n_words, score, n equal rows ...) with ``first``, the rank of the unit's first row by score
    (ties to the smaller id), and ``drawn``, how many ranks there are: ``percent`` of the rows with enough words."""
    enough = F.col("n_words") >= least_words
    order = [F.col("score").desc(), F.col("doc").asc_nulls_first(), F.col("key").asc_nulls_first()]
    totals = running_totals(units.filter(enough), order, ["n"])
    placed = totals.select(*units.columns, (F.col("cum_n") - F.col("n") + 1).alias("first"),
                           F.floor(F.col("all_n") * percent / 100).cast("long").alias("drawn"))
    none = F.lit(None).cast("long")
    return placed.unionByName(units.filter(~enough).withColumns({"first": none, "drawn": none}))


def _units(rows: DataFrame) -> DataFrame:
    """One row per (id, text) with the number of equal rows."""
    return written(rows, "scored").groupBy("doc", "key", "n_words", "n_features", "weight", "score").agg(F.count(F.lit(1)).alias("n"))


def digest(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, **options) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null when not drawn): one row per document."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = scored(narrow, target, **options).select(F.col("doc_id").alias("doc"), text_key().alias("key"), "n_words", "n_features", "weight", "score")
    every = expanded(ranked(written(_units(rows), "units"), percent, least_words), "n", "nth", ["doc", "key"])
    rank = F.col("first") + F.col("nth")
    return every.select(F.col("doc").alias("doc_id"), "n_features", "weight", "score",
                        F.when(rank <= F.col("drawn"), rank).alias("rank"))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
              id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The drawn documents with n_features, weight, score and rank. Only ids and scores are ordered; of equal rows (id and
    text) the first ones by rank stay."""
    made = ("n_words", "n_features", "weight", "score", "rank")
    names = {c: fresh(c) for c in docs.columns if c not in made}
    rows = docs.select(*[F.col(f"`{c}`").alias(v) for c, v in names.items()])
    doc, text = names[id_col], names[text_col]
    narrow = scored(rows.select(doc, text), target, text_col=text, id_col=doc, **options)
    keyed = narrow.select(F.col(doc).cast("string").alias("doc"), text_key(text).alias("key"), "n_words", "n_features", "weight", "score")
    numbers = rows.schema[doc].dataType.simpleString()
    units = _units(keyed).withColumn("doc", F.col("doc").cast(numbers))
    taken = ranked(written(units, "units"), percent, least_words).filter(F.col("first") <= F.col("drawn"))
    taken = taken.withColumn("kept", F.least("n", F.col("drawn") - F.col("first") + 1)).drop("n_words")
    whole = rows.groupBy(F.col(doc).alias("_d"), text_key(text).alias("_k")).agg(F.first(F.struct(*names.values())).alias("_row"))
    some = whole.join(taken, F.col("_d").eqNullSafe(F.col("doc")) & F.col("_k").eqNullSafe(F.col("key")))
    out = expanded(some, "kept", "nth", ["_d", "_k"])
    return out.select(*[F.col(f"_row.{v}").alias(c) for c, v in names.items()], "n_features", "weight", "score",
                      (F.col("first") + F.col("nth")).alias("rank"))
