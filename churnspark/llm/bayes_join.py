"""N-gram Jaccard join: pairs of documents whose sets of five-word shingles have Jaccard similarity 0.8 or more.

1. Every document gets its shingle set's digest and MinHash signature. Documents with one shingle set are one class; only
   its representative (smallest id) goes on, so exact copies cost one row, however many there are.
2. Bands of the signature put classes into buckets. In every bucket the pairs' MinHash values are compared step by step;
   a pair is dropped as soon as the posterior probability that its similarity reaches the threshold, given the matches so
   far and a uniform prior, is below ``TOLERANCE``. Survivors are handed on as spanning edges, never as pairs, and their
   connected components bring texts together that have to be compared.
3. Within a component the surviving pairs are verified exactly on their shingle sets. A document counts its links; edges of
   the verified pairs give the groups. Large components are split into blocks; each pair of blocks is a unit of work.

Words are runs of ASCII digits, ASCII letters (lower-cased) and non-ASCII characters. A text of one to four words has one
shingle, its words. The only losses are the bands' and the tolerance's: a pair at the threshold shares no band with
probability 5e-8, a more similar one with less. Nothing is capped: buckets and components of any size are worked off block
by block.

Rules for odd rows: texts without words (null, empty, blank) are linked to nothing and are a class each; equal rows are
copies of each other; a null id sorts last; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm import textcode as tc
from churnspark.llm.components import connected
from churnspark.llm.tables import computed, doc_order, fresh, keyed, parts, small_batches, text_key, written

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-7
BLOCK_BUCKET = 2048
BLOCK_SHINGLES = 1 << 20
PAIRS = 1 << 17
MULTIPLIERS = np.random.Generator(np.random.PCG64(17)).integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """Ascending distinct shingle codes of every text."""
    out: list[np.ndarray] = []
    for _, some in tc.chunks(pd.DataFrame(index=range(len(texts))), texts, 1 << 20):
        w = tc.Words(some, tc.NORMAL)
        code, text, _ = w.windows(size)
        cut = np.searchsorted(text, np.arange(len(some) + 1))
        n = np.diff(w.first)
        for i in range(len(some)):
            if n[i] >= size:
                out.append(np.unique(code[cut[i]:cut[i + 1]]))
            elif n[i]:
                own = w.code[w.first[i]:w.first[i + 1]]
                out.append(tc.mixed(tc.windows(own, len(own), tc._WORDS) + np.uint64(len(own))))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (uint32), one row for each non-empty set."""
    out = np.empty((len(sets), HASHES), np.uint32)
    begin = 0
    while begin < len(sets):
        end, size = begin, 0
        while end < len(sets) and (end == begin or size + len(sets[end]) <= 1 << 15):
            size += len(sets[end])
            end += 1
        codes = np.concatenate(sets[begin:end])
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[begin:end - 1]])]).astype(np.int64)
        for k in range(HASHES):
            out[begin:end, k] = np.minimum.reduceat(((codes * MULTIPLIERS[k]) >> np.uint64(32)).astype(np.uint32), starts)
        begin = end
    return out


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """For n = STEP, 2 STEP ... HASHES compared values the fewest matches with P(similarity >= threshold) >= tolerance."""
    def tail(m: int, n: int) -> float:  # Beta(m + 1, n - m + 1) above the threshold
        return sum(comb(n + 1, k) * threshold**k * (1 - threshold) ** (n + 1 - k) for k in range(m + 1))

    return [next(m for m in range(n + 1) if tail(m, n) >= tolerance) for n in range(STEP, HASHES + 1, STEP)]


def survivors(sig: np.ndarray, a: np.ndarray, b: np.ndarray, needed: list[int]) -> np.ndarray:
    """Which pairs (rows a, b of ``sig``) survive the step-by-step comparison of their MinHash values."""
    out = []
    for k in range(0, len(a), PAIRS):
        left = np.arange(k, min(k + PAIRS, len(a)))
        matches = np.zeros(len(left), np.int64)
        for i, least in enumerate(needed):
            piece = slice(i * STEP, (i + 1) * STEP)
            matches += (sig[a[left], piece] == sig[b[left], piece]).sum(1)
            keep = matches >= least
            left, matches = left[keep], matches[keep]
        out.append(left)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row connected to each of n rows by the pairs (a, b)."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            break
    return label


def signed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, key, class, n, sig): digest, size and MinHash values of the shingle set; without shingles class is null."""
    def sign(texts: list) -> list[list]:
        sets = shingle_sets(tc.encoded(texts))
        some = [i for i, s in enumerate(sets) if len(s)]
        sig = dict(zip(some, signatures([sets[i] for i in some]))) if some else {}
        return [[hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                [len(s) for s in sets], [sig[i].tobytes() if i in sig else None for i in range(len(sets))]]

    rows = keyed(docs, id_col, text_col)
    return computed(rows, [F.col("text")], sign, "class binary, n int, sig binary", ["doc", "key"])


def _bucket_edges(frame: pd.DataFrame, needed: list[int]) -> pd.DataFrame:
    """Spanning edges of the surviving pairs of many buckets (unit: bucket and pair of blocks)."""
    frame = frame.sort_values(["bucket", "i", "j", "class"], kind="stable", ignore_index=True)
    unit = frame.groupby(["bucket", "i", "j"], sort=False).ngroup().to_numpy()
    sig = np.frombuffer(b"".join(frame["sig"]), np.uint32).reshape(len(frame), -1)
    block, cross = frame["block"].to_numpy(), (frame["i"] != frame["j"]).to_numpy()
    size = np.bincount(unit)[unit]
    place = np.arange(len(unit)) - np.searchsorted(unit, unit)
    ours_a, ours_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for step in range(1, int(size.max())):
        a = np.flatnonzero(place + step < size)
        b = a + step
        pair = ~cross[a] | (block[a] != block[b])
        a, b = a[pair], b[pair]
        ok = survivors(sig, a, b, needed)
        ours_a.append(a[ok])
        ours_b.append(b[ok])
    label = roots(len(frame), np.concatenate(ours_a), np.concatenate(ours_b))
    other = np.flatnonzero(label != np.arange(len(label)))
    names = frame["class"].to_numpy()
    return pd.DataFrame({"a": names[other], "b": names[label[other]]}).drop_duplicates()


def _blocked(rows: DataFrame, key: str, blocks, node: str) -> DataFrame:
    """A row for each pair (i <= j) of blocks of its group that the row's block belongs to."""
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64(node, F.lit(5)), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))
    many = rows.filter(F.col("blocks") > 1).withColumn("o", other)
    many = many.withColumn("i", F.least("block", "o")).withColumn("j", F.greatest("block", "o")).drop("o")
    one = rows.filter(F.col("blocks") <= 1).withColumn("i", F.lit(0)).withColumn("j", F.lit(0))
    return one.unionByName(many).withColumn("bin", F.pmod(F.xxhash64(key, "i", "j"), F.lit(4 * parts(rows.sparkSession))))


def candidate_components(classes: DataFrame, needed: list[int]) -> DataFrame:
    """(node, root) of classes that may be similar to another one."""
    narrow = classes.select("class", F.explode(F.array(*[
        F.xxhash64(F.lit(k), F.substring("sig", 4 * ROWS * k + 1, 4 * ROWS)) for k in range(BANDS)])).alias("bucket"))
    buckets = narrow.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > 1)
    rows = narrow.join(buckets, "bucket").join(classes.select("class", "sig"), "class")
    rows = _blocked(rows, "bucket", F.ceil(F.col("members") / BLOCK_BUCKET), "class")

    def edges(frame: pd.DataFrame) -> pd.DataFrame:
        return _bucket_edges(frame, needed)

    found = rows.select("bin", "bucket", "class", "sig", "block", "i", "j").groupBy("bin").applyInPandas(edges, "a binary, b binary")
    return connected(found)


def _verified(frame: pd.DataFrame, threshold: float, needed: list[int]) -> Iterator[tuple]:
    """(class, links, root) of every row of one component's pair of blocks; links are counted in documents."""
    frame = frame.sort_values("class", ignore_index=True)
    sets = shingle_sets(tc.encoded(frame["text"]))
    sig, n, size = signatures(sets), np.array([len(s) for s in sets]), frame["size"].to_numpy(np.int64)
    codes, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(n)])
    block, cross = frame["block"].to_numpy(), frame["i"].iloc[0] != frame["j"].iloc[0]
    present = np.zeros(len(codes), np.int32)
    links, ours_a, ours_b = np.zeros(len(n), np.int64), [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for a in range(len(n) - 1):
        b = np.arange(a + 1, len(n))
        b = b[(np.minimum(n[a], n[b]) >= threshold * np.maximum(n[a], n[b])) & (not cross or block[a] != block[b])]
        b = b[survivors(sig, np.full(len(b), a), b, needed)]
        if not len(b):
            continue
        own = flat[starts[a]:starts[a + 1]]
        present[own] = 1
        if 4 * len(b) >= len(n) - a:
            common = np.add.reduceat(present[flat[starts[a + 1]:]], starts[a + 1:-1] - starts[a + 1])[b - a - 1]
        else:
            common = np.array([present[flat[starts[x]:starts[x + 1]]].sum() for x in b])
        present[own] = 0
        # Integers decide: common / union >= threshold, threshold in hundredths.
        ok = b[100 * common >= round(100 * threshold) * (n[a] + n[b] - common)]
        links[a] += size[ok].sum()
        links[ok] += size[a]
        ours_a.append(np.full(len(ok), a))
        ours_b.append(ok)
    label = roots(len(n), np.concatenate(ours_a), np.concatenate(ours_b))
    names = frame["class"].to_numpy()
    return zip(names, links.tolist(), names[label])


def join(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per document: doc, key, class_id, class_key, n_links, copy_id, copy_key, copies, has_words.

    class_id is the smallest id that chains of links reach, n_links the number of other documents that are similar enough
    (those with the same shingle set included), copy_id the smallest id with the same shingle set, copies their number.
    Ids are longs, a null id is 2**63 - 1. Ids may be null or repeated, so (class_id, class_key) names a class and
    (copy_id, copy_key) a shingle set: the smallest (id, text code) of its documents.
    """
    small_batches(docs.sparkSession)
    needed = least_matches(threshold, tolerance)
    base = written(signed(docs, id_col, text_col), "signed")
    some = base.filter(F.col("class").isNotNull())
    classes = written(some.groupBy("class").agg(
        F.min(F.struct("doc", "key")).alias("first"), F.count(F.lit(1)).alias("size"), F.first("n").alias("n"),
        F.first("sig").alias("sig")).select("class", F.col("first.doc").alias("rep"), F.col("first.key").alias("rep_key"), "size", "n", "sig"), "classes")
    near = written(candidate_components(classes, needed).withColumnRenamed("node", "class"), "near")
    weight = near.join(classes.select("class", "n", "size", "rep", "rep_key"), "class")
    total = weight.groupBy("root").agg(F.sum("n").alias("total"))
    units = weight.join(total, "root")
    units = keyed(docs, id_col, text_col).join(units.hint("shuffle_hash"), (F.col("doc") == F.col("rep")) & (F.col("key") == F.col("rep_key")))
    units = _blocked(units, "root", F.ceil(F.col("total") / BLOCK_SHINGLES), "class")

    def verify(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates(["root", "i", "j", "class"])
        rows = [r for _, unit in frame.groupby(["root", "i", "j"], sort=False) for r in _verified(unit, threshold, needed)]
        return pd.DataFrame(rows, columns=["class", "links", "root"])

    checked = written(units.select("bin", "root", "class", "size", "text", "block", "i", "j").groupBy("bin").applyInPandas(
        verify, "class binary, links long, root binary"), "checked")
    links = checked.groupBy("class").agg(F.sum("links").alias("n_links"))
    groups = connected(checked.select(F.col("class").alias("a"), F.col("root").alias("b")))
    ids = classes.select("class", "rep", "rep_key", "size")
    grouped = ids.join(groups, F.col("class") == F.col("node"), "left").withColumn("root", F.coalesce("root", "class"))
    least = grouped.groupBy("root").agg(F.min(F.struct("rep", "rep_key")).alias("group"))
    info = grouped.join(least, "root").join(links, "class", "left").select(
        F.col("class").alias("c"), "rep", "rep_key", "size", (F.coalesce("n_links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "group")
    out = base.select("doc", "key", "class").join(info, F.col("class") == F.col("c"), "left")
    return out.select("doc", "key", F.coalesce("group.rep", "doc").alias("class_id"), F.coalesce("group.rep_key", "key").alias("class_key"),
                      F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("rep", "doc").alias("copy_id"),
                      F.coalesce("rep_key", "key").alias("copy_key"), F.coalesce("size", F.lit(1)).alias("copies"),
                      F.col("class").isNotNull().alias("has_words"))


def digest(docs: DataFrame) -> DataFrame:
    out = join(docs)
    return out.select(F.when(F.col("doc") < 2**63 - 1, F.col("doc")).alias("doc_id"), "class_id", "class_key", "n_links", "copy_id",
                      "copy_key", "copies")


def filtered(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest (id, text code); texts without words stay.

    Same columns. Unlike texts with one id, or without an id, are groups of their own.
    """
    names = {c: fresh(c) for c in docs.columns}
    rows = docs.toDF(*names.values())
    out = join(rows, id_col=names["doc_id"], text_col=names["text"])
    kept = out.filter(F.col("has_words") & (F.col("doc") == F.col("class_id")) & (F.col("key") == F.col("class_key")))
    kept = kept.select("doc", "key").distinct()
    free = out.filter(~F.col("has_words")).select("doc", "key").distinct()
    order, code, word = fresh("order"), fresh("code"), fresh("word")
    both = rows.withColumn(order, doc_order(names["doc_id"])).withColumn(code, text_key(names["text"]))
    stay = kept.withColumn(word, F.lit(True)).unionByName(free.withColumn(word, F.lit(False)))
    both = both.join(stay.hint("shuffle_hash"), (F.col(order) == F.col("doc")) & (F.col(code) == F.col("key"))).drop("doc", "key")
    once = both.filter(F.col(word)).dropDuplicates([order, code]).unionByName(both.filter(~F.col(word)))
    return once.select(*[F.col(v).alias(c) for c, v in names.items()])
