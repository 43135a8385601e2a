"""Odd rows that every operator has to bear, and brute-force versions of the operators."""

import hashlib
import re
from collections import Counter

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use themselves.
    *[T.StructField(n, T.StringType()) for n in (
        "key", "doc", "kept", "n_words", "n_removed", "score", "hits", "size", "target", "copies", "begins", "ends", "items", "spans",
        "matches", "n_units", "class", "rank", "n", "m", "whole", "run", "n_tokens", "n_bytes", "y", "id")],
])
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))


def rows(texts):
    """(doc_id, text, lang, source) as rows of SCHEMA."""
    return [(d, t, lang, s, None if t is None else len(t), *["x"] * (len(SCHEMA) - 5)) for d, t, lang, s in texts]


def documents(spark, partitions=3):
    base = "the quick brown fox jumps over the lazy dog while seven wizards brew strange potions in the old stone tower by night again"
    texts = [
        (1, base, "en", "b"), (2, base, "en", None), (3, base + " and more", "en", "a"), (3, base + " and more", "en", "a"),
        (4, None, None, None), (5, "", "en", "a"), (6, " \t\n ", "en", "a"), (None, base, "en", "b"), (None, None, None, "c"),
        (7, "élan vital ünd so weiter " * 12, "fr", "c"), (8, "x" * 30_000, "en", "c"), (9, LONG, "en", "c"), (10, LONG + " end", "en", "c"),
        (11, "one two", "en", "a"), (12, "one two", "en", "a"), (13, "\u0000 nul \u0000 " + base, "en", "d"), (-5, base.upper(), "en", "d"),
        (14, "same row", "en", "e"), (14, "same row", "en", "e"), (14, "same row", "en", "e"), (15, "日本語のテキスト " * 30, "ja", "日本"),
    ]
    return spark.createDataFrame(rows(texts), SCHEMA).repartition(partitions)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(df, id_col="doc_id", text_col="text"):
    return [(r[0], r[1]) for r in df.select(id_col, text_col).collect()]


def order(doc):
    return 2**63 - 1 if doc is None else doc


def sha(data):
    return hashlib.sha256(data).hexdigest()


def blank_words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def plain_words(text):
    lower = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def repeats(docs, length=20):
    """(doc_id, n_words, n_removed, sha) of op6."""
    first = {}
    words = [(d, blank_words(t)) for d, t in docs]
    for d, w in words:
        for i in range(len(w) - length + 1):
            k = tuple(w[i:i + length])
            first[k] = min(first.get(k, (2**64, 0)), (order(d), i))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - length + 1):
            if first[tuple(w[i:i + length])] < (order(d), i):
                gone.update(range(i, i + length))
        out.append((d, len(w), len(gone), sha(b" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def shared(docs, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, sha) of op4."""
    data = [(d, (t or "").encode()) for d, t in docs]
    first = {}
    for d, b in data:
        for i in range(len(b) - length + 1):
            first[b[i:i + length]] = min(first.get(b[i:i + length], 2**64), order(d))
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < order(d):
                gone[i:i + length] = b"\1" * length
        spans = len(re.findall(b"\x01+", bytes(gone)))
        out.append((d, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def hits(docs, items, length=13):
    """(doc_id, n_words, n_hit, n_items, sha, contaminated) of op3."""
    win = {}
    for name, text in items:
        w = plain_words(text)
        n = min(len(w), length)
        for i in range(len(w) - n + 1 if n else 0):
            win.setdefault(tuple(w[i:i + n]), set()).add("" if name is None else str(name))
    sizes = {len(k) for k in win}
    out = []
    for d, t in docs:
        w, hit, found = plain_words(t), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in win:
                    hit.update(range(i, i + n))
                    found |= win[tuple(w[i:i + n])]
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found)).encode()), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def shingles(text, size=5):
    w = plain_words(text)
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def joined(docs, threshold=80):
    """{(doc_id, text): (class_id, n_links, copy_id, copies)} of op5, ids with null as the largest."""
    sets = {}
    for d, t in docs:
        s = shingles(t)
        sets.setdefault(s if s else (order(d), t), []).append(order(d))
    names = list(sets)
    links, parent = Counter(), list(range(len(names)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(names)):
        for b in range(a):
            x, y = names[a], names[b]
            if isinstance(x, frozenset) and isinstance(y, frozenset):
                common = len(x & y)
                if 100 * common >= threshold * (len(x) + len(y) - common):
                    links[a] += len(sets[y])
                    links[b] += len(sets[x])
                    parent[root(a)] = root(b)
    least = {}
    for k, name in enumerate(names):
        least[root(k)] = min(least.get(root(k), 2**64), min(sets[name]))
    where = {name: k for k, name in enumerate(names)}
    out = {}
    for d, t in docs:
        s = shingles(t)
        name = s if s else (order(d), t)
        k = where[name]
        size = len(sets[name]) if s else 1
        out[d, t] = (least[root(k)], links[k] + size - 1, min(sets[name]), size)
    return out
