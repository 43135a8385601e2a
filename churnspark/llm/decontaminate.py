"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all items scans every text once.

Both sides are normalised alike: A-Z lower-cased, words are runs of ASCII digits, ASCII letters and non-ASCII characters. A
pattern is a window of 13 consecutive words of an item between blanks (the whole item if it has fewer words), so a match is
a match of whole words. Matches are mapped to word intervals and to character offsets of the original text.

The automaton is the only thing broadcast, and its size is bounded: items are read one after another and dealt into
automata of at most ``MOST_CHARS`` pattern characters. Nearly every benchmark fits one; a larger one scans the texts once
for each, the results merge. There is no shuffle and no limit on matches.

Rules for odd rows: null texts and texts without words match nothing; items without words have no window; a null item_id
is called ''; rows with one item_id are one item; repeated documents are judged one by one.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.llm.tables import computed, fresh, small_batches, written
from churnspark.llm.textcode import NORMAL, encoded

WINDOW = 13
MOST_CHARS = 4 << 20
MADE = "n_words long, begins array<int>, ends array<int>, items array<string>, spans array<struct<begin:int,end:int>>"

_automata: dict[str, ahocorasick.Automaton] = {}


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def item_windows(text: str | None, length: int = WINDOW) -> set[str]:
    words = [w.decode("latin-1") for w in words_of(encoded([text])[0])]
    last = max(1, len(words) - length + 1) if words else 0
    return {" " + " ".join(words[i:i + length]) + " " for i in range(last)}


def pattern_sets(items: DataFrame, id_col: str, text_col: str, length: int) -> Iterator[dict[str, list[str]]]:
    """Window -> item ids, in sets of at most ``MOST_CHARS`` characters; the driver holds one set at a time."""
    found: dict[str, list[str]] = defaultdict(list)
    size = 0
    rows = items.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.col(f"`{text_col}`").cast("string"))
    for name, text in rows.toLocalIterator():
        for w in item_windows(text, length):
            if size + len(w) > MOST_CHARS:
                yield dict(found)
                found, size = defaultdict(list), 0
            size += 0 if w in found else len(w)
            if name not in found[w]:
                found[w].append(name)
    yield dict(found)


def _automaton(number: str, patterns: dict[str, list[str]]) -> ahocorasick.Automaton:
    if number not in _automata:
        _automata.clear()
        a = ahocorasick.Automaton()
        for w, names in patterns.items():
            a.add_word(w, (w.count(" ") - 1, names))
        if patterns:
            a.make_automaton()
        _automata[number] = a
    return _automata[number]


def _merged(pairs: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Maximal intervals; ones that touch become one."""
    begins, ends = [], []
    for b, e in sorted(pairs):
        if ends and b <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            begins.append(b)
            ends.append(e)
    return begins, ends


def _offsets(raw: bytes, begins: list[int], ends: list[int]) -> list[dict]:
    """Character offsets of word intervals in the original text."""
    data = np.frombuffer(raw.translate(NORMAL), np.uint8)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = data != 0x20
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts_char = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [{"begin": int(starts_char[edges[2 * b]]), "end": int(starts_char[edges[2 * e - 1]])} for b, e in zip(begins, ends)]


def _scan(automaton, texts, begins, ends, items) -> list[list]:
    out = [[], [], [], [], []]
    for raw, b0, e0, i0 in zip(encoded(texts), begins, ends, items):
        words = words_of(raw)
        joined = b" " + b" ".join(words) + b" "
        b, e, names = b0 or [], e0 or [], i0 or []
        found = list(automaton.iter(joined.decode("latin-1"))) if words and len(automaton) else []
        if found:
            blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
            last = np.searchsorted(blanks, [x for x, _ in found]).tolist()
            b, e = _merged(list(zip(b, e)) + [(x - n, x) for x, (_, (n, _)) in zip(last, found)])
            names = sorted(set(names).union(*(v for _, (_, v) in found)))
        for column, value in zip(out, (len(words), b, e, names, _offsets(raw, b, e) if b else [])):
            column.append(value)
    return out


def matches(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
            item_text_col: str = "text", length: int = WINDOW, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns of ``docs`` unless given) with

    n_words, begins/ends (maximal hit word intervals), items (sorted ids of the items found) and spans (the intervals as
    character offsets of the original text). Columns of ``docs`` that are called like these are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    keep = docs.columns if keep is None else keep
    text, nothing = fresh("text"), F.lit(None)
    out = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias(text))
    prior: list[Column] = [nothing.cast("array<int>"), nothing.cast("array<int>"), nothing.cast("array<string>")]
    for number, patterns in enumerate(pattern_sets(items, item_id_col, item_text_col, length)):
        if number:
            out = written(out, "matches")
            prior = [F.col("begins"), F.col("ends"), F.col("items")]
        sent = spark.sparkContext.broadcast(patterns)

        def scan(texts, begins, ends, names, sent=sent, number=uuid.uuid4().hex):
            return _scan(_automaton(number, sent.value), texts, begins, ends, names)

        out = computed(out, [F.col(text), *prior], scan, MADE)
    return out.drop(text)


def judged(found: DataFrame) -> DataFrame:
    """``matches`` with n_hit, n_items, items_sha256 and contaminated: at least a twentieth of the words are hit."""
    hit = F.aggregate(F.zip_with("begins", "ends", lambda b, e: (e - b).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.withColumns({
        "n_hit": hit, "n_items": F.size("items").cast("long"), "items_sha256": F.sha2(F.array_join("items", ","), 256),
    }).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = judged(matches(docs, items, keep=["doc_id"]))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def filtered(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without contaminated documents, same columns."""
    names = {c: fresh(c) for c in docs.columns}
    found = judged(matches(docs.toDF(*names.values()), items, text_col=names["text"]))
    return found.filter(~F.col("contaminated")).select(*[F.col(names[c]).alias(c) for c in docs.columns])
