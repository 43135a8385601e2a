"""Token counts by a two-tier lookup on the map side; no pre-token is ever shuffled.

Tier 1: token numbers of frequent pre-tokens, counted on a bounded sample of documents, broadcast as a table of at most
``MOST_FREQUENT`` entries. Tier 2: each worker's own cache of the pre-tokens it met beyond the table, encoded in batches.
Both are caches: they decide the speed, never a count. The sum over a text's pre-tokens is its count.

Texts that the fast split is not proven to split like the tokenizer (characters outside ``PLAIN``, special strings) go to
the tokenizer whole. Null texts are empty and have no tokens.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.tables import computed, fresh, small_batches

# Characters for which lower-casing, normal form and the classes letter / digit / blank are the same everywhere: tab, line
# ends, printable ASCII, the Latin-1 letters and some punctuation.
PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ¡«»¿–—‘’“”…]*")
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\s0-9a-zß-öø-ÿ]+")
MOST_FREQUENT = 1 << 16
SAMPLE_DOCS = 4000
CACHE = 1 << 19
LONGEST_CACHED = 64


class Lengths(dict):
    """Token numbers of pre-tokens: the frequent ones and, up to ``CACHE`` more, those met since."""

    def __init__(self, path: str, frequent: dict[str, int]):
        from tokenizers import Tokenizer

        super().__init__(frequent)
        self.frequent, self.tokenizer = frequent, Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, text: str) -> list[str] | None:
        """Pre-tokens, or None if the text must go to the tokenizer whole."""
        if not PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return None
        return PIECES.findall(text.lower())

    def counts(self, texts: list[str]) -> list[int]:
        split = [self.pieces(t) for t in texts]
        missing = list({p for s in split if s is not None for p in s if p not in self})
        if missing:
            if len(self) + len(missing) > len(self.frequent) + CACHE:
                self.clear()
                self.update(self.frequent)
                missing = list({p for s in split if s is not None for p in s if p not in self})
            self.update(zip(missing, self.whole(missing)))
        out = [-1 if s is None else sum(map(self.__getitem__, s)) for s in split]
        odd = [i for i, n in enumerate(out) if n < 0]
        for i, n in zip(odd, self.whole([texts[i] for i in odd]) if odd else []):
            out[i] = n
        for p in missing:
            if len(p) > LONGEST_CACHED:
                del self[p]
        return out


_lengths: dict[str, Lengths] = {}


def lengths(number: str, path: str, sent) -> Lengths:
    """The worker's cache for the table with this number."""
    if number not in _lengths:
        _lengths.clear()
        _lengths[number] = Lengths(path, sent.value)
    return _lengths[number]


def frequent_pieces(docs: DataFrame, path: str, text_col: str = "text", sample: int = SAMPLE_DOCS) -> dict[str, int]:
    """The most frequent pre-tokens of about ``sample`` documents, chosen by the hash of their text, with token numbers."""
    spread = max(1, docs.count() // sample)
    some = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).filter(
        F.col("text").isNotNull() & (F.pmod(F.xxhash64("text"), F.lit(spread)) == 0))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Lengths(path, {})
        seen: Counter = Counter()
        for f in frames:
            for t in f["text"]:
                seen.update(p for p in own.pieces(t) or () if len(p) <= LONGEST_CACHED)
        most = seen.most_common(MOST_FREQUENT)
        yield pd.DataFrame(most, columns=["piece", "n"])

    best = (some.mapInPandas(count, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "piece").limit(MOST_FREQUENT).select("piece"))
    pieces = [r[0] for r in best.collect()]
    return dict(zip(pieces, Lengths(path, {}).whole(pieces))) if pieces else {}


def token_counts(docs: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns unless given) with n_bytes (UTF-8) and n_tokens as the tokenizer in ``path`` counts them."""
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(frequent_pieces(docs, path, text_col))
    size, number = fresh("size"), uuid.uuid4().hex
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))

    def count(texts: list[str], sizes: list[int]) -> list[list]:
        return [sizes, lengths(number, path, sent).counts(texts)]

    keep = docs.columns if keep is None else keep
    out = docs.withColumn(size, F.octet_length(text).cast("long"))
    return computed(out, [text, F.col(size)], count, "n_bytes long, n_tokens long", keep)


def digest(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    out = token_counts(docs, path, keep=["doc_id"])
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
