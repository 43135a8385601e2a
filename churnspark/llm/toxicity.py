"""Toxicity: Levenshtein automata intersected with a lexicon trie find terms and their misspellings; context decides.

The lexicon is learned from labelled documents: whole words, and stems (beginnings of words), whose document frequency is
much higher in toxic documents. The words form a trie; its nodes paired with an edit count are the states of a Levenshtein
automaton for all words at once, made deterministic. It runs over every word of a batch in parallel, one character of all
still living words at a time, so a text costs a few table look-ups a word, whatever the lexicon.

A hit is scored in its window of ``CONTEXT`` words on either side: hits that stand together reinforce each other (abuse),
hits inside quotation marks are summed apart (quotation). A logistic regression over these sums and the length gives the
score. Neither labels nor language, source or id are inputs of a score.

Every term that passes the tests is in the lexicon. Tries are dealt out by ``TRIE_LETTERS``, an automaton each, so that a large
lexicon costs its size. Terms shorter than ``FUZZY_FROM`` letters are within one edit of many ordinary words: such a hit counts
only if the word is not one of several clean documents itself, and has a sum of its own in the score.

Only the fit uses a sample, at most ``SAMPLE`` labelled documents of each class, chosen by the hash of their id; lexicon and
automata are therefore bounded and go to the tasks. Every text is scored whole, without a shuffle.

Rules for odd rows: a null text is an empty text and gets the score of a text without words; labels that are null are no
labels, a document with several labels counts with each; without labels of both classes every score is 0.5.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.llm.tables import computed, fresh, small_batches
from churnspark.llm.textcode import chunks

THRESHOLD = 0.7
SAMPLE = 4000
TRIE_LETTERS = 1200
LEAST_DOCS = 6
LEAST_ODDS = 1.2
STEM = (4, 9)
FUZZY_FROM = 5
EDITS = 1
CONTEXT = 8
SLICE = 2 << 20
MADE = "score double, hits array<struct<begin:int,end:int,term:string,edits:int,quoted:boolean>>"

# Opening and closing quotation marks.
QUOTES = "\"“”„«»"
_points = [chr(i) for i in range(0x10000)]
WORD_CHAR = np.array([c.isalnum() for c in _points])
QUOTE_CHAR = np.array([c in QUOTES for c in _points])
WORD = re.compile(r"[^\W_]+")


class Trie:
    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term = [-1]
        for k, t in enumerate(terms):
            at = 0
            for c in t:
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.term.append(-1)
                at = self.children[at][c]
            self.term[at] = k


@dataclass
class Automaton:
    """next[state, class] with state 0 dead and 1 the start; term[state] is -1 or the term accepted with edits[state]."""

    classes: np.ndarray
    next: np.ndarray
    term: np.ndarray
    edits: np.ndarray

    @staticmethod
    def of(terms: list[str], edits: int, stems: bool) -> Automaton:
        trie = Trie(terms)
        letters = sorted({c for t in terms for c in t})
        classes = np.zeros(0x10000, np.int32)
        for k, c in enumerate(letters):
            classes[min(ord(c), 0xFFFF)] = k + 1

        def closed(pairs) -> frozenset:
            best: dict[int, int] = {}
            todo = list(pairs)
            while todo:
                n, e = todo.pop()
                if e > edits or best.get(n, edits + 1) <= e:
                    continue
                best[n] = e
                todo += [(m, e + 1) for m in trie.children[n].values()]
            return frozenset(best.items())

        def step(state: frozenset, c: str | None) -> frozenset:
            out = []
            for n, e in state:
                if stems and trie.term[n] >= 0:
                    out.append((n, e))  # the rest of the word is free
                    continue
                if c in trie.children[n]:
                    out.append((trie.children[n][c], e))
                if e < edits:
                    out += [(n, e + 1), *((m, e + 1) for m in trie.children[n].values())]
            return closed(out)

        start = closed([(0, 0)])
        number, rows, todo = {frozenset(): 0, start: 1}, {}, [start]
        while todo:
            state = todo.pop()
            row = [step(state, c) for c in (None, *letters)]
            for s in row:
                if s not in number:
                    number[s] = len(number)
                    todo.append(s)
            rows[number[state]] = [number[s] for s in row]
        table = np.zeros((len(number), len(letters) + 1), np.int32)
        term, cost = np.full(len(number), -1, np.int32), np.zeros(len(number), np.int32)
        for k, row in rows.items():
            table[k] = row
        for state, k in number.items():
            accepted = [(e, trie.term[n]) for n, e in state if trie.term[n] >= 0]
            if accepted:
                cost[k], term[k] = min(accepted)
        return Automaton(classes, table, term, cost)

    def run(self, points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Final state of every word; words that die early cost nothing more."""
        final = np.zeros(len(begin), np.int32)
        letter = self.classes[points]
        alive, at, state = np.arange(len(begin)), begin.copy(), np.ones(len(begin), np.int32)
        while len(alive):
            state = self.next[state, letter[at]]
            at += 1
            done = at == end[alive]
            final[alive[done]] = state[done]
            go = ~done & (state > 0)
            alive, at, state = alive[go], at[go], state[go]
        return final


@dataclass
class Model:
    words: list[str] = field(default_factory=list)
    stems: list[str] = field(default_factory=list)
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))  # of words, then of stems
    coef: np.ndarray | None = None
    known: set[str] = field(default_factory=set)  # ordinary words within one edit of a short term
    automata: list[tuple[Automaton, int]] = field(default_factory=list)  # with the number of the first term

    def build(self) -> Model:
        """Orders the terms and makes their automata."""
        self.words = sorted(self.words)
        self.stems = sorted(self.stems)
        self.automata = []
        for terms, edits, stems, first in ((self.words, EDITS, False, 0), (self.stems, 0, True, len(self.words))):
            begin = size = 0
            for k in range(len(terms) + 1):
                if k > begin and (k == len(terms) or size + len(terms[k]) > TRIE_LETTERS):
                    self.automata.append((Automaton.of(terms[begin:k], edits, stems), first + begin))
                    begin, size = k, 0
                size += len(terms[k]) if k < len(terms) else 0
        return self

    def short(self) -> np.ndarray:
        """Which terms are short words."""
        return np.array([len(w) < FUZZY_FROM for w in self.words] + [False] * len(self.stems), bool)


def _joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of lower-cased texts, separated by a line end, and the offset of every text."""
    low = []
    for t in texts:
        lower = (t or "").lower()
        # A few capitals become two characters; offsets need one for one.
        low.append(lower if len(lower) == len(t or "") else "".join(c.lower()[:1] for c in t))
    data = "\n".join(low).encode("utf-32-le", "surrogatepass")
    points = np.minimum(np.frombuffer(data, np.uint32), 0xFFFF).astype(np.int64)
    return points, np.concatenate([[0], np.cumsum([len(t) + 1 for t in low])])


@dataclass
class Hits:
    """Hits of a slice: text, word number, character begin / end in the text, term, edits, quoted."""

    n_words: np.ndarray
    text: np.ndarray
    word: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    term: np.ndarray
    edits: np.ndarray
    quoted: np.ndarray


def find(texts: list[str | None], model: Model) -> Hits:
    points, offset = _joined(texts)
    inside = np.zeros(len(points) + 2, bool)
    inside[1:-1] = WORD_CHAR[points]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edges[::2], edges[1::2]
    first = np.searchsorted(begin, offset)
    parts = []
    for a, shift in model.automata:
        state = a.run(points, begin, end)
        at = np.flatnonzero(a.term[state] >= 0)
        parts.append((at, a.term[state[at]] + shift, a.edits[state[at]]))
    at, term, edits = (np.concatenate(c) for c in zip(*parts)) if parts else (np.empty(0, np.int64),) * 3
    near = model.short()[term] & (edits > 0) if len(term) else np.empty(0, bool)
    common = np.zeros(len(at), bool)
    for k in np.flatnonzero(near).tolist():
        common[k] = "".join(map(chr, points[begin[at[k]]:end[at[k]]].tolist())) in model.known
    at, term, edits, near = at[~common], term[~common], edits[~common], near[~common]
    # One hit a word: a term, then its misspelling, then a stem, then what is near a short term.
    order = np.lexsort((term, edits, np.where(near, 2, term >= len(model.words)), at))
    order = order[np.concatenate([[True], at[order][1:] != at[order][:-1]])] if len(order) else order
    at, term, edits = at[order], term[order], edits[order]
    text = np.searchsorted(first, at, side="right") - 1
    # Inside quotation marks: an odd number of marks since the beginning of the line.
    marks = np.concatenate([[0], np.cumsum(QUOTE_CHAR[points])])
    lines = np.concatenate([[0], np.flatnonzero(points == 10) + 1])
    line = lines[np.searchsorted(lines, begin[at], side="right") - 1]
    quoted = (marks[begin[at]] - marks[line]) % 2 == 1
    return Hits(np.diff(first), text, at - first[text], begin[at] - offset[text], end[at] - offset[text], term, edits, quoted)


def features(h: Hits, model: Model) -> np.ndarray:
    n = len(h.n_words)
    w = model.weight[h.term] if len(h.term) else np.zeros(0)
    stem, fuzzy = h.term >= len(model.words), h.edits > 0
    short = fuzzy & model.short()[h.term] if len(h.term) else fuzzy
    fuzzy &= ~short
    # Weight of the hits in the window around each hit, itself included.
    place = h.text * (1 << 32) + h.word
    total = np.concatenate([[0.0], np.cumsum(np.where(short, 0.0, w))])
    near = (total[np.searchsorted(place, place + CONTEXT, side="right")]
            - total[np.searchsorted(place, place - CONTEXT, side="left")])

    def sums(mask: np.ndarray, value: np.ndarray) -> np.ndarray:
        return np.bincount(h.text[mask], weights=value[mask], minlength=n)

    def most(mask: np.ndarray, value: np.ndarray) -> np.ndarray:
        out = np.zeros(n)
        np.maximum.at(out, h.text[mask], value[mask])
        return out

    direct = ~stem & ~fuzzy & ~short & ~h.quoted
    length = np.log1p(h.n_words)
    stems = sums(stem & ~h.quoted, w)
    columns = [
        np.log1p(sums(direct, w)), most(direct, near) > 0, np.log1p(sums(fuzzy & ~h.quoted, w)),
        np.log1p(stems), np.log1p(most(stem & ~h.quoted, near)), np.log1p(sums(h.quoted, w)),
        np.log1p(100 * stems / np.maximum(h.n_words, 1)), np.log1p(most(direct, near)), length, length * np.log1p(stems),
        np.log1p(stems) ** 2, np.log1p(sums(short & ~h.quoted, w)), np.ones(n),
    ]
    return np.stack([np.asarray(c, float) for c in columns], axis=1)


def fitted(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1.0, steps: int = 60) -> np.ndarray:
    """Weighted logistic regression with a ridge penalty, Newton's method."""
    b = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge * b
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge)
        move = np.linalg.solve(hess, grad)
        b -= move
        if np.abs(move).max() < 1e-8:
            break
    return b


def lexicon(counts: pd.DataFrame, toxic: int, clean: int) -> Model:
    """All terms that are common enough and tell the classes apart; of stems that begin alike the most significant one."""
    c = counts[counts["toxic"] >= LEAST_DOCS].copy()
    a, b = c["toxic"].to_numpy(float), c["clean"].to_numpy(float)
    c["odds"] = np.log((a + 0.5) / (toxic + 1)) - np.log((b + 0.5) / (clean + 1))
    c["z"] = c["odds"] / np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    c = c[(c["odds"] >= LEAST_ODDS) & (c["z"] >= 3)].sort_values(["z", "term"], ascending=[False, True])
    words = c[~c["stem"]]
    stems, begun = {}, set()
    for r in c[c["stem"]].itertuples():
        beginnings = {r.term[:k] for k in range(1, len(r.term) + 1)}
        if r.term not in begun and not beginnings & stems.keys():
            stems[r.term] = r.odds
            begun |= beginnings
    weight = dict(zip(words["term"], words["odds"]))
    m = Model(words=list(weight), stems=list(stems)).build()
    m.weight = np.array([weight[w] for w in m.words] + [stems[t] for t in m.stems])
    short = [w for w in m.words if len(w) < FUZZY_FROM]
    ordinary = counts[~counts["stem"] & (counts["clean"] >= LEAST_DOCS) & (counts["term"].str.len() <= FUZZY_FROM)]["term"]
    ordinary = sorted(set(ordinary) - set(short))
    if short and ordinary:
        points, offset = _joined(ordinary)
        near = Automaton.of(short, EDITS, False)
        state = near.run(points, offset[:-1], offset[1:] - 1)
        m.known = {ordinary[k] for k in np.flatnonzero(near.term[state] >= 0)}
    return m


def _sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[DataFrame, list[int]]:
    """(text, y) of at most SAMPLE labelled documents of each class, and the labels of each class in all."""
    own = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y")).filter(F.col("y").isin(0, 1))
    total = {r["y"]: r["n"] for r in own.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    some = None
    for y in (0, 1):
        few = own.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
        some = few if some is None else some.unionByName(few)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    # At most 2 * SAMPLE rows of two numbers are broadcast.
    return texts.join(F.broadcast(some), "id").select("text", "y"), [total.get(0, 0), total.get(1, 0)]


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Lexicon and weights from the labelled documents of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    sample, total = _sampled(docs, labels, id_col, text_col, label_col)
    if not all(total):
        return Model().build()

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = {(y, stem): Counter() for y in (0, 1) for stem in (False, True)}
        n = [0, 0]
        for f in frames:
            for t, y in zip(f["text"], f["y"]):
                found = {w for w in WORD.findall(t.lower()) if len(w) > 2}
                seen[y, False].update(found)
                seen[y, True].update({w[:k] for w in found for k in range(STEM[0], min(STEM[1], len(w)) + 1)})
                n[y] += 1
        rows = [(t, stem, k * (y == 1), k * (y == 0)) for (y, stem), c in seen.items() for t, k in c.items()]
        yield pd.DataFrame([*rows, ("", False, n[1], n[0])], columns=["term", "stem", "toxic", "clean"])

    counts = sample.mapInPandas(count, "term string, stem boolean, toxic long, clean long")
    counts = counts.groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # Terms of at least LEAST_DOCS sampled toxic documents, or short ones of as many clean ones: their number follows the sample.
    near_short = ~F.col("stem") & (F.length("term") <= FUZZY_FROM) & (F.col("clean") >= LEAST_DOCS)
    got = counts.filter((F.col("toxic") >= LEAST_DOCS) | near_short | (F.col("term") == "")).toPandas()
    head = got[got["term"] == ""]
    model = lexicon(got[got["term"] != ""], int(head["toxic"].sum()), int(head["clean"].sum()))

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"x": list(features(find(list(f["text"]), model), model)), "y": f["y"].to_numpy()})

    got = sample.mapInPandas(rows, "x array<double>, y int").toPandas()
    if got["y"].nunique() < 2:
        return Model().build()
    x, y = np.stack(got["x"].to_list()), got["y"].to_numpy(float)
    share = np.where(y == 1, total[1] / (y == 1).sum(), total[0] / (y == 0).sum())
    model.coef = fitted(x, y, share * len(y) / share.sum())
    return model


def scored(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns unless given) with score and hits: places (characters), terms, edits, inside quotation marks."""
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def score(texts: list[str | None]) -> list[list]:
        m, out, places = sent.value, [], []
        frame = pd.DataFrame(index=range(len(texts)))
        for _, some in chunks(frame, [t or "" for t in texts], SLICE):
            if m.coef is None:
                out += [0.5] * len(some)
                places += [[]] * len(some)
                continue
            h = find(some, m)
            out += (1 / (1 + np.exp(-np.clip(features(h, m) @ m.coef, -30, 30)))).tolist()
            own: list[list] = [[] for _ in some]
            terms = m.words + [s + "*" for s in m.stems]
            for i, b, e, t, k, q in zip(*(a.tolist() for a in (h.text, h.begin, h.end, h.term, h.edits, h.quoted))):
                own[i].append({"begin": b, "end": e, "term": terms[t], "edits": k, "quoted": q})
            places += own
        return [out, places]

    return computed(docs, [F.col(f"`{text_col}`").cast("string")], score, MADE, keep)


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id's digits, modulo 3; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3, F.lit(0))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = learn(docs, labels.filter(fold() != 1))
    out = scored(docs, model, keep=["doc_id"])
    return out.select("doc_id", (fold() == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def filtered(docs: DataFrame, labels: DataFrame, all_docs: DataFrame | None = None) -> DataFrame:
    """``docs`` that are not predicted toxic, same columns. The model is learned from ``all_docs`` (``docs`` unless given)."""
    names = {c: fresh(c) for c in docs.columns}
    model = learn(docs if all_docs is None else all_docs, labels)
    out = scored(docs.toDF(*names.values()), model, names["text"])
    return out.filter(F.col("score") < THRESHOLD).select(*[F.col(v).alias(c) for c, v in names.items()])
