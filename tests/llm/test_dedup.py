"""Substring, byte and near-duplicate operators, decontamination: brute force on small tables, odd rows, several runs."""

import numpy as np
import odd
import pytest
from conftest import SF

from churnspark.llm import bayes_join, decontaminate, shared_bytes, substrings
from churnspark.llm import textcode as tc


def cell(v):
    return (v is None, v)


def same(got, want):
    assert sorted(map(lambda r: tuple(map(cell, r)), got)) == sorted(map(lambda r: tuple(map(cell, r)), want))


def letters(seed, n=60, most=160):
    """Documents of few words, so that everything repeats somewhere."""
    rng = np.random.default_rng(seed)
    pool = [" ".join(f"{'abcde'[k]}{k}" for k in rng.integers(0, 5, rng.integers(5, 40))) for _ in range(12)]
    out = []
    for d in rng.permutation(n).tolist():
        out.append((d, " ".join(pool[k] for k in rng.integers(0, 12, rng.integers(0, 4))) or None, "en", "s"))
    return out


@pytest.fixture(params=[0, 1])
def crowded(request, spark):
    return spark.createDataFrame(odd.rows(letters(request.param)), odd.SCHEMA).repartition(4)


@pytest.fixture
def small_runs(monkeypatch):
    """Several runs in a task; the workers are forked with these values only if they start after, so tasks get them as well."""
    monkeypatch.setattr(substrings, "RUN_BYTES", 2000)
    monkeypatch.setattr(shared_bytes, "RUN_BYTES", 2000)


def test_repeats_are_those_of_brute_force(crowded):
    same([tuple(r) for r in substrings.digest(crowded).collect()], odd.repeats(odd.pairs(crowded)))


def test_repeats_odd_rows(spark):
    docs = odd.documents(spark)
    same([tuple(r) for r in substrings.digest(docs).collect()], odd.repeats(odd.pairs(docs)))
    assert substrings.digest(odd.empty(spark)).count() == 0
    out = substrings.filtered(docs)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    kept = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert (4, None) in kept and (5, "") in kept and (2, odd.documents(spark).filter("doc_id = 1").first()["text"]) not in kept


def test_entries_of_several_runs(spark):
    """The steps themselves, with runs of a few texts, against the whole table."""
    import pandas as pd

    docs = [(d, t) for d, t, _, _ in letters(7, n=80)]
    frame = pd.DataFrame({"doc": [d for d, _ in docs], "key": range(len(docs)), "text": [t for _, t in docs]})
    entries = []
    for k in range(0, len(docs), 9):
        entries += list(substrings._entries(iter([frame.iloc[k:k + 9]]), 20, 5))
    entries = pd.concat(entries, ignore_index=True)
    repeats = pd.concat([substrings._repeats(e) for _, e in entries.groupby("part")], ignore_index=True)
    got = pd.concat([substrings._intervals(r, 20) for _, r in repeats.groupby("run")], ignore_index=True)
    removed = {int(d): int((np.frombuffer(e, np.uint32).astype(int) - np.frombuffer(b, np.uint32)).sum())
               for d, b, e in zip(got["doc"], got["begins"], got["ends"])}
    assert removed == {d: n for d, _, n, _ in odd.repeats(docs) if n}


def test_shared_bytes_are_those_of_brute_force(crowded):
    same([tuple(r) for r in shared_bytes.digest(crowded).collect()], odd.shared(odd.pairs(crowded)))


def test_shared_bytes_odd_rows(spark):
    docs = odd.documents(spark)
    same([tuple(r) for r in shared_bytes.digest(docs).collect()], odd.shared(odd.pairs(docs)))
    assert shared_bytes.digest(odd.empty(spark)).count() == 0


def test_shared_bytes_of_several_runs_and_slices(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(shared_bytes, "SLICE", 700)
    docs = [(d, t) for d, t, _, _ in letters(9, n=80)]
    frame = pd.DataFrame({"doc": [d for d, _ in docs], "key": range(len(docs)), "text": [t for _, t in docs]})
    runs = pd.concat([r for k in range(0, len(docs), 9) for r in shared_bytes._runs(iter([frame.iloc[k:k + 9]]))], ignore_index=True)
    codes = pd.concat(list(shared_bytes._codes(iter([runs]), 3)), ignore_index=True)
    states = pd.concat([shared_bytes._states(c) for _, c in codes.groupby("part")], ignore_index=True)
    shards = pd.concat([shared_bytes._shards(r, states[states["run"] == name], 3) for name, r in runs.groupby("run")], ignore_index=True)
    merged = pd.concat([shared_bytes._merged(s) for _, s in shards.groupby("part")], ignore_index=True)
    assert len(merged)  # the merge itself finds strings, not only the copies
    verdicts = pd.concat([states, merged], ignore_index=True)
    got = []
    for name, r in runs.groupby("run"):
        got += [(d, n, g, len(b), odd.sha(kept)) for d, _, n, g, b, _, kept in shared_bytes._results(r, verdicts[verdicts["run"] == name], 3)]
    same(got, odd.shared(docs))


def test_decontamination_is_that_of_brute_force(spark):
    docs = odd.documents(spark)
    base = docs.filter("doc_id = 1").first()["text"]
    items = [(1, base), (2, "One, TWO!"), (3, None), (4, "  "), (None, "wizards brew strange"), (10, "élan vital ünd so"), (2, "one two")]
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, items string")
    same([tuple(r) for r in decontaminate.digest(docs, table).collect()], odd.hits(odd.pairs(docs), items))
    found = decontaminate.matches(docs, table).filter("doc_id = 3").first()
    text = docs.filter("doc_id = 3").first()["text"]
    assert text[found["spans"][0]["begin"]:found["spans"][0]["end"]] == base
    assert decontaminate.digest(odd.empty(spark), table).count() == 0
    assert decontaminate.digest(docs, table.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.filtered(docs, table).columns == docs.columns


def test_decontamination_with_several_automata(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = sorted(map(tuple, decontaminate.digest(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "MOST_CHARS", 20_000)
    assert len(list(decontaminate.pattern_sets(items, "item_id", "text", 13))) > 2
    assert sorted(map(tuple, decontaminate.digest(docs, items).collect())) == want


def test_least_matches_is_the_posterior_rule():
    needed = bayes_join.least_matches(0.8, 1e-7)
    assert len(needed) == bayes_join.HASHES // bayes_join.STEP and needed == sorted(needed)
    # Numerical integral of the Beta posterior.
    x = np.linspace(0.8, 1, 200_001)
    for k, m in enumerate(needed):
        n = (k + 1) * bayes_join.STEP
        full = np.linspace(0, 1, 200_001)

        def area(at, m):
            return np.trapezoid(at**m * (1 - at) ** (n - m), at)

        assert area(x, m) / area(full, m) >= 0.99e-7
        assert m == 0 or area(x, m - 1) / area(full, m - 1) < 1.01e-7


def near_copies(seed, n=50):
    rng = np.random.default_rng(seed)
    bases = [[f"t{k}" for k in rng.integers(0, 5000, rng.integers(1, 120))] for _ in range(8)]
    out = []
    for d in range(n):
        words = list(bases[rng.integers(0, 8)])
        for _ in range(rng.integers(0, 3)):
            words[rng.integers(0, len(words))] = f"t{rng.integers(0, 5000)}"
        out.append((d, " ".join(words) if rng.random() > 0.1 else " ".join(words).upper(), "en", "s"))
    return out


def links(df):
    return {(r["doc_id"], r["text"]): (r["class_id"], r["n_links"], r["copy_id"], r["copies"]) for r in df.collect()}


def joined_with_text(docs):
    from pyspark.sql import functions as F

    from churnspark.llm.tables import keyed

    out = bayes_join.join(docs)
    k = keyed(docs).dropDuplicates(["doc", "key"])
    return out.join(k, ["doc", "key"]).select(F.when(F.col("doc") < 2**63 - 1, F.col("doc")).alias("doc_id"), "text", "class_id",
                                              "n_links", "copy_id", "copies")


@pytest.mark.parametrize("seed", [0, 1])
def test_jaccard_join_is_that_of_brute_force(spark, seed, monkeypatch):
    if seed:  # many blocks
        monkeypatch.setattr(bayes_join, "BLOCK_BUCKET", 3)
        monkeypatch.setattr(bayes_join, "BLOCK_SHINGLES", 200)
    docs = spark.createDataFrame(odd.rows(near_copies(seed)), odd.SCHEMA).repartition(3)
    assert links(joined_with_text(docs)) == odd.joined(odd.pairs(docs))


def test_jaccard_join_odd_rows(spark):
    docs = odd.documents(spark)
    assert links(joined_with_text(docs)) == odd.joined(odd.pairs(docs))
    assert bayes_join.digest(docs).count() == docs.count()
    assert bayes_join.digest(odd.empty(spark)).count() == 0
    assert bayes_join.filtered(odd.empty(spark)).count() == 0
    kept = [(r["doc_id"], r["text"]) for r in bayes_join.filtered(docs).collect()]
    want = odd.joined(odd.pairs(docs))
    groups = {v[0] for k, v in want.items() if odd.shingles(k[1])}
    assert sorted(odd.order(d) for d, t in kept if odd.shingles(t)) == sorted(groups)
    assert sum(1 for _, t in kept if not odd.shingles(t)) == sum(1 for _, t in odd.pairs(docs) if not odd.shingles(t))


def test_unlike_texts_without_or_with_one_id_stay(spark):
    def text(k):
        return " ".join(f"w{k}x{i}" for i in range(30))

    rows = [(None, text(0)), (None, text(1)), (None, text(2)), (None, text(2)), (7, text(3)), (7, text(4)), (8, text(4)), (9, text(4) + " end"),
            (None, text(5)), (10, text(5) + " end"), (None, None), (None, "")]
    docs = spark.createDataFrame(odd.rows([(d, t, "en", "a") for d, t in rows]), odd.SCHEMA).repartition(3)
    kept = sorted(odd.pairs(bayes_join.filtered(docs)), key=str)
    want = [(None, text(0)), (None, text(1)), (None, text(2)), (7, text(3)), (7, text(4)), (10, text(5) + " end"), (None, None), (None, "")]
    assert kept == sorted(want, key=str)
    classes = bayes_join.digest(docs).filter("n_links > 0 or class_id = 9223372036854775807 or doc_id = 7").select("class_id", "class_key")
    assert classes.distinct().count() == 8


def test_signature_bands_find_pairs_at_the_threshold():
    """Sets with similarity of just 0.8 share a band, in 200 trials."""
    rng = np.random.default_rng(5)
    for _ in range(200):
        union = rng.integers(0, 2**63, 250, dtype=np.uint64)
        a, b = bayes_join.signatures([np.sort(union[:225]), np.sort(union[25:])])
        assert (a == b).reshape(-1, bayes_join.ROWS).all(1).any()


def test_word_codes_do_not_depend_on_the_batch():
    texts = tc.encoded(["a b c d e f", None, "", "c d e f g", "ä ö ü ß x"])
    whole = tc.Words(texts)
    alone = [tc.Words([t]).code.tolist() for t in texts]
    assert [whole.code[a:b].tolist() for a, b in zip(whole.first[:-1], whole.first[1:])] == alone
    assert len(set(whole.windows(4)[0].tolist())) == len({tuple(t.split()[i:i + 4]) for t in texts for i in range(len(t.split()) - 3)})
