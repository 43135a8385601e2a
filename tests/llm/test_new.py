"""Conversation repair, sharding and resampling against brute force on small and odd tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import odd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.llm import mixing, repair, resampling, sharding

# ---- conversation repair -------------------------------------------------------------------------------------------

TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                      T.StructField("text", T.StringType()),
                      *[T.StructField(n, T.StringType()) for n in ("conv", "part", "place", "fault", "m", "state", "code", "edit")]])
BLANKS = " \t\n\x0b\x0c\r"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def crc(key):
    return zlib.crc32(key.encode())


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = crc(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}") % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(facts):
    """Least (cost, audit) over all edits, forward over the role of the last turn."""
    def inserted(ways):
        for _ in range(4):
            for last, (cost, audit) in list(ways.items()):
                new = NEXT[last]
                ways[new] = min(ways.get(new, (10**9, "")), (cost + 2, audit + "I"))
        return ways

    ways = {"": (0, "")}
    for initial, fault in facts:
        new = {}
        for last, (cost, audit) in inserted(dict(ways)).items():
            options = [(last, cost + 3, "D")]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if initial and (initial == NEXT[last] or (initial == "s" and last == "")):
                    options.append((initial, cost + extra, "K"))
                options.append((NEXT[last], cost + 2 + extra, "R"))
            for state, c, letter in options:
                new[state] = min(new.get(state, (10**9, "")), (c, audit + letter))
        ways = new
    ways = inserted(dict(ways))
    return min(ways[x] for x in ("", "a") if x in ways)


def plain_repair(original, rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r[1:])
    out = {}
    for conv in {r[0] for r in original}:
        mine = sorted(groups[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), odd.sha(f"{len(r[1])}:{r[1]}:{r[2]}".encode())))
        seen, facts = set(), []
        for _, role, text in mine:
            bare = text.translate({ord(b): None for b in BLANKS})
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            facts.append((role[:1], fault))
        cost, audit = cheapest(facts)
        keep = len(audit) - audit.count("D")
        lines, left = [], iter(mine)
        for letter in audit:
            row = None if letter == "I" else next(left)
            if letter != "D":
                due = ("user", "assistant")[(len(lines) - keep % 2) % 2]
                lines.append(f"{row[1] if letter == 'K' else due}:{'' if letter == 'I' else row[2]}")
        known = {r[0] for r in mine if r[0] is not None}
        pairs = [a[0] + b[0] for a, b in zip(facts, facts[1:])]
        out[conv] = (max(known) - min(known) + 1 - len(known) if known else 0, *[sum(f == k for _, f in facts) for k in ("blank", "duplicate", "truncated")],
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, odd.sha("\n".join(lines).encode()))
    return out


def conversations(spark, seed=3, long=700):
    rng = np.random.Generator(np.random.PCG64(seed))
    words = ["Yes.", "no", "Why? ", " ", "", "Sure!\n", "é日本.", "ok ok", None, "a\u0000b."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "User", None, "s"]
    rows = []
    for conv in [*range(40), None, -3]:
        for turn in range(rng.integers(0, 9)):
            rows.append((conv, None if rng.random() < .1 else int(turn), roles[rng.integers(0, 10)], words[rng.integers(0, 10)]))
    for turn in range(long):  # many blocks
        rows.append((1000, turn, roles[rng.integers(0, 5)], f"turn {turn // 3}" + ".!"[turn % 2] * (turn % 5 > 0)))
    rows += [(2000, 5, "user", "same.")] * 60 + [(2000, 6, "assistant", "other.")] * 3 + [(3000, 1, "user", "long " * 200_000)]
    return rows


def table(spark, rows, partitions=4):
    return spark.createDataFrame([(*r, *["x"] * 8) for r in rows], TURNS).repartition(partitions)


def result(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("damage", [True, False])
def test_repair_as_brute_force(spark, monkeypatch, damage):
    monkeypatch.setattr(repair, "ROWS", 16)  # conversations over several blocks and parts
    rows = conversations(spark)
    want = plain_repair(rows, plain_damage(rows) if damage else [(c, t, *(" " if x is None else x for x in r)) for c, t, *r in rows])
    df = repair.digest(table(spark, rows), damage)
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = result(df)
    assert got == want
    assert sum(len(v[6]) for v in got.values()) > 700


def test_repaired_turns_are_right(spark):
    rows = conversations(spark, 9, 50)
    made = repair.repaired(table(spark, rows)).orderBy("part", "place", "position").collect()
    groups = defaultdict(list)
    for r in made:
        groups[r.conv_id].append(r)
    assert len(groups) > 20
    for some in groups.values():
        assert re.fullmatch("s?(ua)+", "".join(r.role[0] for r in some))
        assert all((r.text == "" and r.turn is None) == (r.edit == "I") for r in some if r.edit == "I")
        assert {r.edit for r in some} <= set("KRI")


def test_repair_of_nothing(spark):
    assert repair.digest(table(spark, [], 1)).collect() == []
    gone = next(i for i in range(1000) if crc(f"{i}:0") % 20 == 0)
    assert result(repair.digest(table(spark, [(gone, 0, "user", "Hi.")], 1))) == {gone: (0, 0, 0, 0, 0, 0, "", odd.sha(b""))}


def test_checkpoints_change_nothing():
    rng = np.random.Generator(np.random.PCG64(1))
    for _ in range(300):
        rows = [("suat"[rng.integers(0, 4)], rng.random() < .2, rng.random() < .3) for _ in range(rng.integers(1, 40))]
        facts = [(i, "blank" if gone else "truncated" if broken else None) for i, gone, broken in rows]
        found = list(repair.edits(rows, repair.END, repair.START, True))
        assert (repair.times(repair.matrix(rows), repair.END)[0], "".join(x for x, _, _ in found)) == cheapest(facts)


# ---- sharding ------------------------------------------------------------------------------------------------------


def test_shards_of_odd_rows(spark):
    docs = odd.documents(spark)
    got = sharding.digest(docs).collect()
    assert Counter(got) == Counter(sharding.digest(docs.repartition(7)).collect())
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(16))
    for shard, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    texts = [(d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in odd.pairs(docs)]
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(texts)
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    assert sharding.digest(odd.empty(spark)).count() == 0


def test_rows_come_back_whole(spark, tmp_path):
    docs = odd.documents(spark).withColumn("shard", F.lit("old"))
    out = sharding.sharded(docs, 3)
    names = [c for c in docs.columns if c != "shard"]
    assert Counter(map(str, out.select(names).collect())) == Counter(map(str, docs.select(names).collect()))
    sharding.write_shards(docs, str(tmp_path / "shards"), 3)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(r[0] for r in back.groupBy("shard").count().select("count").collect()) == [7, 7, 7]


def test_one_row_many_times(spark):
    docs = spark.range(20_000).select(F.lit(7).alias("doc_id"), F.lit("same text").alias("text"))
    got = sharding.digest(docs).groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("m")).collect()
    assert [(r.n, r.d, r.m) for r in got] == [(1250, 1250, 1249)] * 16


def test_variates_follow_the_law(spark):
    rows = spark.range(4000).repartition(8)
    for total, marked, drawn in ((100, 30, 20), (9, 9, 4), (5, 0, 3), (40, 2, 39), (1, 1, 1), (0, 0, 0)):
        x = sharding.variate(F.lit(total), F.lit(marked), F.lit(drawn), F.rand(total))
        got = {r[0]: r[1] for r in rows.select(x.alias("x")).groupBy("x").count().collect()}
        law = {k: math.comb(marked, k) * math.comb(total - marked, drawn - k) / math.comb(total, drawn)
               for k in range(max(0, drawn + marked - total), min(marked, drawn) + 1)}
        assert set(got) <= set(law)
        chi = sum((got.get(k, 0) - 4000 * p) ** 2 / (4000 * p) for k, p in law.items())
        assert chi < 3 * len(law) + 20, (total, marked, drawn, chi)


def test_matrix_has_its_margins(spark):
    sizes = {0: 7, 1: 0, 2: 31, 3: 1, 4: 90, 5: 12, 6: 3, 7: 5}
    df = spark.createDataFrame([(p, n) for p, n in sizes.items() if n], "part long, n long")
    tall = Counter()
    for seed in range(12):
        got = {r.part: r.counts for r in sharding.matrix(df, 8, 4, f"seed {seed}").collect()}
        assert {p: sum(c) for p, c in got.items()} == sizes
        assert [sum(c[s] for c in got.values()) for s in range(4)] == [38, 37, 37, 37]
        tall.update({s: got[4][s] for s in range(4)})
    assert all(abs(tall[s] - 12 * 90 / 4) < 60 for s in range(4))


# ---- resampling ----------------------------------------------------------------------------------------------------


def plain_resampling(docs, target, least=20, percent=10):
    words = [odd.plain_words(t) for _, t in docs]
    s = Counter(zlib.crc32(w) % 10_000 for ws in words for w in ws)
    t = Counter(zlib.crc32(w) % 10_000 for x in target for w in odd.plain_words(x))
    up, down = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    gain = {b: math.floor(1000 * math.log(float((t[b] + 1) * up) / float((s[b] + 1) * down))) for b in s}
    rows = []
    for (d, _), ws in zip(docs, words):
        h = int(odd.sha(f"2024:{'' if d is None else d}".encode())[:8], 16)
        weight = sum(gain[zlib.crc32(w) % 10_000] for w in ws)
        rows.append((d, len(ws), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    drawn = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    quota = percent * len(drawn) // 100
    return rows, drawn[:quota]


def test_resampling_as_brute_force(spark):
    more = [(100 + i, f"alpha beta {i} " * (i % 30), "en", "z") for i in range(150)]
    docs = odd.documents(spark).unionByName(spark.createDataFrame(odd.rows(more), odd.SCHEMA))
    target = spark.createDataFrame([(1, "Quick alpha fox 3"), (2, None), (3, "")], "item_id long, text string")
    rows, drawn = plain_resampling(odd.pairs(docs), ["Quick alpha fox 3", None, ""])
    got = resampling.digest(docs, target).collect()
    assert Counter(tuple(r)[:4] for r in got) == Counter(rows)
    assert [tuple(r)[:4] for r in sorted((r for r in got if r.rank), key=lambda r: r.rank)] == drawn
    assert sorted(r.rank for r in got if r.rank) == list(range(1, len(drawn) + 1)) and len(drawn) > 5
    taken = resampling.resampled(docs, target)
    assert [c for c in docs.columns if c not in ("n_words", "score", "rank")] == [c for c in taken.columns if c not in ("n_features", "weight", "score", "rank")]
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.score) for r in taken.collect()) == sorted((d is not None, d or 0, x) for d, _, _, x in drawn)


def test_resampling_of_nothing(spark):
    target = spark.createDataFrame([], "item_id long, text string")
    assert resampling.digest(odd.empty(spark), target).collect() == []
    got = resampling.digest(odd.documents(spark), target, percent=100)
    assert got.filter("rank IS NOT NULL").count() == got.filter("n_features >= 20").count()


def test_checksums_by_length():
    rng = np.random.Generator(np.random.PCG64(2))
    letters = ["a", "é", "Z", "9", " ", "-", "日", "\n", "bb", "c" * 13]
    texts = ["".join(letters[i] for i in rng.integers(0, 10, rng.integers(0, 60))) for _ in range(60)] + ["", "q" * 3000, "日本"]
    raw = [t.encode() for t in texts]
    for most in (1, 2, 3):
        words, data, begin, end, text = resampling.word_runs(raw, most)
        want = Counter()
        for i, t in enumerate(texts):
            ws = odd.plain_words(t)
            assert words[i] == len(ws)
            want.update((i, zlib.crc32(b" ".join(ws[j:j + n]))) for n in range(1, most + 1) for j in range(len(ws) - n + 1))
        assert Counter(zip(text.tolist(), resampling.checksums(data, begin, end).tolist())) == want


# ---- mixing: the whole order counts ------------------------------------------------------------------------------------


def test_one_long_document_leaves_no_open_words(spark):
    """A document larger than what is open stops nobody: the source ends within its smallest document of the target."""
    texts = [(k, "word " * 40, "en", "a") for k in range(200)] + [(500, "long " * 20_000, "en", "a")]
    texts += [(1000 + k, "ten " * 10, "en", "b") for k in range(100)]
    rows = mixing.digest(spark.createDataFrame(odd.rows(texts), odd.SCHEMA)).collect()
    for source in {r.source_size for r in rows}:
        mine = [r for r in rows if r.source_size == source]
        gap = mine[0].target - sum(r.taken for r in mine)
        room = [r.size for r in mine if r.taken < 3 * r.size]
        assert gap >= -1e-6 and (not room or gap < min(room))


def test_shares_follow_the_inclusion_odds(spark):
    """Documents of one size: over seeds each is taken as often as its source's share of open words says."""
    texts = [(k, "w " * 5, "en", "a") for k in range(60)] + [(100 + k, "w " * 5, "en", "b") for k in range(40)]
    docs = spark.createDataFrame(odd.rows(texts), odd.SCHEMA)
    taken, share = Counter(), {}
    for seed in range(6):
        for u in mixing.plan(docs, seed=seed).collect():
            taken[u.source] += u.whole + u.m
            share[u.source] = u.target / u.source_size
    assert taken["a"] / 360 == pytest.approx(share["a"], abs=0.02) and taken["b"] / 240 == pytest.approx(share["b"], abs=0.02)
