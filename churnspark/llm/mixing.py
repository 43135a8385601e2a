"""Mixing sources to target weights: certain whole copies, then Pareto order sampling of the rest.

Sizes are words. The sources' targets share the words of all documents by weight, stop at ``cap`` times the source's size
and pass what is left on by weight (water filling). A document of a source with target / size = f is taken floor(f) times for
certain and once more with probability f - floor(f). Pareto order sampling decides about that copy: documents are ranked by
random odds u / (1 - u) over inclusion odds p / (1 - p), and the first ones are taken until their sizes fill the source's
open words. Where a document does not fit into what is left, the order goes on with those that do, and when none without
an extra copy fits, begins again with second extra ones (up to ``cap`` copies in all), until nothing with copies left fits.
Nothing but the order and the open words decides, so a source ends less than its smallest such document below its target.

The order of a source is never sorted as a whole: sizes are summed by rank bin, the bin in which the quota is reached is
split again, three times 1024-fold, and only the few documents of the last bin are ordered. What stays open is filled in slices
of the order that one task per source walks as a stream. A source with a third of all rows is summed map-side like any other.
Equal rows (id, source, text) are one unit with a count.

Random numbers depend on the id and the seed alone, so reruns agree. Null texts and texts without words have size 0 and are
never taken; a null source is a source of its own, after all others; null ids are the same id.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from churnspark.functions.columns import hash_fraction
from churnspark.llm.tables import fresh, text_key, written

WEIGHTS = (1, 2, 3)
CAP = 3
SEED = 42
BINS, LEVELS = 1024, 3
# Candidates of a source that one task walks at a time, about. Steers the work only: the order goes on in the next slice.
SLICE = 1 << 16
WALKED = ["sid", "doc", "key", "size", "m", "gap"]
WALKED_SCHEMA = "sid int, doc string, key long, size long, m long, gap double"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(units: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source: sid, source, source_size, target, whole (certain copies), open (words left), p."""
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    s = units.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    s = s.withColumn("sid", F.row_number().over(by_name))
    s = s.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") - 1) % len(weights) + 1).cast("long"))
    order = W.orderBy(F.col("source_size") * cap / F.col("w"), "sid")
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    most = F.col("source_size") * cap
    level = (F.sum("source_size").over(W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
             - F.coalesce(F.sum(most).over(before), F.lit(0))) / F.sum("w").over(after)
    s = s.withColumn("level", level).withColumn("full", most < F.col("level") * F.col("w"))
    # From the first source that stays below its stop, all share one level.
    share = F.min(F.when(~F.col("full"), F.struct((most / F.col("w")).alias("k"), "sid", "level")))
    s = s.withColumn("share", share.over(W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    s = s.withColumn("target", F.when(F.col("full"), most.cast("double")).otherwise(F.col("w") * F.col("share.level")))
    s = s.withColumn("target", F.least("target", most.cast("double")))
    some = F.col("source_size") > 0
    f = F.when(some, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(f).cast("long")
    return s.select("sid", "source", "source_size", "target", whole.alias("whole"),
                    (F.col("target") - whole * F.col("source_size")).alias("open"), (f - whole).alias("p"))


def _crossing(units: DataFrame, state: DataFrame, level: int) -> DataFrame:
    """Per source the bin of this level in which the open words are reached, and the words before it."""
    mine = units.join(state, "sid").filter(F.floor(F.col("rank") * BINS ** (level - 1)) == F.col("bin"))
    bins = mine.groupBy("sid", "quota", "base", F.floor(F.col("rank") * BINS ** level).alias("next")).agg(
        F.sum(F.col("n") * F.col("size")).alias("words"))
    upto = F.sum("words").over(W.partitionBy("sid").orderBy("next")) + F.col("base")
    bins = bins.withColumn("upto", upto).filter(F.col("upto") > F.col("quota"))
    first = F.min(F.struct("next", (F.col("upto") - F.col("words")).alias("base")))
    return bins.groupBy("sid", "quota").agg(first.alias("f")).select("sid", "quota", F.col("f.next").alias("bin"), F.col("f.base").alias("base"))


def _picked(units: DataFrame, sources: DataFrame) -> DataFrame:
    """``units`` with m, the rows of the unit that get one more copy: a prefix of the Pareto order."""
    state = sources.select("sid", F.col("open").alias("quota"), F.lit(0).cast("long").alias("bin"), F.lit(0).cast("long").alias("base"))
    for level in range(1, LEVELS + 1):
        # Written, so that Spark knows how small it is and does not deal the units out by source.
        state = written(_crossing(units, state, level).coalesce(1), "crossing")
    leaf = F.floor(F.col("rank") * BINS ** LEVELS)
    rows = units.join(state, "sid", "left")
    inside = rows.filter(leaf == F.col("bin"))
    upto = F.sum(F.col("n") * F.col("size")).over(W.partitionBy("sid").orderBy("rank", "doc", "key"))
    left = F.col("quota") - (F.col("base") + upto - F.col("n") * F.col("size"))
    fit = F.greatest(F.lit(0), F.least(F.col("n"), F.floor(left / F.col("size")))).cast("long")
    outside = rows.filter(F.col("bin").isNull() | (leaf != F.col("bin")))
    # Without a crossing bin the whole source fits into its open words (up to rounding), if any are open.
    all_or_none = F.when(F.coalesce(leaf < F.col("bin"), F.col("p") > 0), F.col("n")).otherwise(0).cast("long")
    return inside.withColumn("m", fit).unionByName(outside.withColumn("m", all_or_none)).drop("bin", "base", "quota")


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Units in order of (sid, Pareto order): m copies of each that fit into the gap; per source a last row with the gap left."""
    sid, gap = None, 0.0
    for rows in batches:
        out = []
        for s, doc, key, size, n, open_words in rows[["sid", "doc", "key", "size", "n", "gap"]].itertuples(index=False):
            if s != sid:
                if sid is not None:
                    out.append((sid, None, 0, 0, 0, gap))
                sid, gap = s, open_words
            m = min(n, int(gap // size))
            if m:
                gap -= m * size
                out.append((sid, doc, key, size, m, None))
        yield pd.DataFrame(out, columns=WALKED)
    if sid is not None:
        yield pd.DataFrame([(sid, None, 0, 0, 0, gap)], columns=WALKED)


def _ends(some: DataFrame) -> DataFrame:
    """Per source the rank at which the first ``SLICE`` or so of its candidates end (u is uniform), null if it has no more."""
    first = some.groupBy("sid", "p").agg(F.count(F.lit(1)).alias("units"), F.min("u").alias("u"))
    upto = F.col("u") + (1 - F.col("u")) * (SLICE / F.col("units"))
    return first.select("sid", F.when(F.col("units") > SLICE, _rank(upto, F.col("p"))).alias("end"))


def _extra(ranked: DataFrame, sources: DataFrame, cap: int) -> DataFrame:
    """(sid, doc, key, size, more): copies beyond the certain ones, in Pareto order, until nothing that is left fits.

    Rank bins find the prefix that fits as a whole; what stays open is then less than the one document that ended it. The
    order goes on from there with those that still fit, a slice at a time: what a slice does not take no longer fits, so few
    of the documents after it still do, and a handful of slices is enough for any number of documents.
    """
    unit = ["sid", "doc", "key", "size"]
    open_units = ranked.filter((F.col("size") > 0) & (F.col("p") > 0) & (F.col("whole") < cap))
    gap = sources.filter(F.col("p") > 0).select("sid", F.col("open").alias("gap"))
    some = open_units.join(gap, "sid").filter(F.col("size") <= F.col("gap")).drop("gap")
    taken = written(_picked(some, gap.select("sid", F.col("gap").alias("open"))), "picks")
    used = taken.groupBy("sid").agg(F.sum(F.col("m") * F.col("size")).alias("used"))
    gap = written(gap.join(used, "sid", "left").select("sid", (F.col("gap") - F.coalesce("used", F.lit(0))).alias("gap"))
                  .coalesce(1), "gap")
    picks = taken.filter("m > 0").select(*unit, "m")
    some = taken.filter("m < n").withColumn("n", F.col("n") - F.col("m")).drop("m")
    for copy in range(cap):
        if copy:  # What was not taken in an earlier turn did not fit and does not fit now.
            some = open_units.filter(F.col("whole") + copy < cap)
        while True:
            some = written(some.join(gap, "sid").filter(F.col("size") <= F.col("gap")).drop("gap"), "candidates")
            ends = written(_ends(some).coalesce(1), "ends")
            if ends.isEmpty():
                break
            now = some.join(ends, "sid").filter(F.col("end").isNull() | (F.col("rank") <= F.col("end"))).join(gap, "sid")
            dealt = now.repartition("sid").sortWithinPartitions("sid", "rank", "doc", "key")
            walked = written(dealt.select(*unit, "n", "gap").mapInPandas(_walk, WALKED_SCHEMA), "walked")
            left = walked.filter("doc IS NULL").select("sid", F.col("gap").alias("left"))
            gap = written(gap.join(left, "sid", "left").select("sid", F.coalesce("left", "gap").alias("gap")).coalesce(1), "gap")
            picks = picks.unionByName(walked.filter("doc IS NOT NULL").select(*unit, "m"))
            some = some.join(ends, "sid").filter(F.col("rank") > F.col("end")).drop("end")
            if ends.filter(F.col("end").isNotNull()).isEmpty():
                break
    return picks.groupBy(*unit).agg(F.sum("m").alias("more"))


def _rank(u: Column, p: Column) -> Column:
    odds = (u / (1 - u)) / (p / (1 - p))
    return F.when(p > 0, odds / (1 + odds)).otherwise(0.0)


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per unit of equal rows: doc, key, source, n, size, source_size, target, whole, m.

    Every row of the unit is taken ``whole`` times; ``m`` more copies are dealt out over its ``n`` rows in turn.
    """
    doc = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    rows = docs.select(doc.alias("doc"), F.coalesce(text_key(text_col), F.lit(0)).alias("key"),
                       F.col(f"`{source_col}`").cast("string").alias("source"), words(F.col(f"`{text_col}`")).alias("size"))
    units = written(rows.groupBy("doc", "key", "source", "size").agg(F.count(F.lit(1)).alias("n")), "units")
    sources = written(targets(units, weights, cap), "sources")
    all_units = units.join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    u = hash_fraction(F.col("doc"), seed)
    ranked = written(all_units.withColumn("u", u).withColumn("rank", _rank(F.col("u"), F.col("p"))), "ranked")
    more = _extra(ranked, sources, cap).select(*[F.col(c).alias(f"x_{c}") for c in ("sid", "doc", "key", "size")], "more")
    own = [F.col(c) == F.col(f"x_{c}") for c in ("sid", "doc", "key", "size")]
    return ranked.join(more, own, "left").select("doc", "key", "source", "n", "size", "source_size", "target", "whole",
                                                 F.coalesce("more", F.lit(0)).cast("long").alias("m"))


def digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per document."""
    units = plan(docs, **options)
    each = units.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("nth"))
    copies = F.col("whole") + F.floor(F.col("m") / F.col("n")) + (F.col("nth") <= F.col("m") % F.col("n")).cast("long")
    return each.select(F.when(F.col("doc") != "", F.col("doc")).cast("long").alias("doc_id"), "size", "source_size", "target",
                       (F.col("size") * copies).alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` that the mix takes at least once, with ``copies``, the times it takes them (a column of that name goes)."""
    names = {c: fresh(c) for c in docs.columns if c != "copies"}
    rows = docs.drop("copies").toDF(*names.values())
    units = plan(rows, id_col=names["doc_id"], text_col=names["text"], source_col=names["source"], **options)
    doc = F.coalesce(F.col(names["doc_id"]).cast("string"), F.lit(""))
    key = F.coalesce(text_key(names["text"]), F.lit(0))
    both = rows.join(units.select("doc", "key", F.col("source").alias("unit_source"), "n", "whole", "m"),
                     (doc == F.col("doc")) & (key == F.col("key"))
                     & F.col(names["source"]).cast("string").eqNullSafe(F.col("unit_source")))
    part = F.col("m") % F.col("n") > 0  # at most a few units of equal rows in each source
    nth = F.row_number().over(W.partitionBy("doc", "key", "unit_source").orderBy(F.lit(1)))
    every = F.col("whole") + F.floor(F.col("m") / F.col("n"))
    out = both.filter(~part).withColumn("copies", every).unionByName(
        both.filter(part).withColumn("copies", every + (nth <= F.col("m") % F.col("n")).cast("long")))
    return out.filter(F.col("copies") > 0).select(*[F.col(v).alias(c) for c, v in names.items()], "copies")
