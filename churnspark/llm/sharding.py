"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix. DataFrame and SQL functions only.

Rows lie in logical partitions. How many rows of each partition go to each shard is drawn first: the matrix has the
partitions' row counts as row sums and the shards' sizes (at most one apart) as column sums, and follows the multivariate
hypergeometric law that a uniform shuffle of all rows would give it. The draw goes down a binary tree over the partitions: a
node's shard counts are split among its halves, all nodes of a level at once. Then every partition permutes its rows and
deals them to the shards by its row of the matrix, the rows move, and every shard permutes what it got.

A single variate is drawn by inversion, starting at the mode and going outwards on both sides, with weights from the ratios
of neighbouring probabilities. Twelve standard deviations and forty more values on either side hold all that a 52-bit
random number can tell apart.

Partitions are hash ranges of about ``ROWS`` rows, a shard's second permutation is worked off in as many bins, so no task
grows with the table. Every random number is a hash of the row and the seed: reruns and lost executors change nothing.

The law is ``rows``: shard sizes are at most one row apart. Rows with equal texts, one group, are rows like any other and
spread over all shards; with exact sizes, a group larger than a shard cannot stay together. Equal rows (id and text) are
told apart by a number and may be dealt in any order. Null texts have size 1 (no bytes) and checksum 0; null ids are one id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from churnspark.functions.columns import hash_fraction
from churnspark.llm.tables import expanded, fresh, written
from churnspark.llm.tables import parts as ranges

SHARDS = 16
ROWS = 1 << 20
LEAST_PARTS = 32
SEED = "shuffle"


def _bound(value: Column, fn: Callable[[Column], Column]) -> Column:
    """fn(value) with the value computed once."""
    return F.transform(F.array(value), fn)[0]


def _outwards(g: Column, goal: Column) -> Column:
    """Weights summed from the mode outwards: ``cum``, their sum, and ``k``, the value at which the sum passes ``goal``."""
    total, marked, drawn = g["total"], g["marked"], g["drawn"]
    rest = total - marked - drawn

    def step(a: Column, i: Column) -> Column:
        above, below = g["mode"] + i - 1, g["mode"] - i + 1
        up = F.when(above < g["high"], (marked - above) * (drawn - above) / ((above + 1) * (rest + above + 1))).otherwise(0.0)
        down = F.when(below > g["low"], below * (rest + below) / ((marked - below + 1) * (drawn - below + 1))).otherwise(0.0)

        def passed(w: Column) -> Column:
            cum = a["cum"] + w["up"]
            k = (F.when(a["k"] >= 0, a["k"]).when(cum > goal, g["mode"] + i)
                 .when(cum + w["down"] > goal, g["mode"] - i).otherwise(-1.0))
            return F.struct(w["up"].alias("up"), w["down"].alias("down"), (cum + w["down"]).alias("cum"), k.alias("k"))

        return _bound(F.struct((a["up"] * up).alias("up"), (a["down"] * down).alias("down")), passed)

    first = F.when(goal < 1.0, g["mode"]).otherwise(-1.0)
    start = F.struct(F.lit(1.0).alias("up"), F.lit(1.0).alias("down"), F.lit(1.0).alias("cum"), first.alias("k"))
    return F.aggregate(F.sequence(F.lit(1).cast("long"), g["half"]), start, step)


def variate(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """Hypergeometric variate (long): the marked ones among ``drawn`` of ``total`` things of which ``marked`` are marked."""
    def bounds(h: Column) -> Column:
        n, k, m = h["total"], h["marked"], h["drawn"]
        low, high = F.greatest(F.lit(0.0), m + k - n), F.least(k, m)
        mode = F.greatest(low, F.least(high, F.floor((m + 1) * (k + 1) / (n + 2)).cast("double")))
        share = k / F.greatest(n, F.lit(1.0))
        deviation = F.sqrt(m * share * (1 - share) * (n - m) / F.greatest(n - 1, F.lit(1.0)))
        half = F.greatest(F.lit(1.0), F.least(high - low, F.ceil(12 * deviation) + 40)).cast("long")
        return F.struct(n.alias("total"), k.alias("marked"), m.alias("drawn"), h["u"].alias("u"), low.alias("low"),
                        high.alias("high"), mode.alias("mode"), half.alias("half"))

    def inverted(g: Column) -> Column:
        weights = _outwards(g, F.lit(float("inf")))["cum"]
        found = _bound(g["u"] * weights, lambda goal: _outwards(g, goal)["k"])
        return F.greatest(g["low"], F.when(found >= 0, found).otherwise(g["mode"])).cast("long")

    given = F.struct(*[c.cast("double").alias(n) for n, c in (("total", total), ("marked", marked), ("drawn", drawn), ("u", u))])
    return _bound(_bound(given, bounds), inverted)


def _split(room: Column, drawn: Column, u: Callable[[Column], Column]) -> Column:
    """How many of ``drawn`` things fall to each shard when ``room`` places are filled at random: shard after shard, each
    from what is left."""
    places = F.transform(room, lambda c, s: F.struct(c.alias("room"), u(s).alias("u")))
    total = F.aggregate(room, F.lit(0).cast("long"), lambda a, c: a + c)
    start = F.struct(total.alias("total"), drawn.cast("long").alias("drawn"), F.array().cast("array<bigint>").alias("out"))

    def step(a: Column, e: Column) -> Column:
        return _bound(variate(a["total"], e["room"], a["drawn"], e["u"]), lambda x: F.struct(
            (a["total"] - e["room"]).alias("total"), (a["drawn"] - x).alias("drawn"), F.concat(a["out"], F.array(x)).alias("out")))

    return F.aggregate(places, start, step, lambda a: a["out"])


def matrix(sizes: DataFrame, parts: int, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """(part, counts): rows of each of ``parts`` (a power of two) partitions for each shard. ``sizes`` is (part, n)."""
    spark, levels = sizes.sparkSession, parts.bit_length() - 1
    every = F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level")
    up = sizes.select(every, "part", "n").groupBy("level", F.floor(F.col("part") / F.pow(F.lit(2.0), F.lit(levels) - F.col("level"))).alias("node"))
    nodes = written(up.agg(F.sum("n").alias("n")), "nodes")
    rows = F.coalesce(F.max("n"), F.lit(0)).cast("long")
    whole = nodes.filter("level = 0").agg(rows.alias("n"))
    even = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")),
                       lambda s: F.floor(F.col("n") / shards).cast("long") + (s < F.col("n") % shards).cast("long"))
    here = whole.select(F.lit(0).cast("long").alias("node"), even.alias("room"))
    for level in range(levels):
        left = nodes.filter((F.col("level") == level + 1) & (F.col("node") % 2 == 0)).select((F.col("node") / 2).cast("long").alias("node"), "n")
        name = F.concat(F.lit(f"{level}:"), F.col("node").cast("string"), F.lit(":"))
        first = _split(F.col("room"), F.coalesce("n", F.lit(0)), lambda s: hash_fraction(F.concat(name, s.cast("string")), seed))
        # The rows are few but dear: a stated number of tasks shares them.
        spread = here.repartition(min(1 << level, ranges(spark)), "node") if level >= 4 else here
        drawn = spread.join(left, "node", "left").select("node", "room", first.alias("first"))
        halves = F.array(F.struct((F.col("node") * 2).alias("node"), F.col("first").alias("room")),
                         F.struct((F.col("node") * 2 + 1).alias("node"), F.zip_with("room", "first", lambda a, b: a - b).alias("room")))
        here = drawn.select(F.inline(halves))
    return written(here.select(F.col("node").alias("part"), F.col("room").alias("counts")), "matrix")


def parts_for(rows: int) -> int:
    """Logical partitions of about ``ROWS`` rows: a power of two."""
    return max(LEAST_PARTS, 1 << max(0, -(-rows // ROWS) - 1).bit_length())


def placed(units: DataFrame, by: list[str], shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """One row per counted row of ``units`` (``by`` columns that tell them apart, n): its shard and its slot, from 0."""
    units = written(units, "units")
    total = units.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    parts = parts_for(total)
    bins = max(1, parts // shards)
    name = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in by], F.col("nth").cast("string"))
    rows = written(expanded(units, "n", "nth", by).drop("n").withColumn("name", name).withColumns({
        "part": F.floor(hash_fraction(F.col("name"), f"{seed} part") * parts).cast("long"),
        "first": hash_fraction(F.col("name"), f"{seed} first"), "second": hash_fraction(F.col("name"), f"{seed} second")}), "rows")
    counts = matrix(rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")), parts, shards, seed)
    until = F.transform("counts", lambda c, s: F.aggregate(F.slice("counts", 1, s + 1), F.lit(0).cast("long"), lambda a, x: a + x))
    place = F.row_number().over(W.partitionBy("part").orderBy("first", "name"))
    dealt = rows.withColumn("place", place).join(counts.select("part", until.alias("until")), "part")
    shard = F.size(F.filter("until", lambda c: c < F.col("place"))).cast("int")
    sent = written(dealt.select(*by, "name", "second", shard.alias("shard"), F.floor(F.col("second") * bins).cast("long").alias("bin")), "sent")
    before = W.partitionBy("shard").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    offsets = written(sent.groupBy("shard", "bin").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "offsets")
    inside = F.row_number().over(W.partitionBy("shard", "bin").orderBy("second", "name")) - 1
    return sent.withColumn("inside", inside).join(offsets, ["shard", "bin"]).select(
        *by, "shard", (F.col("before") + F.col("inside")).cast("long").alias("slot"))


def digest(docs: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    by = ["doc_id", "size", "text_crc32"]
    return placed(rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")), by, shards, seed).select(
        *by, F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def sharded(docs: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """All columns of ``docs`` with ``shard`` and ``slot`` (columns of these names go). Only row codes are shuffled for the
    draw; the rows themselves move once, to their codes. Rows that are equal in every column are one row with a count."""
    names = {c: fresh(c) for c in docs.columns if c not in ("shard", "slot")}
    rows = docs.drop("shard", "slot").toDF(*names.values())
    codes = {"code": F.xxhash64(*names.values()), "again": F.xxhash64(F.lit(1), *names.values())}
    whole = rows.withColumns(codes).groupBy("code", "again").agg(F.first(F.struct(*names.values())).alias("row"))
    units = rows.select(*[c.alias(n) for n, c in codes.items()]).groupBy("code", "again").agg(F.count(F.lit(1)).alias("n"))
    out = placed(units, ["code", "again"], shards, seed).join(whole, ["code", "again"])
    return out.select(*[F.col(f"row.{v}").alias(c) for c, v in names.items()], "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: str = SEED) -> None:
    """Folders shard=0, shard=1 ... of Parquet files in slot order."""
    order = ["shard", "slot"]
    sharded(docs, shards, seed).repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("shard").parquet(path)
