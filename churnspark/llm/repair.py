"""Repair of conversation structure at the least cost, by a checkpointed dynamic program.

A conversation is right when its roles are nothing, or user and assistant in turn (user first, assistant last) after at most
one system turn. Edits: keep a turn (0), give it the role that is due (2), delete it (3; blank and repeated turns must go),
insert an empty turn of the role that is due (2). A turn that breaks off, kept or with a new role, costs 1 more. Of all
cheapest edits those come out whose initials, in order, are least in ASCII.

Four states say which role is due. Walking backward, a vector of four costs stands for all that follows a row. A block of
rows keeps its vectors at every square root of its length only and computes those between again while it walks forward;
forward, the first of D, I, K, R that stays on a cheapest way is taken. A long conversation is many blocks. What links them
is small: each block's 4 x 4 matrix of costs (min-plus), multiplied per part of the table and then per conversation, gives
every block the vector behind it; its table of states, put together the same way, gives it the state in which it begins. So
one conversation may hold any share of the rows; only its hash and audit are put together in one pass, from pieces.

Order: by turn (null first), then role and checksum of the text; of rows with one role and text the first is the original.
Null roles and texts are one space, null conversations are one, a turn that is no integer is null. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.llm.tables import parts, small_batches, written
from churnspark.operators.rank import ordered

# Rows of a block of the dynamic program; rows and characters of a piece of the result (one longer text is a piece).
ROWS = 4096
PIECE_ROWS, PIECE_CHARS = 4096, 4 << 20
BLANK = r"[\x20\x09-\x0D]"
# Costs of the edits.
REROLE, DELETE, INSERT, BROKEN = 2, 3, 2, 1
FAR = 1 << 60
# States: nothing yet, after system, after user, after assistant. NEXT: after a turn of the role that is due.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
INITIAL = {USER: "u", ASSISTANT: "a"}
KEEP = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None)}
NOTHING = (None, None, None, None)

Row = tuple[str, bool, bool]  # initial, must go, breaks off
Costs = tuple[int, int, int, int]
KEYS = "conv string, part long, block long"


# ---- one block -------------------------------------------------------------------------------------------------------


def closed(c: Costs) -> Costs:
    """Costs when turns may be inserted first."""
    user, assistant = min(c[USER], INSERT + c[ASSISTANT]), min(c[ASSISTANT], INSERT + c[USER])
    return min(c[START], INSERT + user), min(c[SYSTEM], INSERT + user), user, assistant


# Behind the last row of a conversation.
END = closed((0, FAR, FAR, 0))


def before(row: Row, behind: Costs) -> Costs:
    """Costs before a row from those behind it."""
    initial, gone, broken = row
    if gone:
        return tuple(DELETE + c for c in behind)
    keep, out = KEEP.get(initial, NOTHING), []
    for state in range(4):
        best = min(DELETE + behind[state], REROLE + broken + behind[NEXT[state]])
        out.append(best if keep[state] is None else min(best, broken + behind[keep[state]]))
    return closed(tuple(out))


def matrix(rows: list[Row]) -> list[int]:
    """Least costs from every state before the rows to every state behind them, as 4 x 4 numbers in one list. What is
    inserted behind the last row belongs to the next block."""
    columns = []
    for to in range(4):
        vector = tuple(0 if state == to else FAR for state in range(4))
        for row in reversed(rows):
            vector = before(row, vector)
        columns.append(vector)
    return [min(columns[to][state], FAR) for state in range(4) for to in range(4)]


def times(m: list[int], behind: Costs) -> Costs:
    """Costs before a block from its matrix and the costs behind it."""
    return tuple(min(m[4 * state + to] + behind[to] for to in range(4)) for state in range(4))


def product(a: list[int], b: list[int]) -> list[int]:
    return [min(FAR, *(a[4 * s + k] + b[4 * k + to] for k in range(4))) for s in range(4) for to in range(4)]


def edits(rows: list[Row], behind: Costs, state: int, last: bool) -> Iterator[tuple[str, int, int]]:
    """(letter, state after it, row) of the cheapest edits that are least in ASCII; an inserted turn has the row it stands
    before, or at the end of a conversation (``last``) the row after it."""
    step = max(1, isqrt(len(rows)))
    checkpoints, vector = [behind], behind  # behind the rows, then backward before every step-th row
    for i in range(len(rows) - 1, -1, -1):
        vector = before(rows[i], vector)
        if i % step == 0:
            checkpoints.append(vector)
    for begin in range(0, len(rows), step):
        checkpoints.pop()
        block = rows[begin:begin + step]
        vectors = [checkpoints[-1]]
        for row in reversed(block):
            vectors.append(before(row, vectors[-1]))
        for i, (initial, gone, broken) in enumerate(block):
            here, after = vectors[-1 - i], vectors[-2 - i]
            keep = NOTHING if gone else KEEP.get(initial, NOTHING)
            while DELETE + after[state] != here[state] == INSERT + here[NEXT[state]]:
                state = NEXT[state]
                yield "I", state, begin + i
            if DELETE + after[state] == here[state]:
                letter = "D"
            elif keep[state] is not None and broken + after[keep[state]] == here[state]:
                letter, state = "K", keep[state]
            else:
                letter, state = "R", NEXT[state]
            yield letter, state, begin + i
    while last and behind[state]:
        state = NEXT[state]
        yield "I", state, len(rows)


def passage(rows: list[Row], behind: Costs) -> list[int]:
    """For every state before the rows the state behind them, on the way that ``edits`` takes."""
    return [[state for _, state, _ in edits(rows, behind, begin, False)][-1] for begin in range(4)]


# ---- rows in order ---------------------------------------------------------------------------------------------------


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text); conv is a string that also tells null from others."""
    space = F.lit(" ")
    return conversations.select(
        conv_name(conv_col).alias("conv"), F.col(f"`{turn_col}`").try_cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), space).alias("role"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), space).alias("text"))


def conv_name(conv_col: str = "conv_id") -> Column:
    name = F.col(f"`{conv_col}`").cast("string")
    return F.coalesce(F.concat(F.lit("="), name), F.lit(""))


def lined(rows: DataFrame) -> DataFrame:
    """``turns`` in written order, with part and place, a code of role and text, and what the program needs to know.

    The random number spreads rows that are equal throughout over several parts.
    """
    code = F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)
    bare = F.regexp_replace("text", BLANK, "")
    known = rows.withColumns({"code": code, "initial": F.left("role", F.lit(1)), "blank": bare == "",
                              "broken": ~F.right(bare, F.lit(1)).isin(".", "!", "?"), "salt": F.rand(7)})
    order = [F.col("conv").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("code").asc(), F.col("salt").asc()]
    out = ordered(known, *order, name="turns")
    return out.withColumnsRenamed({"_part": "part", "_place": "place"}).withColumn("block", F.floor(F.col("place") / ROWS)).drop("salt")


def faults(rows: DataFrame) -> DataFrame:
    """``lined`` rows without texts, with ``fault``: blank, duplicate, truncated or null. The first row of a conversation
    with some role and text is found by grouping and joined back by its place, so no text is a join key."""
    narrow = rows.select("conv", "turn", "part", "place", "block", "code", "initial", "blank", "broken")
    first = narrow.groupBy("conv", "code").agg(F.min(F.struct("part", "place")).alias("f"))
    originals = first.select("f.part", "f.place", F.lit(True).alias("original"))
    fault = F.when(F.col("blank"), "blank").when(F.col("original").isNull(), "duplicate").when(F.col("broken"), "truncated")
    return narrow.join(originals, ["part", "place"], "left").withColumn("fault", fault).drop("code", "original", "blank", "broken")


# ---- blocks ----------------------------------------------------------------------------------------------------------


def _segments(frame: pd.DataFrame) -> Iterator[tuple[str, list[Row]]]:
    """The conversations of a block (sorted by place) in order, each with its rows."""
    convs = frame["conv"].tolist()
    rows = [(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(frame["initial"].tolist(), frame["fault"].tolist())]
    begin = 0
    for end in range(1, len(convs) + 1):
        if end == len(convs) or convs[end] != convs[begin]:
            yield convs[begin], rows[begin:end]
            begin = end


def _ends(frame: pd.DataFrame) -> list[tuple[str, list[Row]]]:
    """The first and the last conversation of a block: no other one can go on in a neighbouring block."""
    found = list(_segments(frame.sort_values("place")))
    return found if len(found) < 2 else [found[0], found[-1]]


def _matrices(frame: pd.DataFrame) -> pd.DataFrame:
    part, block = frame["part"].iloc[0], frame["block"].iloc[0]
    return pd.DataFrame([(conv, part, block, matrix(rows)) for conv, rows in _ends(frame)], columns=["conv", "part", "block", "m"])


def _folded(frame: pd.DataFrame, column: str, join) -> list:
    values = frame.sort_values("block")[column].tolist()
    total = list(values[0])
    for v in values[1:]:
        total = join(total, v)
    return total


def _per_part(edges: DataFrame, column: str, join) -> DataFrame:
    """The blocks of a conversation in one part as one block (numbered by the part)."""
    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        part = frame["part"].iloc[0]
        return pd.DataFrame([(frame["conv"].iloc[0], part, part, _folded(frame, column, join))], columns=["conv", "part", "block", column])

    return edges.groupBy("conv", "part").applyInPandas(fold, f"{KEYS}, {column} array<long>")


def _behind(edges: DataFrame, by: list[str], ends: DataFrame | None) -> DataFrame:
    """(conv, part, block, behind, last): the costs behind every block of a group, from those behind the group."""
    def walk(frame: pd.DataFrame, end: pd.DataFrame | None = None) -> pd.DataFrame:
        if not len(frame):
            return pd.DataFrame(columns=["conv", "part", "block", "behind", "last"])
        vector, last, out = (END, True, []) if end is None else (tuple(end["behind"].iloc[0]), bool(end["last"].iloc[0]), [])
        for r in frame.sort_values("block", ascending=False).itertuples():
            out.append((r.conv, r.part, r.block, list(vector), last))
            vector, last = times(list(r.m), vector), False
        return pd.DataFrame(out, columns=["conv", "part", "block", "behind", "last"])

    schema = f"{KEYS}, behind array<long>, last boolean"
    groups = edges.groupBy(*by)
    if ends is None:
        return groups.applyInPandas(lambda frame: walk(frame), schema)
    return groups.cogroup(ends.groupBy(*by)).applyInPandas(lambda frame, end: walk(frame, end), schema)


def _begins(tables: DataFrame, by: list[str], first: DataFrame | None) -> DataFrame:
    """(conv, part, block, state): the state in which every block of a group begins, from that of the group."""
    def walk(frame: pd.DataFrame, begin: pd.DataFrame | None = None) -> pd.DataFrame:
        if not len(frame):
            return pd.DataFrame(columns=["conv", "part", "block", "state"])
        state, out = START if begin is None else int(begin["state"].iloc[0]), []
        for r in frame.sort_values("block").itertuples():
            out.append((r.conv, r.part, r.block, state))
            state = int(r.t[state])
        return pd.DataFrame(out, columns=["conv", "part", "block", "state"])

    groups = tables.groupBy(*by)
    if first is None:
        return groups.applyInPandas(lambda frame: walk(frame), f"{KEYS}, state int")
    return groups.cogroup(first.groupBy(*by)).applyInPandas(lambda frame, begin: walk(frame, begin), f"{KEYS}, state int")


def _linked(rows: DataFrame) -> DataFrame:
    """(conv, part, block, behind, last, state) of the conversations at either end of a block."""
    edges = written(rows.groupBy("part", "block").applyInPandas(_matrices, f"{KEYS}, m array<long>"), "edges")
    behind = written(_behind(edges, ["conv", "part"], _behind(_per_part(edges, "m", product), ["conv"], None)), "behind")

    def tables(frame: pd.DataFrame, links: pd.DataFrame) -> pd.DataFrame:
        part, block = links["part"].iloc[0], links["block"].iloc[0]
        vectors = dict(zip(links["conv"], links["behind"]))
        out = [(conv, part, block, passage(some, tuple(vectors[conv]))) for conv, some in _ends(frame)]
        return pd.DataFrame(out, columns=["conv", "part", "block", "t"])

    found = rows.groupBy("part", "block").cogroup(behind.groupBy("part", "block")).applyInPandas(tables, f"{KEYS}, t array<long>")
    found = written(found, "states")
    firsts = _begins(_per_part(found, "t", lambda a, b: [b[s] for s in a]), ["conv"], None)
    return behind.join(_begins(found, ["conv", "part"], firsts), ["conv", "part", "block"])


def edited(rows: DataFrame) -> DataFrame:
    """``faults`` rows with ``letters``, the edits at the row, and ``roles``, the initial of the role that each one leaves
    ('-' for a deleted turn). Turns inserted at the end stand behind the last row's own letter."""
    def walk(frame: pd.DataFrame, links: pd.DataFrame) -> pd.DataFrame:
        known = {r.conv: (tuple(r.behind), bool(r.last), int(r.state)) for r in links.itertuples()}
        frame = frame.sort_values("place")
        letters, roles = [], []
        for conv, facts in _segments(frame):
            behind, last, state = known.get(conv, (END, True, START))
            own, left = [""] * len(facts), [""] * len(facts)
            for letter, state, i in edits(facts, behind, state, last):
                i = min(i, len(facts) - 1)
                own[i] += letter
                left[i] += "-" if letter == "D" else facts[i][0] if letter == "K" else INITIAL[state]
            letters += own
            roles += left
        return frame.assign(letters=letters, roles=roles)[["conv", "part", "place", "initial", "fault", "letters", "roles"]]

    return rows.groupBy("part", "block").cogroup(_linked(rows).groupBy("part", "block")).applyInPandas(
        walk, "conv string, part long, place long, initial string, fault string, letters string, roles string")


# ---- results ---------------------------------------------------------------------------------------------------------

PIECE = ("conv string, part long, place long, audit string, cost long, blank long, duplicate long, truncated long, illegal long, "
         "first string, last string, turns array<struct<edit:string,turn:long,role:string,text:string>>")
LEGAL = ("su", "ua", "au")


class _Piece:
    """Rows of one conversation on their way into one piece of the result."""

    def __init__(self, conv: str, part: int, place: int):
        self.key, self.audit, self.turns, self.chars = (conv, part, place), [], [], 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.cost = self.illegal = 0
        self.first = self.last = None

    def add(self, turn, role: str, text: str, initial: str, fault: str | None, letters: str, roles: str) -> None:
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.last = initial
        if fault:
            self.faults[fault] += 1
        for letter, new in zip(letters, roles):
            self.cost += {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[letter] + (fault == "truncated" and letter in "KR") * BROKEN
            if letter == "I":
                self.turns.append((letter, None, "user" if new == "u" else "assistant", ""))
            elif letter != "D":
                self.turns.append((letter, turn, role if letter == "K" else "user" if new == "u" else "assistant", text))
                self.chars += len(text)
        self.audit.append(letters)

    def row(self) -> tuple:
        return (*self.key, "".join(self.audit), self.cost, *self.faults.values(), self.illegal, self.first, self.last, self.turns)


def pieces(rows: DataFrame) -> DataFrame:
    """The repaired conversations in pieces, ordered by (conv, part, place): edits, counts and the turns that remain.

    Texts and edits meet in one shuffle: both are sorted by place within their part and read as one stream.
    """
    small_batches(rows.sparkSession)
    narrow = written(edited(written(faults(rows), "faults")), "edits")
    none = {c: F.lit(None).cast("string").alias(c) for c in ("turn", "text", "role", "letters", "roles", "fault")}
    texts = rows.select("conv", F.col("turn").cast("string"), "part", "place", none["letters"], none["roles"], none["fault"], "role", "text", "initial")
    marks = narrow.select("conv", none["turn"], "part", "place", "letters", "roles", "fault", none["role"], none["text"], "initial")
    both = marks.unionByName(texts).repartition(parts(rows.sparkSession), "part").sortWithinPartitions("part", "place", F.col("text").isNotNull())

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in PIECE.split(", ")]
        piece, mark = None, None
        for frame in frames:
            out = []
            for r in frame.itertuples():
                if r.text is None:
                    mark = r
                    continue
                full = piece is not None and (len(piece.audit) >= PIECE_ROWS or piece.chars >= PIECE_CHARS)
                if piece is None or full or piece.key[:2] != (r.conv, r.part):
                    out += [] if piece is None else [piece.row()]
                    piece = _Piece(r.conv, r.part, r.place)
                turn = None if r.turn is None else int(r.turn)
                piece.add(turn, r.role, r.text, r.initial, mark.fault, mark.letters, mark.roles)
            if out:
                yield pd.DataFrame(out, columns=names)
        if piece is not None:
            yield pd.DataFrame([piece.row()], columns=names)

    return both.mapInPandas(walk, PIECE)


def repaired(conversations: DataFrame, conv_col: str = "conv_id", **columns) -> DataFrame:
    """(conv_id, position from 0 within (part, place), edit, turn, role, text) of the turns that remain. ``part``, ``place`` and
    ``position`` order the turns of a conversation; inserted turns have no turn number and an empty text."""
    kind = conversations.schema[conv_col].dataType
    made = pieces(lined(turns(conversations, conv_col, **columns)))
    out = made.select("conv", "part", "place", F.posexplode("turns").alias("position", "t"))
    name = F.when(F.col("conv") != "", F.substr("conv", F.lit(2))).cast(kind)
    return out.select(name.alias(conv_col), "part", "place", "position", "t.edit", "t.turn", "t.role", "t.text")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults planted by crc32("conv_id:turn") % 20: dropped (0), emptied (1), without [.!?] (2), twice
    (3), role user (4)."""
    space = F.lit(" ")
    conv, turn = (F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))))
    return rows.select("conv_id", "turn", "role", "text")


def _totals(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces, sorted, into one row per conversation; bodies are hashed as they come."""
    now, columns = None, ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def ended(c: dict) -> tuple:
        return c["conv"], *c["sums"], "".join(c["audit"]), c["sha"].hexdigest()

    for frame in frames:
        out = []
        for r in frame.itertuples():
            if now is None or now["conv"] != r.conv:
                out += [] if now is None else [ended(now)]
                now = {"conv": r.conv, "sums": [0] * 5, "audit": [], "sha": hashlib.sha256(), "lines": 0, "last": None}
            across = now["last"] is not None and now["last"] + r.first not in LEGAL
            own = (r.blank, r.duplicate, r.truncated, r.illegal + across, r.cost)
            now["sums"] = [a + int(b) for a, b in zip(now["sums"], own)]
            now["audit"].append(r.audit)
            if r.lines:
                now["sha"].update(("\n" * (now["lines"] > 0) + r.body).encode("utf-8", "surrogatepass"))
            now["lines"] += r.lines
            now["last"] = r.last
        if out:
            yield pd.DataFrame(out, columns=columns)
    if now is not None:
        yield pd.DataFrame([ended(now)], columns=columns)


def digest(conversations: DataFrame, damage: bool = True) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: one row per conversation of the
    table, also where the damage leaves no row."""
    kind = conversations.schema["conv_id"].dataType
    rows = lined(turns(damaged(conversations) if damage else conversations))
    body = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    made = pieces(rows).select("conv", "part", "place", "audit", "cost", "blank", "duplicate", "truncated", "illegal", "first", "last",
                               F.size("turns").alias("lines"), body.alias("body"))
    folded = made.repartition(parts(rows.sparkSession), "conv").sortWithinPartitions("conv", "part", "place").mapInPandas(
        _totals, "conv string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
    seen = rows.filter("turn IS NOT NULL").groupBy("conv", "turn").agg(F.count(F.lit(1)))
    gaps = seen.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps"))
    every = conversations.select(conv_name().alias("conv")).distinct()
    out = every.join(gaps, "conv", "left").join(folded, "conv", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.when(F.col("conv") != "", F.substr("conv", F.lit(2))).cast(kind).alias("conv_id"), *numbers,
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
