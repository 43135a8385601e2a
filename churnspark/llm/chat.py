"""Chat formatting: a hidden Markov model over speaker markers and line features recovers who speaks; turns are rendered anew.

States are a role (system, user, assistant) and whether a line begins a turn or goes on. Emissions are counts of marker
class and line features, transitions counts of what follows what, both learned from conversations with known roles. Viterbi
finds the most likely states. Markers may be missing, unknown or written in many ways; what a line looks like, where it
stands and who spoke before decide then.

A transcript of any length is worked off in segments: each segment gives the best score from every state before it to every
state at its end (max-plus products, 7 x 6 numbers); chaining these small tables fixes the states at the segments' ends;
each segment is then traced on its own. Turn numbers are running counts over segments. No task sees a whole transcript.

A marker is cut from a line only where the path begins a turn; its name, as written, is the turn's speaker. Every other line
stays as it is, whatever it looks like.

Rules for odd rows: null lines are empty; empty lines end nothing and mark the next line, those between lines of one turn
stay in its text, others belong to no turn and none is counted; a transcript without other lines has no turns; equal (segment, pos) are ordered by line; a null id is an id of its own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from churnspark.llm.tables import parts, small_batches, written

# Roles and the names that speakers go by in markers.
ROLES = ["system", "user", "assistant"]
ALIASES = {
    "system": "system", "context": "system", "instructions": "system", "instruction": "system", "setup": "system",
    "user": "user", "human": "user", "me": "user", "you": "user", "q": "user", "question": "user", "customer": "user", "prompt": "user",
    "assistant": "assistant", "ai": "assistant", "bot": "assistant", "chatbot": "assistant", "a": "assistant", "answer": "assistant",
    "agent": "assistant", "model": "assistant", "gpt": "assistant", "response": "assistant",
}
STATES = [(r, b) for r in range(3) for b in (True, False)]  # state 2 r begins a turn of role r, 2 r + 1 goes on
N, START = len(STATES), len(STATES)
LENGTHS = [20, 60, 150, 400]
FEATURES = ["marker", "before", "end", "length", "case"]
SIZES = [6, 3, 4, len(LENGTHS) + 1, 3]
SEGMENT = 256
NEVER = -1e9

# A name of one or two words in brackets, asterisks or after hashes, or followed by a colon.
MARKER = re.compile(
    r"\s*(?:#{1,6}\s*(?P<hash>[^\W\d_]+(?: [^\W\d_]+)?)\s*:?|\[(?P<bracket>[^\W\d_]+)\]\s*:?|<\|?(?P<angle>[^\W\d_]+)\|?>"
    r"|\*\*(?P<star>[^\W\d_]+(?: [^\W\d_]+)?):?\*\*\s*:?|(?P<plain>[^\W\d_]+(?: [^\W\d_]+)?)\s*:)(?:\s+|$)", re.UNICODE)


def marker(line: str) -> tuple[int, str, str | None]:
    """(class, rest of the line, name): 0 none, 1 to 3 a role, 4 an unknown name, 5 a name alone on its line (role classes win)."""
    m = MARKER.match(line)
    if not m:
        return 0, line, None
    name = next(g for g in m.groupdict().values() if g)
    role = ALIASES.get(name.lower())
    rest = line[m.end():]
    return (1 + ROLES.index(role) if role else 4 if rest.strip() else 5), rest, name


def line_features(lines: list[str], opens: bool) -> tuple[list[int], np.ndarray, list[tuple[str, str | None]]]:
    """Places of the lines that are not empty, their features and (what they say without a marker, the marker's name).

    ``opens`` tells whether the first line is the first one of the transcript.
    """
    at, rows, said, gap, previous = [], [], [], False, -1
    for i, line in enumerate(lines):
        if not line.strip():
            gap = True
            continue
        kind, rest, name = marker(line)
        text = rest.strip() or line.strip()
        end = {"?": 1, ":": 2, ".": 0}.get(text[-1], 3)
        case = 0 if text[0].isupper() else 1 if text[0].islower() else 2
        before = 2 if opens and previous < 0 else 1 if gap else 0
        rows.append((kind, before, end, int(np.searchsorted(LENGTHS, len(text), side="right")), case))
        at.append(i)
        said.append((rest, name))
        gap, previous = False, i
    return at, np.array(rows, int).reshape(-1, len(FEATURES)), said


@dataclass
class Model:
    """Log probabilities: move[from, to] (row START for the first line), emit[feature][state, value]."""

    move: np.ndarray
    emit: list[np.ndarray]

    @staticmethod
    def of(moves: dict[tuple[int, int], int], emits: dict[tuple[int, int, int], int]) -> Model:
        move = np.full((N + 1, N), 0.0)
        for (a, b), n in moves.items():
            move[a, b] += n
        for a in range(N + 1):
            for b in range(N):
                begins = b % 2 == 0
                possible = begins or (a != START and a // 2 == b // 2)
                move[a, b] = move[a, b] + 0.5 if possible else 0
        move /= move.sum(1, keepdims=True)
        emit = []
        for f, size in enumerate(SIZES):
            e = np.full((N, size), 0.5)
            for (g, s, v), n in emits.items():
                if g == f:
                    e[s, v] += n
            emit.append(np.log(e / e.sum(1, keepdims=True)))
        with np.errstate(divide="ignore"):
            return Model(np.maximum(np.log(move), NEVER), emit)

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return sum(e[:, features[:, f]].T for f, e in enumerate(self.emit))


def segment_scores(model: Model, emissions: np.ndarray) -> np.ndarray:
    """Best score from each state before the segment (row START: its transcript begins here) to each state at its end."""
    best = model.move + emissions[0]
    for e in emissions[1:]:
        best = (best[:, :, None] + model.move[None, :N, :]).max(1) + e
    return best


def trace(model: Model, emissions: np.ndarray, before: int, last: int) -> list[int]:
    """Most likely states of a segment between the state before it and its last state."""
    best, back = model.move[before] + emissions[0], []
    for e in emissions[1:]:
        step = best[:, None] + model.move[:N]
        back.append(step.argmax(0))
        best = step.max(0) + e
    path = [last]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def chained(scores: list[np.ndarray]) -> list[tuple[int, int]]:
    """(state before, last state) of every segment of one transcript, from the segments' scores in order."""
    best, back = None, []
    for k, s in enumerate(scores):
        step = s[START][None, :] if k == 0 else best[:, None] + s[:N]
        back.append(step.argmax(0))
        best = step.max(0)
    last, out = int(best.argmax()), []
    for k in range(len(scores) - 1, -1, -1):
        before = START if k == 0 else int(back[k][last])
        out.append((before, last))
        last = before
    return out[::-1]


def _units(frame: pd.DataFrame) -> Iterator[tuple]:
    """((id, segment), rows of the unit in order) of a bin."""
    frame = frame.sort_values(["id", "segment", "pos", "line"], kind="stable", ignore_index=True)
    for name, f in frame.groupby(["id", "segment"], sort=False, dropna=False):
        yield name, f


def parse(lines: DataFrame, model: Model) -> DataFrame:
    """Turns (id, turn, role, n_lines, speaker, text, rendered) of transcripts given as (id string, segment, pos, line).

    Lines are ordered by (segment, pos); segment 0 holds the first lines of a transcript, and numbers have no gaps that
    matter. speaker is the name in the marker that begins the turn, null without one; rendered is the canonical form of a turn.
    """
    spark = lines.sparkSession
    small_batches(spark, 4096)
    spread = F.pmod(F.xxhash64("id", "segment"), F.lit(4 * parts(spark)))
    lines = lines.select(F.col("id").cast("string").alias("id"), F.col("segment").cast("long").alias("segment"),
                         F.col("pos").cast("long").alias("pos"), F.coalesce(F.col("line").cast("string"), F.lit("")).alias("line"))
    lines = written(lines, "lines")
    opening = lines.filter(F.length(F.trim("line")) > 0).groupBy("id").agg(F.min("segment").alias("opening")).toDF("i", "opening")
    rows = lines.join(opening, F.col("id").eqNullSafe(F.col("i"))).select(
        "id", "segment", "pos", "line", (F.col("segment") == F.col("opening")).alias("opens")).withColumn("bin", spread)

    def score(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (name, segment), f in _units(frame):
            at, features, _ = line_features(f["line"].tolist(), bool(f["opens"].iloc[0]))
            if at:
                out.append((None if pd.isna(name) else name, segment, segment_scores(model, model.emissions(features)).ravel().tolist()))
        return pd.DataFrame(out, columns=["id", "segment", "scores"], dtype=object)

    def chain(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["id", "segment"], ignore_index=True)
        out = []
        for name, f in frame.groupby("id", sort=False, dropna=False):
            ends = chained([np.asarray(s).reshape(N + 1, N) for s in f["scores"]])
            out += [(None if pd.isna(name) else name, s, b, e) for s, (b, e) in zip(f["segment"], ends)]
        return pd.DataFrame(out, columns=["id", "segment", "before", "last"], dtype=object)

    scores = rows.groupBy("bin").applyInPandas(score, "id string, segment long, scores array<double>")
    ends = scores.withColumn("bin", F.pmod(F.xxhash64("id"), F.lit(4 * parts(spark)))).groupBy("bin").applyInPandas(
        chain, "id string, segment long, before int, last int")

    def states(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        known = {(None if pd.isna(i) else i, s): (b, e) for i, s, b, e in zip(right["id"], right["segment"], right["before"], right["last"])}
        out = []
        for (name, segment), f in _units(left):
            whole = f["line"].tolist()
            at, features, said = line_features(whole, bool(f["opens"].iloc[0]))
            name = None if pd.isna(name) else name
            path = trace(model, model.emissions(features), *known[name, segment]) if at else []
            found, turn = dict(zip(at, zip(path, said))), 0
            for k, line in enumerate(whole):
                if k not in found:  # an empty line, kept with the turn before it
                    out.append((name, segment, k, turn, None, None, line, False))
                    continue
                state, (rest, speaker) = found[k]
                begins = state % 2 == 0
                turn += begins
                text = rest if begins else line
                out.append((name, segment, k, turn, ROLES[state // 2], speaker if begins else None, text, bool(text.strip())))
        return pd.DataFrame(out, columns=["id", "segment", "nth", "local", "role", "speaker", "said", "filled"], dtype=object)

    traced = rows.groupBy("bin").cogroup(ends.withColumn("bin", spread).groupBy("bin")).applyInPandas(
        states, "id string, segment long, nth long, local long, role string, speaker string, said string, filled boolean")
    traced = written(traced, "traced")
    per = traced.groupBy("id", "segment").agg(F.max("local").alias("turns"))
    done = W.partitionBy("id").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    per = per.withColumn("done", F.coalesce(F.sum("turns").over(done), F.lit(0))).drop("turns").toDF("i", "s", "done")
    both = traced.join(per, traced["id"].eqNullSafe(per["i"]) & (traced["segment"] == per["s"]))
    turn = (F.col("done") + F.col("local") - 1).alias("turn")
    # Empty lines before the first turn have number -1.
    turns = both.select("id", turn, "role", "speaker", "segment", "nth", "said", "filled").filter("turn >= 0").groupBy("id", "turn").agg(
        F.min("role").alias("role"), F.count("role").alias("n_lines"), F.min("speaker").alias("speaker"),
        F.sort_array(F.collect_list(F.struct("segment", "nth", "said", "filled"))).alias("all"))
    filled = F.transform("all", lambda x: x["filled"])
    turns = turns.withColumn("first", F.array_position(filled, True)).withColumn("after", F.array_position(F.reverse(filled), True))
    inner = F.slice("all", F.greatest("first", F.lit(1)).cast("int"), (F.size("all") - F.col("first") - F.col("after") + 2).cast("int"))
    text = F.when(F.col("first") > 0, F.array_join(F.transform(inner, lambda x: x["said"]), "\n")).otherwise("")
    turns = turns.withColumn("text", text).drop("all", "first", "after")
    return turns.withColumn("rendered", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>")))


def transcript_lines(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Lines of transcripts that are one text each, for ``parse``."""
    line = texts.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.posexplode(F.split(F.col(f"`{text_col}`"), "\r?\n")).alias("pos", "line"))
    return line.withColumn("segment", F.floor(F.col("pos") / SEGMENT))


def learn(lines: DataFrame, moves: DataFrame) -> Model:
    """Model from lines with known states (id, segment, pos, line, state) and moves (a, b, n) between states.

    Lines whose state is null are not learned from.
    Lines of one (id, segment) need not be whole transcripts; counts are added up in the tasks first.
    """
    spread = F.pmod(F.xxhash64("id", "segment"), F.lit(4 * parts(lines.sparkSession)))

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        seen: Counter = Counter()
        for _, f in _units(frame):
            at, features, _ = line_features(f["line"].tolist(), bool(f["opens"].iloc[0]))
            for s, row in zip(f["state"].to_numpy()[at].tolist(), features.tolist()):
                if not pd.isna(s):
                    seen.update((k, int(s), v) for k, v in enumerate(row))
        return pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["feature", "state", "value", "n"])

    emits = lines.withColumn("bin", spread).groupBy("bin").applyInPandas(count, "feature int, state int, value int, n long")
    emits = emits.groupBy("feature", "state", "value").agg(F.sum("n").alias("n")).collect()
    moved = moves.groupBy("a", "b").agg(F.sum("n").alias("n")).collect()
    return Model.of({(r["a"], r["b"]): r["n"] for r in moved}, {(r["feature"], r["state"], r["value"]): r["n"] for r in emits})


# ---- transcripts from a table of turns ----------------------------------------------------------------------------------

# How speakers are marked in six styles; the place of a name and of what is said.
STYLES = [
    ("{0}: {1}", ("System", "User", "Assistant")),
    ("### {0}:\n{1}", ("Instruction", "Human", "Response")),
    ("{0}: {1}", ("Context", "Q", "A")),
    ("[{0}] {1}", ("system", "user", "assistant")),
    ("**{0}**: {1}", ("Setup", "Me", "AI")),
    ("{0}: {1}", ("Narrator", "Alice", "Bob")),
]
TURNS = 32


def transcripts(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) as lines of transcripts with known states.

    The style follows the hash of conv_id; one marker in eight is missing, in the sixth style the names tell nothing.
    Roles are known by their names and aliases, in any case and with spaces around. A turn of another role (tool, function)
    is shown with its own name in the marker, one of a null or empty role without a marker; both have no state.
    """
    named = F.regexp_replace(F.col("role").cast("string"), r"(?U)^\s+|\s+$", "")
    role = F.create_map(*[F.lit(x) for alias, r in ALIASES.items() for x in (alias, ROLES.index(r))])[F.lower(named)]
    rows = turns.select(F.col("conv_id").cast("string").alias("id"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
                        role.cast("int").alias("r"), F.when(named != "", named).alias("named"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    style = F.pmod(F.xxhash64(F.coalesce("id", F.lit("")), F.lit("style")), F.lit(len(STYLES)))
    bare = F.pmod(F.xxhash64(F.coalesce("id", F.lit("")), "turn", F.lit("bare")), F.lit(8)) == 0

    def shown(form: str, names: tuple[str, ...]) -> Column:
        name = F.when(F.col("r").isNull(), F.col("named")).otherwise(F.element_at(F.array(*map(F.lit, names)), F.col("r") + 1))
        head, tail = form.split("{1}")[0].split("{0}")
        return F.concat(F.lit(head), name, F.lit(tail), "text")

    text = F.lit(None).cast("string")
    for k, (form, names) in enumerate(STYLES):
        text = F.when(style == k, shown(form, names)).otherwise(text)
    text = F.when(bare | (F.col("r").isNull() & F.col("named").isNull()), F.col("text")).otherwise(text)
    lines = rows.withColumn("shown", F.split(F.concat(text, F.lit("\n")), "\n")).select(
        "id", "turn", "r", "named", F.posexplode("shown").alias("k", "line"))
    filled = F.length(F.trim("line")) > 0
    # The first line that is not empty begins the turn; a turn always has at least one.
    first = lines.filter(filled).groupBy("id", "turn", "r", "named").agg(F.min("k").alias("first")).toDF("i", "t", "q", "own", "first")
    same = lines["id"].eqNullSafe(first["i"]) & (lines["turn"] == first["t"]) & lines["r"].eqNullSafe(first["q"]) & lines["named"].eqNullSafe(first["own"])
    state = F.when(F.col("k") == F.col("first"), 2 * F.col("r")).otherwise(2 * F.col("r") + 1)
    return lines.join(first, same).select(
        "id", F.floor(F.col("turn") / TURNS).alias("segment"), (F.col("turn") * (1 << 24) + F.col("k")).alias("pos"), "line",
        state.alias("state"), "turn", (F.floor(F.col("turn") / TURNS) == 0).alias("opens"))


def state_moves(lines: DataFrame) -> DataFrame:
    """(a, b, n): how often state b follows state a on the lines of known turns."""
    own = lines.filter((F.length(F.trim("line")) > 0) & F.col("state").isNotNull()).groupBy("id", "turn").agg(
        F.min("state").alias("s"), F.count(F.lit(1)).alias("n"))
    first = F.col("s") - F.col("s") % 2
    inside = own.select(first.alias("a"), (first + 1).alias("b"), (F.col("n") > 1).cast("long").alias("n")).unionByName(
        own.select((first + 1).alias("a"), (first + 1).alias("b"), F.greatest(F.col("n") - 2, F.lit(0)).alias("n")))
    ends = own.select("id", "turn", (first + (F.col("n") > 1).cast("int")).alias("a"))
    nexts = own.select(F.col("id").alias("i"), (F.col("turn") - 1).alias("t"), first.alias("b"))
    across = ends.join(nexts, ends["id"].eqNullSafe(nexts["i"]) & (ends["turn"] == nexts["t"])).select("a", "b", F.lit(1).cast("long").alias("n"))
    opening = own.filter("turn = 0").select(F.lit(START).alias("a"), first.alias("b"), F.lit(1).cast("long").alias("n"))
    return inside.unionByName(across).unionByName(opening)


def fold(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3, F.lit(0))


def digest(turns: DataFrame) -> DataFrame:
    """Transcripts made from ``turns``, parsed with a model from two thirds of the conversations.

    conv_id, held_out (not used for the model), turn, role, n_lines, speaker, rendered: one row per recovered turn.
    """
    lines = written(transcripts(turns), "transcripts")
    known = lines.filter(fold("id") != 1)
    model = learn(known, state_moves(known))
    out = parse(lines.select("id", "segment", "pos", "line"), model)
    return out.select(F.col("id").cast("long").alias("conv_id"), (fold("id") == 1).alias("held_out"), "turn", "role", "n_lines", "speaker", "rendered")
