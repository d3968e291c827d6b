"""Conversations repaired to legal turns at least cost, and rendered for training."""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.llm.text import record
from gustline.sources.shared import write_stage

#: The roles, their other names, and the costs of the repairs.
ROLES = ("system", "user", "assistant")
NAMES = {"human": "user", "prompter": "user", "customer": "user", "bot": "assistant", "gpt": "assistant", "ai": "assistant", "model": "assistant", "developer": "system"}
MERGE, RELABEL, RELABEL_UNKNOWN, INSERT = 1, 6, 1, 4
#: What begins a turn, ends it, and joins merged texts.
OPEN, CLOSE, JOIN = "<|{role}|>\n", "<|end|>\n", "\n"

#: States of the automaton: nothing yet, then the role of the last turn. A conversation may begin with one system
#: turn, goes on with user and assistant in turn, and ends with the assistant.
STATES = ("start", *ROLES)
NEXT = {("start", "system"), ("start", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}
N = len(STATES)
FAR = 10**12


def _moves() -> dict[tuple[int, int], tuple[int, tuple[int, ...], bool]]:
    """For (state, role of a turn as written): least cost, roles inserted before it, and whether it is merged."""
    found = {}
    for state in range(N):
        reached = {state: (0, ())}
        for _ in range(N):
            for s, (cost, path) in list(reached.items()):
                for t in range(1, N):
                    if (STATES[s], STATES[t]) in NEXT and reached.get(t, (FAR,))[0] > cost + INSERT:
                        reached[t] = (cost + INSERT, (*path, t))
        for role in range(1, N):
            options = [(cost, path, False) for s, (cost, path) in reached.items() if (STATES[s], STATES[role]) in NEXT]
            if state == role:
                options.append((MERGE, (), True))
            if options:
                found[state, role] = min(options)
    return found


MOVES = _moves()
PIECES = "array<struct<role:string,rendered:string>>"


def _step(given: int) -> tuple[np.ndarray, np.ndarray]:
    """Cost of each change of state that a turn of the given role (0: unknown) makes."""
    cost = np.full((N, N), FAR, np.int64)
    for (state, role), (moved, _, _) in MOVES.items():
        cost[state, role] = moved + (0 if role == given else RELABEL_UNKNOWN if given == 0 else RELABEL)
    return cost


STEPS = np.array([_step(given) for given in range(N)])


def ending(state: int) -> tuple[int, tuple[int, ...]]:
    """Cost of ending in a state, and the roles inserted to end with the assistant; nothing ends an empty conversation."""
    return {0: (0, ()), 1: (2 * INSERT, (2, 3)), 2: (INSERT, (3,)), 3: (0, ())}[state]


def solve(given: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each first state, the cost of each last state, and for each pair of them the state after every turn.

    Ties go to the lower state before. The second array is (first, last, turn).
    """
    cost = np.where(np.eye(N, dtype=bool), 0, FAR)
    came = np.zeros((len(given), N, N), np.int8)
    for k, role in enumerate(given):
        options = cost[:, :, None] + STEPS[role][None]
        came[k] = options.argmin(axis=1)
        cost = np.minimum(options.min(axis=1), FAR)
    paths = np.zeros((N, N, len(given)), np.int8)
    at = np.tile(np.arange(N), (N, 1))
    firsts = np.arange(N)[:, None]
    for k in range(len(given) - 1, -1, -1):
        paths[:, :, k] = at
        at = came[k][firsts, at]
    return cost, paths


def role_number(role: str | None) -> int:
    name = (role or "").strip().lower()
    name = NAMES.get(name, name)
    return ROLES.index(name) + 1 if name in ROLES else 0


SOLVED = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("chunk", pa.int64()), ("place", pa.int64()),
    ("given", pa.int64()), ("last", pa.bool_()), ("alone", pa.int64()), ("befores", pa.list_(pa.int8())), ("states", pa.list_(pa.int8())), ("costs", pa.list_(pa.int64())),
])


def _chunks(batches):
    """Of each conversation's turns in this task: the states before and after every turn on all paths, the
    last state if the conversation lies here as a whole (alone), and the costs at the last turn."""
    task = TaskContext.get().partitionId()
    turns, place = [], 0

    def solved():
        cost, paths = solve([role_number(t[2]) for t in turns])
        states = np.moveaxis(paths, 2, 0).reshape(len(turns), -1)
        befores = np.concatenate([np.repeat(np.arange(N, dtype=np.int8), N)[None], states[:-1]])
        alone = int(np.argmin(cost[0] + [ending(s)[0] for s in range(N)]))
        for start in range(0, len(turns), 4096):
            part = turns[start : start + 4096]
            ends = [start + k == len(turns) - 1 for k in range(len(part))]
            yield record(SOLVED, *zip(*(
                (*t, task, place + start + k, role_number(t[2]), end, alone, b.tolist(), s.tolist(), cost.ravel().tolist() if end else None)
                for k, (t, b, s, end) in enumerate(zip(part, befores[start:], states[start:], ends))
            )))

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns[:4])):
            if turns and row[0] != turns[0][0]:
                yield from solved()
                place += len(turns)
                turns = []
            turns.append(row)
    if turns:
        yield from solved()


def _choose(rows: list) -> dict[tuple, tuple[int, int, bool, bool]]:
    """Entry and exit state of each chunk of the conversations that more than one chunk holds, and whether it is the first or last."""
    by: dict = {}
    for conv, chunk, costs in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        by.setdefault(conv, []).append((chunk, np.array(costs).reshape(N, N)))
    found = {}
    for conv, parts in by.items():
        if len(parts) < 2:
            continue
        cost, came = np.array([0] + [FAR] * (N - 1)), []
        for _, matrix in parts:
            options = cost[:, None] + matrix
            came.append(options.argmin(axis=0))
            cost = options.min(axis=0)
        state = int(np.argmin(cost + [ending(s)[0] for s in range(N)]))
        for k in range(len(parts) - 1, -1, -1):
            before = int(came[k][state])
            found[conv, parts[k][0]] = (before, state, k == len(parts) - 1)
            state = before
    return found


def repair(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per turn, given or inserted: conv_id, place, turn, role, new_role, action and rendered.

    The automaton accepts an optional system turn, then user and assistant in turn, ending with the
    assistant. Dynamic programming over its states finds the cheapest way to get there: a turn keeps its
    role, is relabelled (6; 1 if its role is unknown), is merged into the one before (1), and empty turns are inserted (4). `action` tells
    which: keep, relabel, merge, relabel and merge, or insert. The `rendered` pieces of a conversation, joined in order of `place` and
    `part`, are its training text.

    Turns are sorted by (conversation, turn) over ranges, so that a conversation with a third of all turns
    lies in many tasks. Each task solves its stretch of a conversation for all first and last states at once; only
    conversations that cross the border of a task (two for each task at most) need their costs composed,
    and that is what the driver sees. Turns with equal numbers are in order of role and text; a null number comes first. Null
    roles are unknown, null texts are empty. Rows of a null conversation are one conversation. Repeated rows are turns of their own.
    """
    spark = conversations.sparkSession
    read = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text")
    )
    keys = ["conv_id", "turn", "role", "digest", "row"]
    ranged = read.withColumn("digest", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys)
    fields = "conv_id long, turn long, role string, text string, chunk long, place long, given long, last boolean, alone long, befores array<tinyint>, states array<tinyint>, costs array<long>"
    solved = write_stage(ranged.select("conv_id", "turn", "role", "text").mapInArrow(_chunks, fields), "turns")

    ends = solved.where("last").select("conv_id", "chunk", "place", "costs")
    edge = ends.groupBy("chunk").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    borders = ends.join(edge, "chunk").where("place = low or place = high").select("conv_id", "chunk", "costs").collect()
    chosen = _choose([tuple(r) for r in borders])
    table = spark.createDataFrame(
        [(c is None, c or 0, k, *v) for (c, k), v in chosen.items()],
        "lost boolean, number long, chunk long, entry int, exit int, final boolean",
    )
    keyed = solved.withColumn("lost", F.col("conv_id").isNull()).withColumn("number", F.coalesce("conv_id", F.lit(0).cast("long")))
    joined = keyed.join(table, ["lost", "number", "chunk"], "left")
    path = F.coalesce("entry", F.lit(0)) * N + F.coalesce(F.col("exit"), F.col("alone")) + 1
    joined = joined.withColumn("before", F.element_at("befores", path.cast("int")).cast("int")).withColumn("state", F.element_at("states", path.cast("int")).cast("int"))
    return _rendered(joined)


def _rendered(solved: DataFrame) -> DataFrame:
    """Each turn with what is inserted before it and, after the last one, at the end."""
    def opened(state: int, before: int) -> str:
        return (CLOSE if before else "") + OPEN.format(role=STATES[state])

    inserted, own, merged, ends = [], [], [], []
    for before in range(N):
        for role in range(N):
            _, path, joins = MOVES.get((before, role), (0, (), False))
            steps = list(zip((before, *path), path))
            inserted.append(F.array(*[F.struct(F.lit(STATES[t]).alias("role"), F.lit(opened(t, s)).alias("rendered")) for s, t in steps]).cast(PIECES))
            own.append(F.lit(JOIN if joins else opened(role, path[-1] if path else before) if role else ""))
            merged.append(F.lit(joins))
    for state in range(N):
        path = ending(state)[1]
        texts = [opened(t, s) for s, t in zip((state, *path), path)]
        ends.append(F.array(*[
            F.struct(F.lit(STATES[t]).alias("role"), F.lit(x + CLOSE * (k == len(path) - 1)).alias("rendered")) for k, (t, x) in enumerate(zip(path, texts))
        ]).cast(PIECES))

    def at(choices: list, index):
        return F.element_at(F.array(*choices), index + 1)

    move = F.col("before") * N + F.col("state")
    final = F.col("last") & F.coalesce("final", F.lit(True))
    after = F.when(final, at(ends, F.col("state"))).otherwise(F.array().cast(PIECES))
    relabelled, joins = F.col("state") != F.col("given"), at(merged, move)
    action = (
        F.when(relabelled & joins, "relabel and merge").when(joins, "merge").when(relabelled, "relabel").otherwise("keep")
    )
    close = F.when(final & (F.size(after) == 0), CLOSE).otherwise("")
    piece = F.struct(at([F.lit(s) for s in STATES], F.col("state")).alias("role"), F.concat(at(own, move), F.coalesce("text", F.lit("")), close).alias("rendered"))
    before = at(inserted, move)
    pieces = F.concat(before, F.array(piece).cast(PIECES), after)
    place = F.shiftleft("chunk", 40) + F.col("place")
    each = solved.select("conv_id", place.alias("place"), "turn", "role", action.alias("action"), F.size(before).alias("own"), F.posexplode(pieces).alias("part", "piece"))
    mine = F.col("part") == F.col("own")
    return each.select(
        "conv_id", "place", "part", F.when(mine, F.col("turn")).alias("turn"), F.when(mine, F.col("role")).alias("role"),
        F.col("piece.role").alias("new_role"), F.when(mine, F.col("action")).otherwise("insert").alias("action"), F.col("piece.rendered").alias("rendered"),
    )
