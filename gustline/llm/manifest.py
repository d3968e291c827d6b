"""A Merkle manifest of a table: parents keep copied SHA-256 states before each child slot, and proofs resume them."""

import hashlib
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustline.llm.text import record
from gustline.sources.shared import write_stage

#: Children of a parent.
ARITY = 8
#: Levels that one task builds, and so the nodes it holds at most.
LEVELS = 4
CHUNK = ARITY**LEVELS
#: Rows that a task sorts, about.
SORTED_ROWS = 2_000_000

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<slot:int,run:array<string>>>"


def leaf_of(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each as its count of bytes, a colon and the value, or a dash where it is null."""
    texts = [field.cast("string") for field in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _group_key(group: Column) -> Column:
    """A text that is never null and sorts as the group does, null first, bytewise."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def ranked(frame: DataFrame, group: str, *order: str) -> DataFrame:
    """The frame with `at`, each row's place in its group from 0, and `n`, the rows of the group.

    Rows are sorted by ranges, so a group that holds most rows spreads over many tasks; each task's first
    place follows from the counts of those before it. `order` must tell all rows of a group apart.
    """
    spark = frame.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-frame.count() // SORTED_ROWS))
    ranges = frame.repartitionByRange(parts, group, *order).sortWithinPartitions(group, *order)
    # The id counts the rows of a partition in their order, from the partition's number times 2^33.
    ranges = write_stage(ranges.withColumn("place", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("place", 33)
    runs = ranges.groupBy(group, part.alias("part")).agg(F.min("place").alias("first"), F.count("*").alias("c"))
    inside = Window.partitionBy(group)
    before = inside.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        group, "part", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("offset"), F.sum("c").over(inside).alias("n")
    )
    placed = ranges.withColumn("part", part).join(runs, [group, "part"])
    return placed.withColumn("at", F.col("place") + F.col("offset")).drop("place", "part", "offset")


def _sorted_nodes(chunk: pa.Table) -> pa.Table:
    return chunk.sort_by("at")


class Level:
    """The runs of one level: each parent's digest, and its hash states before each child, copied on the way."""

    def __init__(self, nodes: list[bytes]):
        self.runs = [nodes[k : k + ARITY] for k in range(0, len(nodes), ARITY)]
        self.joined = [b"".join(run) for run in self.runs]
        self.before, self.parents = [], []
        for run in self.runs:
            state, kept = hashlib.sha256(), []
            for child in run:
                kept.append(state.copy())
                state.update(child)
            self.before.append(kept)
            self.parents.append(state.hexdigest().encode())

    def fold(self, at: int, child: bytes) -> bytes:
        """The parent's digest with another child in its place: only that and its right siblings are hashed."""
        run, slot = divmod(at, ARITY)
        state = self.before[run][slot].copy()
        state.update(child)
        state.update(self.joined[run][(slot + 1) * len(child) :])
        return state.hexdigest().encode()

    def siblings(self, at: int) -> bytes:
        run, slot = divmod(at, ARITY)
        size = len(self.runs[run][slot])
        return self.joined[run][: slot * size] + self.joined[run][(slot + 1) * size :]


def levels(nodes: list[bytes], n: int) -> list[Level]:
    """The levels over one chunk of a row of `n` nodes: to the single one that remains, or LEVELS of them where more chunks follow."""
    built = []
    while (len(nodes) > 1) if n <= CHUNK else len(built) < LEVELS:
        built.append(Level(nodes))
        nodes = built[-1].parents
    return built


TOP = pa.schema([("g", pa.string()), ("at", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])
STEP = pa.struct([("slot", pa.int32()), ("run", pa.list_(pa.string()))])
WAY = pa.schema([("g", pa.string()), ("at", pa.int64()), ("path", pa.list_(STEP))])


def _top(chunk: pa.Table) -> pa.Table:
    """The node over a chunk, or the chunk's only node where its group is done."""
    chunk = _sorted_nodes(chunk)
    n = chunk.column("n")[0].as_py()
    nodes = [d.encode() for d in chunk.column("digest").to_pylist()]
    built = levels(nodes, n)
    digest = (built[-1].parents if built else nodes)[0].decode()
    at = chunk.column("at")[0].as_py() // CHUNK
    return pa.Table.from_batches([record(TOP, [chunk.column("g")[0].as_py()], [at], [-(-n // CHUNK)], [digest])])


def _ways(chunk: pa.Table) -> pa.Table:
    """For each node of a chunk the runs it and its parents stand in."""
    chunk = _sorted_nodes(chunk)
    built = levels([d.encode() for d in chunk.column("digest").to_pylist()], chunk.column("n")[0].as_py())
    paths = []
    for k in range(chunk.num_rows):
        path = []
        for level in built:
            path.append({"slot": k % ARITY, "run": [d.decode() for d in level.runs[k // ARITY]]})
            k //= ARITY
        paths.append(path)
    return pa.Table.from_batches([record(WAY, chunk.column("g").combine_chunks(), chunk.column("at").combine_chunks(), paths)])


def _chunks(nodes: DataFrame):
    return nodes.groupBy("g", F.expr(f"at div {CHUNK}"))


def climb(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The trees over written nodes (g, at, n, digest), one for each g: (g, at, path) of every node, and (g, digest) of the roots.

    A round takes chunks of 4,096 neighbours four levels up, so rounds are few and no task holds more than a chunk.
    """
    ways = nodes.select("g", "at", F.col("at").alias("up"), F.array().cast(PATH).alias("path"))
    while (nodes.agg(F.max("n")).first()[0] or 0) > 1:
        steps = _chunks(nodes).applyInArrow(_ways, f"g string, at long, path {PATH}")
        steps = steps.select("g", F.col("at").alias("up"), F.col("path").alias("more"))
        ways = ways.join(steps, ["g", "up"]).select("g", "at", F.expr(f"up div {CHUNK}").alias("up"), F.concat("path", "more").alias("path"))
        ways = write_stage(ways, "ways")
        nodes = write_stage(_chunks(nodes).applyInArrow(_top, "g string, at long, n long, digest string"), "nodes")
    return ways.select("g", "at", "path"), nodes.select("g", "digest")


PROVEN = pa.schema([
    ("id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
    ("proof_sha256", pa.string()), ("folded_root", pa.string()),
])


def _prove(chunk: pa.Table, way: pa.Table) -> pa.Table:
    """Fold each leaf of a chunk up to the root, and hash its siblings on the way."""
    if not chunk.num_rows:
        return PROVEN.empty_table()
    chunk = _sorted_nodes(chunk)
    leaves = [d.encode() for d in chunk.column("leaf").to_pylist()]
    changed = [d and d.encode() for d in chunk.column("changed").to_pylist()]
    built = levels(leaves, chunk.column("n")[0].as_py())
    above, beside = [], b""
    for step in way.column("path")[0].as_py():
        run, slot = [d.encode() for d in step["run"]], step["slot"]
        above.append((hashlib.sha256(b"".join(run[:slot])), b"".join(run[slot + 1 :])))
        beside += b"".join(run[:slot] + run[slot + 1 :])
    folded, proofs = [], []
    for at, (leaf, other) in enumerate(zip(leaves, changed)):
        digest, proof = other or leaf, hashlib.sha256()
        for level in built:
            digest = level.fold(at, digest)
            proof.update(level.siblings(at))
            at //= ARITY
        for before, right in above:
            state = before.copy()
            state.update(digest)
            state.update(right)
            digest = state.hexdigest().encode()
        proof.update(beside)
        folded.append(digest.decode())
        proofs.append(proof.hexdigest())
    subroot, root = ([way.column(name)[0].as_py()] * len(leaves) for name in ("subroot", "root"))
    return pa.Table.from_batches([record(PROVEN, chunk.column("id").combine_chunks(), chunk.column("leaf").combine_chunks(), subroot, root, proofs, folded)])


def audited(
    docs: DataFrame, altered: Mapping[str, Column] | None = None, when: Column | None = None,
    id_col: str = "doc_id", group_col: str = "lang", fields: tuple[str, ...] = FIELDS,
) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The leaf hashes the fields. The leaves of a group, by id, are the first level of a tree of runs of eight, whose top
    is the group's subroot; the subroots, by group, give the root in the same way. Then rows for which
    `when` holds are taken to have the values of `altered` instead of their columns, and each row's leaf is folded up
    on its own: every parent keeps copies of its hash state before each child, and the one before the leaf's slot
    goes on with the new digest and the right siblings. `verified` tells whether the root comes out again.

    Null fields are hashed as a dash, other than empty ones; null groups are a group and come first, and null ids come
    first in their group. Rows that share an id stand side by side in the order of their leaves; repeated rows have
    leaves of their own. A single row is its own root, with no siblings. An empty table gives none. Ranges of rows are
    sorted and chunks of 4,096 leaves are hashed in one task each, whatever the size of a group. Starts jobs while it is built.
    """
    altered, when = dict(altered or {}), F.coalesce(F.lit(False) if when is None else when, F.lit(False))
    kept = docs.select(
        _group_key(F.col(group_col)).alias("g"), F.col(id_col).cast("long").alias("id"), leaf_of([F.col(c) for c in fields]).alias("leaf"),
        F.when(when, leaf_of([altered.get(c, F.col(c)) for c in fields])).alias("changed"), F.monotonically_increasing_id().alias("seq"),
    )
    leaves = ranked(write_stage(kept, "leaves"), "g", "id", "leaf", "seq").drop("seq")
    nodes = _chunks(leaves.select("g", "at", "n", F.col("leaf").alias("digest"))).applyInArrow(_top, "g string, at long, n long, digest string")
    ways, subroots = climb(write_stage(nodes, "nodes"))
    tops = ranked(subroots.select(F.lit("").alias("all"), F.col("g").alias("member"), "digest"), "all", "member")
    tops = write_stage(tops.select(F.col("all").alias("g"), "at", "n", "digest", "member"), "subroots")
    upper, root = climb(tops.drop("member"))
    upper = tops.join(upper, ["g", "at"]).crossJoin(root.select(F.col("digest").alias("root"))).select(
        F.col("member").alias("g"), F.col("digest").alias("subroot"), "root", F.col("path").alias("more")
    )
    ways = ways.join(upper, "g").select("g", F.col("at").alias("chunk"), "subroot", "root", F.concat("path", "more").alias("path"))
    proven = leaves.withColumn("chunk", F.expr(f"at div {CHUNK}")).groupBy("g", "chunk").cogroup(ways.groupBy("g", "chunk")).applyInArrow(
        _prove, "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    )
    return proven.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
