"""Exact top-k search: score histograms, refined digit by digit, find each query's kth score; a last pass filters by it."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gustline.llm.text import record
from gustline.sources.shared import write_stage

#: A component x becomes floor(SCALE * x).
SCALE = 64
#: Results of a query.
MOST = 20
#: Bits of a score that one histogram tells apart.
DIGIT = 8
#: Components of the candidates, and of the queries, that meet in one cell, about; a cell is all a task holds.
CELL, QUERY_CELL = 2**19, 2**17
#: Scores that a task holds at once.
TILE = 2**21
#: Partitions that cells are dealt to at most, beyond the session's shuffle partitions; a partition takes cell after cell.
MOST_PARTITIONS = 10_000


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, v): integer components of the vectors that are whole; null vectors and those with null or non-finite components go."""
    inside = F.col(vector_col).cast("array<double>")
    whole = F.forall(inside, lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf)))
    used = vectors.where(inside.isNotNull()).where(whole)
    return used.select(F.col(id_col).cast("long").alias("id"), F.transform(inside, lambda x: _whole(x * scale)).alias("v"))


def _whole(x: Column) -> Column:
    return F.when(F.abs(x) < F.lit(2.0**62), F.floor(x)).otherwise(F.raise_error(F.lit("a component does not fit 64 bits")))


def _matrix(values: pa.ChunkedArray) -> tuple[list[np.ndarray], np.ndarray]:
    """The components of each list, and the lengths."""
    lists = values.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    ends = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])], np.diff(ends)


def _tiles(vectors: list[np.ndarray], order: np.ndarray, rows: int):
    """Parts of the vectors as matrices, the shorter ones of a part filled up with zeros."""
    start = 0
    while start < len(order):
        stop, width = start, 1
        while stop < len(order) and stop - start < rows:
            wider = max(width, len(vectors[order[stop]]))
            if stop > start and (stop + 1 - start) * wider > TILE:
                break
            stop, width = stop + 1, wider
        part = np.zeros((stop - start, width), np.int64)
        for k, at in enumerate(order[start:stop]):
            part[k, : len(vectors[at])] = vectors[at]
        yield order[start:stop], part
        start = stop


def _products(queries: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Inner products of all rows, exact: doubles hold integers up to 2^53, beyond that 64-bit integers multiply."""
    width = min(queries.shape[1], others.shape[1])
    queries, others = queries[:, :width], others[:, :width]
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(others).max(initial=0)) * width
    if largest < 2**53:
        return (queries.astype(np.float64) @ others.astype(np.float64).T).astype(np.int64)
    return queries @ others.T


def _scored(cell: pa.Table, shift: int):
    """For tiles of a cell: places of queries and candidates, and the scores plus `shift`; a query's own row has -1."""
    vectors, sizes = _matrix(cell.column("v"))
    rows = cell.column("row").to_numpy()
    asks = cell.column("query").to_numpy().astype(bool)
    ids = cell.column("id")
    missing, ids = ids.is_null().to_numpy(), ids.fill_null(0).to_numpy()
    queries = np.flatnonzero(asks)[np.argsort(sizes[asks], kind="stable")]
    others = np.flatnonzero(~asks)
    # Smaller ids first, null ids last; the lengths are mostly equal, so long vectors spoil few tiles.
    others = others[np.lexsort((rows[others], ids[others], missing[others]))]
    for q_at, q in _tiles(vectors, queries, 512):
        place = {row: k for k, row in enumerate(rows[q_at].tolist())}
        for c_at, c in _tiles(vectors, others, TILE // 512):
            scores = _products(q, c) + shift
            for k, row in enumerate(rows[c_at].tolist()):
                if row in place:
                    scores[place[row], k] = -1
            yield q_at, c_at, scores


def _digits(cell: pa.Table, shift: int, place: int, out: pa.Schema) -> pa.Table:
    """Of the scores that begin as the query's kth does, the next digit's histogram, as far down as it can matter."""
    counts = {}
    prefix, need = cell.column("prefix").to_numpy(), cell.column("need").to_numpy()
    for q_at, _, scores in _scored(cell, shift):
        alive = scores >> (place + DIGIT) == prefix[q_at][:, None] if place + DIGIT < 63 else scores >= 0
        rows, cols = np.nonzero(alive)
        digit = (scores[rows, cols] >> place) & (2**DIGIT - 1)
        found = np.bincount(rows * 2**DIGIT + digit, minlength=len(q_at) * 2**DIGIT).reshape(len(q_at), -1)
        for k, at in enumerate(q_at.tolist()):
            counts[at] = counts.get(at, 0) + found[k]
    at = np.array(list(counts), np.int64)
    table = np.array(list(counts.values()), np.int64).reshape(len(at), 2**DIGIT)
    higher = table[:, ::-1].cumsum(axis=1)[:, ::-1] - table
    # This cell alone has enough scores above the digits that are left out.
    k, digit = np.nonzero((table > 0) & (higher < need[at][:, None]))
    return pa.Table.from_batches([record(out, cell.column("row").to_numpy()[at[k]], digit, table[k, digit])])


def _winners(cell: pa.Table, shift: int, out: pa.Schema) -> pa.Table:
    """Scores above the kth, and of those equal to it the first ones by id, as many as may be needed."""
    prefix, need = cell.column("prefix").to_numpy(), cell.column("need").to_numpy()
    rows, found, equal = cell.column("row").to_numpy(), [], {}
    ids = cell.column("id").combine_chunks()
    for q_at, c_at, scores in _scored(cell, shift):
        kth = prefix[q_at][:, None]
        ties = scores == kth
        before = np.array([equal.get(at, 0) for at in q_at.tolist()])[:, None]
        k, c = np.nonzero((scores > kth) | (ties & (before + ties.cumsum(axis=1) <= need[q_at][:, None])))
        for at, more in zip(q_at.tolist(), ties.sum(axis=1).tolist()):
            equal[at] = equal.get(at, 0) + more
        found.append((q_at[k], c_at[c], scores[k, c] - shift))
    q, c, scores = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3))
    return pa.Table.from_batches([record(out, rows[q], ids.take(pa.array(q)), ids.take(pa.array(c)), rows[c], scores)])


def _each(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _cells(staged: DataFrame, queries: DataFrame, n_blocks: int, n_query_blocks: int) -> DataFrame:
    """Every block of queries beside every block of rows, as the groups (c, q)."""
    marks = [F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("need")]
    rows = staged.select(
        F.pmod(F.xxhash64("row"), F.lit(n_blocks)).alias("c"), _each(n_query_blocks).alias("q"),
        F.lit(False).alias("query"), "row", "id", "v", *marks,
    )
    asked = queries.select(
        _each(n_blocks).alias("c"), F.pmod(F.xxhash64("row"), F.lit(n_query_blocks)).alias("q"),
        F.lit(True).alias("query"), "row", "id", "v", "prefix", "need",
    )
    shuffles = int(staged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(n_blocks * n_query_blocks, max(MOST_PARTITIONS, shuffles))
    return rows.union(asked).repartition(parts, "c", "q").groupBy("c", "q")


def top_products(
    vectors: DataFrame, is_query: Column | None = None, most: int = MOST,
    id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the `most` rows of highest integer inner product.

    Queries are the rows for which `is_query` holds (ids divisible by 20 unless told), candidates
    all rows but the query's own. Blocks of queries meet blocks of rows in cells of bounded size, so scores
    are never stored. Scores are read as digits of 8 bits. Each round scores everything and adds up, for
    every query, the histogram of the next digit among the scores that begin as its kth does;
    the digit in which the kth score lies is then known. After the last digit so is the kth score, and one more round
    keeps what is above it and, of its equals, the smallest ids. Rounds are written to the shared folder.

    Vectors that are null or hold null or non-finite components take no part. A shorter vector counts as filled up
    with zeros; an empty one scores 0. Equal scores go to the smaller id, null ids last. A row with a null id is a
    candidate but no query. Rows that share an id are rows of their own: each is a candidate for the others, and each
    query row has its own list. No rows, or a single one, give none. Vectors so large that a product may not fit
    62 bits are refused with a ValueError. Starts jobs while it is built.
    """
    asks = F.coalesce((F.col("id") % 20 == 0) if is_query is None else is_query, F.lit(False))
    used = quantised(vectors, id_col, vector_col, scale)
    staged = write_stage(used.select(F.monotonically_increasing_id().alias("row"), "id", "v"), "vectors")
    size = F.size("v").cast("long")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
    totals = staged.agg(
        F.count("*").alias("n"), F.sum(size).alias("size"), F.sum(F.when(asks, size)).alias("query_size"),
        F.count_if(asks).alias("n_queries"), F.max(norm).alias("longest"), F.max(F.when(asks, norm)).alias("longest_query"),
    ).first()
    layout = "query_id long, rank int, vec_id long, score long"
    wanted = min(most, totals.n - 1)
    if not totals.n_queries or wanted < 1:
        return vectors.sparkSession.createDataFrame([], layout)
    shift = int(totals.longest * totals.longest_query * (1 + 1e-9)) + 1
    if shift >= 2**62:
        raise ValueError("inner products of these vectors may not fit 64 bits")
    blocks = -(-totals.size // CELL) or 1, -(-totals.query_size // QUERY_CELL) or 1

    asked = staged.where(asks)
    state = asked.select("row", F.lit(0).cast("long").alias("prefix"), F.lit(wanted).cast("long").alias("need"))
    places = -(-(2 * shift).bit_length() // DIGIT)
    counted = pa.schema([("row", pa.int64()), ("digit", pa.int64()), ("n", pa.int64())])
    down = Window.partitionBy("row").orderBy(F.desc("digit"))
    for place in range((places - 1) * DIGIT, -1, -DIGIT):
        cells = _cells(staged, asked.join(state, "row"), *blocks)
        found = cells.applyInArrow(_step(_digits, shift, place, counted), "row long, digit long, n long")
        found = found.groupBy("row", "digit").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(down))
        above = F.col("upto") - F.col("n")
        state = write_stage(
            found.join(state, "row").where((above < F.col("need")) & (F.col("upto") >= F.col("need"))).select(
                "row", (F.col("prefix") * 2**DIGIT + F.col("digit")).alias("prefix"), (F.col("need") - above).alias("need")
            ),
            "kth-digits",
        )
    won = pa.schema([("row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("other", pa.int64()), ("score", pa.int64())])
    found = _cells(staged, asked.join(state, "row"), *blocks).applyInArrow(
        _step(_winners, shift, won), "row long, query_id long, vec_id long, other long, score long"
    )
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "other")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= wanted)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _step(function, *arguments):
    def each(cell: pa.Table) -> pa.Table:
        return function(cell, *arguments)

    return each
