"""Ranked lexical search: sketches of the documents' largest impacts bound their scores, and exact rescoring follows the bounds down."""

import math
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gustline.llm.text import WordHashes, plain_words, record, slices, texts
from gustline.sources.shared import write_stage

#: Results of an item.
MOST = 50
#: Bytes of item texts that are searched for at once; they are sent to all workers. A larger set takes more passes over the index.
ITEM_BYTES = 4_000_000
#: Items, and terms of items, whose bounds are looked up together.
BATCH_ITEMS, BATCH_TERMS = 256, 8192
#: Coordinates of a sketch for each distinct term of its document, at least; the number of them is a power of two.
SPARSE = 4
#: Bounds and sketch coordinates that a task holds at once.
TILE = 2**22


def term_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, terms, counts) of the documents with a term: all terms with repeats, then the XXH64 of the distinct ones, in order, and how often each occurs.

    The last two are packed as 8 and 4 bytes a term. Null and wordless texts give no row.
    """
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("counts", pa.binary())])

    def each(batches):
        known = WordHashes()
        for part in slices(batches):
            known.trim()
            ids, out = part.column(0).to_pylist(), ([], [], [], [])
            for doc_id, text in zip(ids, part.column(1).to_pylist()):
                tally = Counter(plain_words(text))
                if not tally:
                    continue
                hashes = np.fromiter((known[word] for word in tally), np.uint64, len(tally))
                counts = np.fromiter(tally.values(), np.int64, len(tally))
                order = np.argsort(hashes)
                counts = np.minimum(counts[order], 2**31 - 1).astype(np.int32)
                for column, value in zip(out, (doc_id, tally.total(), hashes[order].tobytes(), counts.tobytes())):
                    column.append(value)
            yield record(schema, *out)

    return texts(docs, id_col, text_col).mapInArrow(each, "id long, n long, terms binary, counts binary")


def _flat(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """Packed numbers of all rows in a row, and where each row ends."""
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False)) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(column.to_pylist()), kind), ends.astype(np.int64)


def impacts(counts: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What an occurrence count is worth in a document of `n` terms, before the term's weight; all in 64-bit integers."""
    length = 100 - 50 + (50 * n * n_docs) // n_terms
    return (1_000_000_000 * counts) // (1000 * counts + 20 * length)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Lookup:
    """A batch of items: which coordinates of a sketch of some width they look up, and with which weights."""

    def __init__(self, items: list[tuple[int, np.ndarray, np.ndarray]]):
        """items: (row, hashes in order, weights)."""
        self.items, self.widths = items, {}

    def at(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(place of each coordinate among the looked-up ones, or -1; items x looked-up coordinates with the sums of weights)."""
        if width not in self.widths:
            coordinates = [(hashes & np.uint64(width - 1)).astype(np.int64) for _, hashes, _ in self.items]
            used = np.unique(np.concatenate(coordinates))
            place = np.full(width, -1, np.int32)
            place[used] = np.arange(len(used))
            weights = np.zeros((len(self.items), len(used)))
            for row, (own, (_, _, values)) in enumerate(zip(coordinates, self.items)):
                np.add.at(weights[row], place[own], values)
            self.widths[width] = place, weights
        return self.widths[width]


def batches_of(items) -> list[Lookup]:
    out, held, terms = [], [], 0
    for item in items:
        if held and (len(held) == BATCH_ITEMS or terms + len(item[1]) > BATCH_TERMS):
            out.append(Lookup(held))
            held, terms = [], 0
        held.append(item)
        terms += len(item[1])
    return out + [Lookup(held)] if held else out


class Best:
    """The best (score, id) so far of one item; ids as (missing, id), so that null ids come last among equals."""

    def __init__(self, most: int):
        self.most, self.rows = most, (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))

    @property
    def least(self) -> int:
        """The score that a document must reach; one that equals the last may still come before it by its id."""
        return int(self.rows[0][-1]) if len(self.rows[0]) == self.most else 1

    def add(self, *rows: np.ndarray) -> None:
        scores, missing, ids = (np.concatenate(pair) for pair in zip(self.rows, rows))
        order = np.lexsort((ids, missing, -scores))
        order = order[scores[order] > 0][: self.most]
        self.rows = scores[order], missing[order], ids[order]


class Block:
    """Documents of the index with the impacts of their terms."""

    def __init__(self, batch: pa.RecordBatch, n_docs: int, n_terms: int):
        ids = batch.column("id")
        self.missing, self.ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
        self.terms, self.ends = _flat(batch.column("terms"), np.uint64)
        counts, _ = _flat(batch.column("counts"), np.int32)
        self.sizes = np.diff(self.ends, prepend=0)
        self.impacts = impacts(counts.astype(np.int64), np.repeat(batch.column("n").to_numpy(), self.sizes), n_docs, n_terms)

    def postings(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For these documents: the number, among them, of the one each term belongs to, and the term's place in the block."""
        sizes = self.sizes[docs]
        owner = np.repeat(np.arange(len(docs)), sizes)
        first = self.ends[docs] - sizes
        return owner, np.arange(len(owner)) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)

    def tiles(self, lookup: Lookup):
        """(documents, upper bounds by item and document): sketches as wide as their documents need, folded and looked up."""
        widths = 2 ** np.ceil(np.log2(np.maximum(self.sizes, 16) * SPARSE)).astype(np.int64)
        for width in np.unique(widths).tolist():
            docs = np.flatnonzero(widths == width)
            place, weights = lookup.at(width)
            step = max(1, TILE // max(weights.shape))
            for start in range(0, len(docs), step):
                part = docs[start : start + step]
                owner, at = self.postings(part)
                column = place[(self.terms[at] & np.uint64(width - 1)).astype(np.int64)]
                used = column >= 0
                sketch = np.zeros(len(part) * weights.shape[1])
                np.maximum.at(sketch, owner[used] * weights.shape[1] + column[used], self.impacts[at[used]].astype(np.float64))
                yield part, weights @ sketch.reshape(len(part), -1).T

    def exact(self, docs: np.ndarray, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        owner, at = self.postings(docs)
        place = np.minimum(np.searchsorted(hashes, self.terms[at]), len(hashes) - 1)
        same = hashes[place] == self.terms[at]
        scores = np.zeros(len(docs), np.int64)
        np.add.at(scores, owner[same], weights[place[same]] * self.impacts[at[same]])
        return scores


def rescore(block: Block, lookup: Lookup, best: dict[int, Best], most: int) -> int:
    """Follow the bounds of each item down until no document left can reach its last result; the number of exact scores."""
    rescored = 0
    for docs, bounds in block.tiles(lookup):
        bounds *= 1 + 1e-9  # sums beyond 2^53 are rounded
        goals = np.array([best[row].least if row in best else 1 for row, _, _ in lookup.items])
        for k in np.flatnonzero((bounds >= goals[:, None]).any(axis=1)).tolist():
            row, hashes, weights = lookup.items[k]
            own = best.setdefault(row, Best(most))
            left = np.flatnonzero(bounds[k] >= own.least)
            left, step = left[np.argsort(-bounds[k, left], kind="stable")], most
            while len(left) and bounds[k, left[0]] >= own.least:
                now = docs[left[:step]]
                own.add(block.exact(now, hashes, weights), block.missing[now], block.ids[now])
                left, step, rescored = left[step:], 2 * step, rescored + len(now)
                left = left[bounds[k, left] >= own.least]
    return rescored


def _frequencies(index: DataFrame, asked) -> dict[int, int]:
    """In how many documents each of the asked terms (hashes in order, sent to the workers) occurs."""
    schema = pa.schema([("term", pa.int64()), ("df", pa.int64())])

    def each(batches):
        terms = asked.value
        found = np.zeros(len(terms), np.int64)
        for part in slices(batches, 2048):
            hashes, _ = _flat(part.column(0), np.uint64)
            place = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
            found += np.bincount(place[terms[place] == hashes], minlength=len(terms))
        used = np.flatnonzero(found)
        yield record(schema, used, found[used])

    counted = index.select("terms").mapInArrow(each, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {r.term: r.df for r in counted.collect()}


def _parts(items: DataFrame, id_col: str, text_col: str, most: int):
    """Lists of (item id, hashes of the terms in order) whose texts have about `most` bytes, one list at a time."""
    held, size = [], 0
    for item, text in texts(items, id_col, text_col).toLocalIterator():
        words = set(plain_words(text))
        if words:
            held.append((item, np.unique(np.fromiter(map(WordHashes().__missing__, words), np.uint64, len(words)))))
            size += len(text)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _search_part(index: DataFrame, items: list, totals: tuple[int, int], most: int) -> DataFrame:
    context = index.sparkSession.sparkContext
    terms = np.unique(np.concatenate([hashes for _, hashes in items]))
    df = _frequencies(index, context.broadcast(terms))
    weights = np.array([weight(df.get(k, 0), totals[0]) for k in range(len(terms))], np.int64)
    asked = context.broadcast([(row, hashes, weights[np.searchsorted(terms, hashes)]) for row, (_, hashes) in enumerate(items)])
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def each(batches):
        lookups, best = batches_of(asked.value), {}
        for part in slices(batches, 8192):
            block = Block(part, *totals)
            for lookup in lookups:
                rescore(block, lookup, best, most)
        for row, own in best.items():
            scores, missing, ids = own.rows
            yield record(schema, [row] * len(ids), pa.array(ids, mask=missing), scores)

    found = index.mapInArrow(each, "row long, doc_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    names = index.sparkSession.createDataFrame([(row, item) for row, (item, _) in enumerate(items)], "row long, item_id long")
    return ranked.join(names, "row").select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, most: int = MOST, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """For each item its `most` documents of highest score above 0: item_id, rank, doc_id, score.

    The texts are read once and written as an index of term counts. Over that, each task folds the impacts
    of a document's terms into a sketch, the largest impact by hashed coordinate, at least four coordinates for each
    distinct term; items are looked up in batches, and weights times sketch give no less than the score. Then documents
    are scored exactly in the order of their bounds until the next bound is below the item's last result
    so far, which a task keeps from block to block. The tasks' lists, of `most` rows an item, meet at the end. Terms are known by 64 bits.

    Null and wordless texts, of documents or items, have no results. Equal scores go to the smaller id, null ids last;
    repeated documents are results of their own, and each item row has its own list. Empty tables give no rows.
    Item texts beyond `item_bytes` are searched for in several passes. Starts jobs while it is built.
    """
    index = write_stage(term_index(docs, id_col, text_col), "terms")
    totals = tuple(index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first())
    empty = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    parts = _parts(items, item_id, item_text, item_bytes)
    first = next(parts, None)
    if first is None or not totals[0]:
        return empty
    second = next(parts, None)
    if second is None:
        return _search_part(index, first, totals, most)
    found = empty
    for part in chain([first, second], parts):
        found = found.union(write_stage(_search_part(index, part, totals, most), "found"))
    return found
