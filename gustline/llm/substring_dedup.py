"""Passages that repeat earlier text, found by Rabin-Karp hashes of all fixed-length word windows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.llm.buckets import bucket_count, chunks, mix, pack, unpack
from gustline.llm.text import WordHashes, record, spaced_words, texts

#: Words of a window.
WIDTH = 20
#: Base of the polynomial over word hashes; odd, as the numbers are taken modulo 2**64.
BASE = 0x9E3779B97F4A7C15
#: Bytes of a window's hash that are sent; the bucket it is sent to holds some more bits.
SENT = 7
#: A null id stands before all others.
NO_ID = -(2**63)


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of every window of `width` word hashes, by joining windows of powers of two."""
    window, size, found, length = hashes, 1, None, 0
    while True:
        if width & size:
            if found is None:
                found = window
            else:
                n = max(0, min(len(window), len(found) - size))
                found = window[:n] * np.uint64(pow(BASE, length, 2**64)) + found[size : size + n]
            length += size
        if length == width:
            return found
        n = max(0, len(window) - size)
        window = window[:n] * np.uint64(pow(BASE, size, 2**64)) + window[size:]
        size *= 2


def _windows(rows: list, width: int):
    """Hash, row and start of each window of the chunk's rows, which are in order of their ids."""
    sizes = np.array([len(r[1]) for r in rows], np.int64)
    words = np.concatenate([r[1] for r in rows])
    row = np.repeat(np.arange(len(rows)), sizes)
    start = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = np.flatnonzero(start + width <= sizes[row])
    return mix(rolling(words, width)[inside]) if len(inside) else np.zeros(0, np.uint64), row[inside], start[inside]


def _later(hashes: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether an equal hash stands at a smaller (id, start)."""
    later = np.zeros(len(hashes), bool)
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    same = ordered[1:] == ordered[:-1]
    many = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])] if len(order) else order
    many = many[np.lexsort((starts[many], ids[many], hashes[many]))]
    if len(many):
        first = np.concatenate([[True], hashes[many][1:] != hashes[many][:-1]])
        lead = many[np.maximum.accumulate(np.where(first, np.arange(len(many)), 0))]
        later[many] = (ids[many] > ids[lead]) | (starts[many] > starts[lead])
    return later


def _runs(marks: np.ndarray, keys: np.ndarray):
    """(key, from, to) of the runs of equal keys in sorted `keys`; the places in `marks` go along."""
    cuts = np.flatnonzero(np.diff(keys)) + 1
    edges = np.concatenate([[0], cuts, [len(keys)]])
    return [(int(keys[a]), marks[a:b]) for a, b in zip(edges, edges[1:]) if b > a]


def _packed(ids, digests, row, start) -> tuple[bytes, bytes]:
    """Places in order of their rows: a table of rows with their number of places, and the starts' steps."""
    used, first, counts = np.unique(row, return_index=True, return_counts=True)
    steps = np.diff(start, prepend=0)
    steps[first] = start[first]
    table = pack(ids[used]) + pack(digests[used]) + pack(counts.astype(np.uint32))
    return table, pack(steps.astype(np.uint32))


def _unpacked(table: bytes, steps: bytes):
    """Ids, digests and row of each place, and the starts."""
    n = len(table) // 16
    ids, digests, counts = unpack(table[: 8 * n], np.int64), unpack(table[8 * n : 12 * n], np.uint32), unpack(table[12 * n :], np.uint32)
    row = np.repeat(np.arange(n), counts)
    total = np.cumsum(unpack(steps, np.uint32).astype(np.int64))
    offset = np.concatenate([[0], total])[np.cumsum(counts) - counts]
    return ids, digests, row, total - offset[row]


PLACES = pa.schema([("bucket", pa.int64()), ("table", pa.binary()), ("steps", pa.binary()), ("hashes", pa.binary())])


def _emit(rows: list, width: int, count: int):
    """A chunk's windows by bucket. Of equal ones the earliest is sent; the others are known to be repeated."""
    rows.sort(key=lambda r: r[0])
    ids = np.array([r[0] for r in rows], np.int64)
    digests = np.array([r[2] & 0xFFFFFFFF for r in rows], np.uint32)
    hashes, row, start = _windows(rows, width)
    later = _later(hashes, ids[row], start)
    bucket = (hashes % np.uint64(count)).astype(np.int64)
    sent = np.flatnonzero(~later)
    sent = sent[np.argsort(bucket[sent], kind="stable")]
    out = []
    for key, at in _runs(sent, bucket[sent]):
        out.append((key, *_packed(ids, digests, row[at], start[at]), pack(hashes[at] // np.uint64(count), SENT)))
    known = np.flatnonzero(later)
    home = mix(ids.view(np.uint64)) % np.uint64(count)
    known = known[np.argsort(home[row[known]], kind="stable")]
    for key, at in _runs(known, home[row[known]].astype(np.int64)):
        out.append((key, *_packed(ids, digests, row[at], start[at]), b""))
    return record(PLACES, *zip(*out)) if out else None


def _repeated(count: int):
    """Of one bucket, the places whose window stands earlier too, packed by the bucket of their document."""
    schema = pa.schema([("home", pa.int64()), ("table", pa.binary()), ("steps", pa.binary())])

    def reduce(table: pa.Table) -> pa.Table:
        out, parts = [], []
        for places, steps, hashes in zip(*(table.column(c).to_pylist() for c in ("table", "steps", "hashes"))):
            unpacked = _unpacked(places, steps)
            if hashes:
                parts.append((*unpacked, unpack(hashes, np.uint64, SENT)))
            else:
                home = int(mix(unpacked[0][:1].view(np.uint64))[0] % np.uint64(count))
                out.append((home, places, steps))
        if parts:
            shift = np.cumsum([0] + [len(p[0]) for p in parts])
            ids, digests = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            row = np.concatenate([p[2] + s for p, s in zip(parts, shift)])
            start, hashes = np.concatenate([p[3] for p in parts]), np.concatenate([p[4] for p in parts])
            del parts
            at = np.flatnonzero(_later(hashes, ids[row], start))
            home = (mix(ids.view(np.uint64)) % np.uint64(count)).astype(np.int64)
            at = at[np.argsort(home[row[at]], kind="stable")]
            for key, some in _runs(at, home[row[at]]):
                out.append((key, *_packed(ids, digests, row[some], start[some])))
        return pa.table(record(schema, *zip(*out)) if out else schema.empty_table())

    return reduce


RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
    ("removed", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), ("kept", pa.binary()),
])


def _cut(width: int):
    """Documents of one home bucket and the repeated places in them."""

    def each(docs: pa.Table, places: pa.Table) -> pa.Table:
        found: dict[tuple, list] = {}
        for table, steps in zip(places.column("table").to_pylist(), places.column("steps").to_pylist()):
            ids, digests, row, start = _unpacked(table, steps)
            for k, at in _runs(start, row):
                found.setdefault((int(ids[k]), int(digests[k])), []).append(at)
        columns = [[], [], [], [], []]
        for key, name, digest, text in zip(*(docs.column(c).to_pylist() for c in ("id", "doc_id", "digest", "text"))):
            words = spaced_words(text)
            marks = np.zeros(len(words) + 1, np.int64)
            for at in found.get((key, digest & 0xFFFFFFFF), []):
                np.add.at(marks, at, 1)
                np.add.at(marks, at + width, -1)
            inside = np.cumsum(marks[:-1]) > 0
            edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]))).reshape(-1, 2).tolist()
            kept, last = [], 0
            for a, b in edges:
                kept += words[last:a]
                last = b
            kept += words[last:]
            spans = [{"start": a, "stop": b} for a, b in edges]
            for column, value in zip(columns, (name, len(words), int(inside.sum()), spans, b" ".join(kept))):
                column.append(value)
        return pa.table(record(RESULT, *columns))

    return each


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, removed (maximal intervals of words) and kept (text).

    A word goes if a window of `width` words covers it whose words stand in another window with a
    smaller doc_id, or at an earlier start of the same document. Three steps, each a shuffle of packed rows:

    1. Documents, in chunks of a million words, give the hash of every window to the bucket of
       the hash. A chunk sends the earliest of equal windows only, so a passage that stands in a
       third of all documents costs a few rows for each chunk, however often it occurs.
    2. A bucket, of bounded size since hashes are even, finds the windows that stand earlier elsewhere.
    3. Those places meet their documents, and cover words.

    A window is known by its bucket and 56 more bits of its hash. Among n windows about n * n / 2**63 pairs
    are taken for equal that are not. Null and empty texts, and those of fewer words than a window, lose nothing.
    Rows with equal id are the same document: they don't remove each other's words at equal
    starts. A null id stands before all others. Kept words are joined by single spaces.
    """
    count = bucket_count(docs, text_col)
    read = texts(docs, id_col, text_col, F.xxhash64(F.col(text_col).cast("string")).alias("digest"))

    def send(batches):
        known = WordHashes()

        def words_of(text):
            words = spaced_words(text)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

        for rows in chunks(batches, 3, words_of):
            known.trim()
            batch = _emit(rows, width, count)
            if batch is not None:
                yield batch

    windows = read.withColumn("id", F.coalesce("id", F.lit(NO_ID))).mapInArrow(send, "bucket long, table binary, steps binary, hashes binary")
    places = windows.groupBy("bucket").applyInArrow(_repeated(count), "home long, table binary, steps binary")

    def home(batches):
        schema = pa.schema([("home", pa.int64()), ("id", pa.int64()), ("doc_id", pa.int64()), ("digest", pa.int64()), ("text", pa.binary())])
        for batch in batches:
            ids = batch.column(0).fill_null(NO_ID)
            homes = mix(ids.to_numpy(zero_copy_only=False).view(np.uint64)) % np.uint64(count)
            yield record(schema, homes.astype(np.int64), ids, batch.column(0), batch.column(2), batch.column(1))

    texts_home = read.mapInArrow(home, "home long, id long, doc_id long, digest long, text binary")
    done = texts_home.groupBy("home").cogroup(places.groupBy("home")).applyInArrow(
        _cut(width), "doc_id long, n_words long, n_removed long, removed array<struct<start:int,stop:int>>, kept binary"
    )
    return done.withColumn("kept", F.col("kept").cast("string"))


def repeats_digest(docs: DataFrame) -> DataFrame:
    """The counts of `remove_repeats` and a hash of the kept text."""
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
