"""A bigram language model in a log-frequency Bloom filter, and exact unigram scores beside it."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.llm.buckets import bucket_count, chunks, mix, pack, unpack
from gustline.llm.text import WordHashes, record, texts
from gustline.sources.shared import write_stage

#: Hashes of the end of a text, which is a token, and of its start, which is a context only.
END, START = 0x9AE16A3B2F90404F, 0xC949D7C7509E6557
#: Counts are held as levels: level q stands for counts from RATIO ** (q - 1) on.
RATIO = 1.5
#: Bits of the filter for each n-gram and level, and bits that each sets.
BITS_EACH, PROBES = 10, 4
#: Bytes of a bigram's hash beside its bucket: of the million or two in a bucket, about one pair is taken for another.
PAIR_BYTES = 5
#: The same of a token's hash; a bucket with 400,000 tokens takes one for another with a chance of one in a million.
WORD_BYTES = 7
#: Contexts of more frequent levels share the mixing weight of the last.
LEVELS = 64
#: Words of a chunk of documents that are packed together.
CHUNK_WORDS = 500_000
#: Documents whose crc32(id as text) modulo FOLDS is HELD are not learnt from.
FOLDS, HELD = 5, 1
NO_ID = -(2**63)

STEP, ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def kept(hashes: np.ndarray, count: int, size: int) -> np.ndarray:
    """The bucket and `size` more bytes of hashes, as these are sent."""
    n = np.uint64(count)
    return (hashes // n & np.uint64(2 ** (8 * size) - 1)) * n + hashes % n


def pairs(left: np.ndarray, right: np.ndarray, count: int) -> np.ndarray:
    """Hashes of token pairs."""
    return kept(mix(left * ODD + mix(right)), count, PAIR_BYTES)


def levels(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / np.log(RATIO) + 1e-9).astype(np.int64)


def mean_count(level: np.ndarray) -> np.ndarray:
    """The middle of the whole counts that have the level; 0 for level 0."""
    low = np.ceil(RATIO ** (level - 1.0) - 1e-9)
    high = np.ceil(RATIO**level * 1.0 - 1e-9) - 1
    return np.where(level > 0, (low + np.maximum(low, high)) / 2, 0.0)


class Filter:
    """The bits of one bucket's n-grams."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, keys: np.ndarray, level: int) -> np.ndarray:
        found = np.full(len(keys), len(self.bits) > 0)
        if len(self.bits):
            for place in places(keys, level, np.uint64(8 * len(self.bits))):
                found &= (self.bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found

    def level(self, keys: np.ndarray) -> np.ndarray:
        """The level up to which all lower ones are in the filter."""
        out, left, level = np.zeros(len(keys), np.uint8), np.arange(len(keys)), 0
        while len(left):
            level += 1
            left = left[self.has(keys[left], level)]
            out[left] = level
        return out


def places(keys: np.ndarray, level, size):
    """The bits of an n-gram at a level, in a block of `size` bits."""
    one = mix(keys + STEP * np.asarray(level, np.uint64))
    two = mix(one ^ STEP) | np.uint64(1)
    for k in range(PROBES):
        yield (one + np.uint64(k) * two) % size


def block(keys: np.ndarray, counts: np.ndarray, bits_each: int = BITS_EACH) -> np.ndarray:
    """The bits of a bucket's n-grams, each at every level up to that of its count."""
    level = levels(counts)
    size = -(-int(level.sum()) * bits_each // 64) * 64
    bits = np.zeros(size // 8, np.uint8)
    for step in range(1, int(level.max(initial=0)) + 1):
        for place in places(keys[level >= step], step, np.uint64(size)):
            np.bitwise_or.at(bits, (place >> np.uint64(3)).astype(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
    return bits


def held_out(ident: int | None) -> bool:
    return ident is not None and zlib.crc32(str(ident).encode()) % FOLDS == HELD


def _tokens(known: WordHashes):
    def of(text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    return of


def _grams(tokens: np.ndarray, sizes: np.ndarray, count: int) -> np.ndarray:
    """For each token the hash of it and the one before it, or the start."""
    before = np.concatenate([[np.uint64(START)], tokens[:-1]])
    before[np.cumsum(sizes) - sizes] = START
    return pairs(before, tokens, count)


def _dealt(home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys by bucket, and the buckets in that order."""
    order = np.argsort(home, kind="stable")
    return order, home[order]


#: What a chunk sends to the buckets; the last four stand in one row of each chunk, and pass through.
OWN = [("ids", pa.binary()), ("sizes", pa.binary()), ("homes", pa.binary()), ("place", pa.binary())]
SENT = pa.schema([
    ("bucket", pa.int64()), ("chunk", pa.int64()), ("words", pa.binary()), ("trained", pa.binary()), ("pairs", pa.binary()),
    ("pair_counts", pa.binary()), *OWN,
])
SENT_FIELDS = "bucket long, chunk long, words binary, trained binary, pairs binary, pair_counts binary, ids binary, sizes binary, homes binary, place binary"


def _emit(rows: list, count: int, number: int) -> pa.RecordBatch:
    """A chunk's distinct tokens and bigrams with their counts in training texts, by bucket."""
    sizes = np.array([len(r[1]) + 1 for r in rows], np.int64)
    tokens = kept(np.concatenate([x for r in rows for x in (r[1], np.array([END], np.uint64))]), count, WORD_BYTES)
    ids = np.array([NO_ID if r[0] is None else r[0] for r in rows], np.int64)
    learnt = np.repeat([float(not held_out(r[0])) for r in rows], sizes)
    chunk = TaskContext.get().partitionId() << 40 | number << 16 | zlib.crc32(pack(tokens)) & 0xFFFF

    words, place, uses = np.unique(tokens, return_inverse=True, return_counts=True)
    # Frequent tokens get small numbers, which are stored in few bytes.
    frequent = np.argsort(-uses, kind="stable")
    words, place = words[frequent], np.argsort(frequent)[place]
    grams, at = np.unique(_grams(tokens, sizes, count), return_inverse=True)
    trained, counts = (np.bincount(i, weights=learnt).astype(np.uint32) for i in (place, at))
    own = (pack(ids), pack(sizes), pack((words % np.uint64(count)).astype(np.uint32)), pa.compress(pack(place.astype(np.uint32)), "zstd", asbytes=True))
    (word_order, word_home), (gram_order, gram_home) = (_dealt((x % np.uint64(count)).astype(np.int64)) for x in (words, grams))
    used = np.unique(np.concatenate([word_home, gram_home, [chunk % count]]))
    w, g = (np.searchsorted(home, [used, used + 1]).T.tolist() for home in (word_home, gram_home))
    out = []
    for k, (a, b), (c, d) in zip(used.tolist(), w, g):
        x, y = word_order[a:b], gram_order[c:d]
        out.append((
            k, chunk, pack(words[x] // np.uint64(count), WORD_BYTES), pack(trained[x]), pack(grams[y] // np.uint64(count), PAIR_BYTES), pack(counts[y]),
            *(own if k == chunk % count else (None,) * 4),
        ))
    return record(SENT, *zip(*out))


COUNTED = pa.schema([
    ("bucket", pa.int64()), ("chunk", pa.int64()), ("words", pa.binary()), ("word_levels", pa.binary()), ("word_counts", pa.binary()), ("pair_levels", pa.binary()),
    ("total", pa.int64()), ("distinct", pa.int64()), *OWN,
])
COUNTED_FIELDS = "bucket long, chunk long, words binary, word_levels binary, word_counts binary, pair_levels binary, total long, distinct long, ids binary, sizes binary, homes binary, place binary"


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _count(count: int, bits_each: int):
    """Counts of one bucket's tokens and bigrams make its block of the filter, which is probed for them; each
    chunk gets the levels of its own, and the counts of its tokens."""

    def reduce(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        bucket = rows[0]["bucket"]
        word_parts = [unpack(r["words"], np.uint64, WORD_BYTES) for r in rows]
        words, totals = _summed(np.concatenate(word_parts), np.concatenate([unpack(r["trained"], np.uint32) for r in rows]))
        gram_parts = [unpack(r["pairs"], np.uint64, PAIR_BYTES) for r in rows]
        grams, counts = _summed(np.concatenate(gram_parts), np.concatenate([unpack(r["pair_counts"], np.uint32) for r in rows]))
        keys, learnt = np.concatenate([words, grams]) * np.uint64(count) + np.uint64(bucket), np.concatenate([totals, counts])
        level = Filter(block(keys[learnt > 0], learnt[learnt > 0], bits_each)).level(keys)
        sums = (int(totals.sum()), int((totals > 0).sum()))
        out = []
        for r, own_words, own_grams in zip(rows, word_parts, gram_parts):
            x, y = np.searchsorted(words, own_words), np.searchsorted(grams, own_grams)
            own = [r[name] for name, _ in OWN]
            out.append((bucket, r["chunk"], r["words"], pack(level[x]), pack(totals[x]), pack(level[len(words) + y]), *sums, *own))
            sums = (0, 0)
        return pa.table(record(COUNTED, *zip(*out)))

    return reduce


DOCUMENT = pa.schema([
    ("id", pa.int64()), ("n_known", pa.int64()), ("sum", pa.float64()), ("levels", pa.binary()), ("pair_levels", pa.binary()),
    ("total", pa.int64()), ("distinct", pa.int64()),
])
DOCUMENT_FIELDS = "id long, n_known long, sum double, levels binary, pair_levels binary, total long, distinct long"


def _documents(count: int):
    """A chunk's documents: sums of log10(c + 0.5), numbers of known tokens, and the level of each token and bigram in their order."""

    def back(home: np.ndarray, parts: list) -> np.ndarray:
        found = np.concatenate(parts)
        out = np.empty(len(home), found.dtype)
        out[_dealt(home)[0]] = found
        return out

    def each(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["bucket"])
        own = next(r for r in rows if r["ids"] is not None)
        ids, sizes, home = unpack(own["ids"], np.int64), unpack(own["sizes"], np.int64), unpack(own["homes"], np.uint32)
        place = unpack(pa.decompress(own["place"], 4 * int(sizes.sum()), "zstd", asbytes=True), np.uint32)
        words = back(home, [unpack(r["words"], np.uint64, WORD_BYTES) * np.uint64(count) + np.uint64(r["bucket"]) for r in rows])
        counts = back(home, [unpack(r["word_counts"], np.int64) for r in rows])
        level = back(home, [unpack(r["word_levels"], np.uint8) for r in rows])[place].tobytes()
        grams, at = np.unique(_grams(words[place], sizes, count), return_inverse=True)
        pair_level = back((grams % np.uint64(count)).astype(np.int64), [unpack(r["pair_levels"], np.uint8) for r in rows])[at].tobytes()
        ends = np.cumsum(sizes)
        firsts = ends - sizes
        sums = np.add.reduceat(np.log10(counts + 0.5)[place], firsts)
        known = np.add.reduceat((counts > 0).astype(np.int64)[place], firsts)
        cuts = list(zip(firsts.tolist(), ends.tolist()))
        told = [[sum(r[name] for r in rows)] + [0] * (len(ids) - 1) for name in ("total", "distinct")]
        return pa.table(record(DOCUMENT, ids, known, sums, [level[a:b] for a, b in cuts], [pair_level[a:b] for a, b in cuts], *told))

    return each


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits_each: int = BITS_EACH) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are words [^\\x20\\x09-\\x0D]+ with A-Z in lower case, and the end of the text. Texts are read once: chunks of
    documents send their distinct tokens and bigrams to the hash buckets. A bucket counts them over the whole
    corpus, makes its block of a Bloom filter that holds each n-gram at every level up to its own (counts are quantised on a
    log scale), and probes it for all tokens and bigrams that came, level after level. The levels go back to the chunks. So the filter
    grows with the corpus, and no task or driver holds more of it than one block. Bigrams are weighed against
    unigrams by the level of the context, over all training tokens, and `score`
    sums log10(w * c(uv) / c(u) + (1 - w) * p(v)), w the context's weight and p(v) the smoothed unigram estimate.
    Buckets and chunks are of bounded size, and hot tokens cost a row for each chunk at most.

    Null and empty texts have the end token only. A null id is learnt from. Without training documents all counts
    are zero. Rows with equal id and text have equal results. Starts jobs while it is built.
    """
    count = bucket_count(docs, text_col)
    read = texts(docs, id_col, text_col)

    def send(batches):
        known = WordHashes()
        for number, rows in enumerate(chunks(batches, 2, _tokens(known), CHUNK_WORDS)):
            known.trim()
            yield _emit(rows, count, number)

    counted = read.mapInArrow(send, SENT_FIELDS).groupBy("bucket").applyInArrow(_count(count, bits_each), COUNTED_FIELDS)
    probed = write_stage(counted.groupBy("chunk").applyInArrow(_documents(count), DOCUMENT_FIELDS), "lm-levels")
    total, distinct = (x or 0 for x in probed.agg(F.sum("total"), F.sum("distinct")).first())
    below = np.log10(total + 0.5 * (distinct + 1)) if total + distinct else np.log10(0.5)
    mass = float(10**below)

    def weigh(batches):
        explained, seen = np.zeros(LEVELS), np.zeros(LEVELS)
        for batch in batches:
            learnt = [not held_out(i) for i in batch.column(0).to_pylist()]
            part = _weigh(batch.filter(pa.array(learnt, pa.bool_())), mass)
            explained, seen = explained + part[0], seen + part[1]
        schema = pa.schema([("level", pa.int64()), ("explained", pa.float64()), ("seen", pa.float64())])
        yield record(schema, np.arange(LEVELS), explained, seen)

    tokens = probed.select("id", "levels", "pair_levels")
    weighed = tokens.mapInArrow(weigh, "level long, explained double, seen double").groupBy("level").agg(F.sum("explained"), F.sum("seen"))
    shares = np.zeros(LEVELS)
    for level, explained, seen in weighed.collect():
        shares[level] = min(0.95, explained / seen) if seen else 0.0
    schema = pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("sum", pa.float64()), ("score", pa.float64()),
    ])

    def score(batches):
        for batch in batches:
            if batch.num_rows:
                ids = [None if i == NO_ID else i for i in batch.column(0).to_pylist()]
                sizes, scores = _scores(batch, mass, shares)
                yield record(schema, ids, [held_out(i) for i in ids], sizes, batch.column(3), batch.column(4), scores)

    scored = probed.select("id", "levels", "pair_levels", "n_known", "sum").mapInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, sum double, score double"
    )
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        (F.col("sum") - F.col("n_tokens") * F.lit(float(below))).alias("base_score"), "score",
    )


def _lookup(batch: pa.RecordBatch):
    """For each token of the documents: its count, its bigram's, its context's, and that context's level; the
    documents' first tokens, and their sizes."""
    texts_of = batch.column(1).to_pylist()
    sizes = np.fromiter(map(len, texts_of), np.int64, len(texts_of))
    level = np.frombuffer(b"".join(texts_of), np.uint8)
    pair_level = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8)
    firsts = np.cumsum(sizes) - sizes
    # Every text has one start and one end, so the start's level is that of the end.
    before = np.concatenate([[np.uint8(0)], level[:-1]])
    before[firsts] = level[firsts + sizes - 1]
    means = mean_count(np.arange(256))
    context = means[before]
    return means[level], np.minimum(means[pair_level], context), context, np.minimum(before, LEVELS - 1), firsts, sizes


def _weigh(batch: pa.RecordBatch, mass: float) -> tuple[np.ndarray, np.ndarray]:
    """For each level of the context: how many training tokens the bigrams explain, of how many.

    Each token is left out of its own counts. With even odds, the bigram's part of its probability is
    how much the bigram explains (one step of expectation maximisation).
    """
    if not batch.num_rows:
        return np.zeros(LEVELS), np.zeros(LEVELS)
    single, both, context, level, _, _ = _lookup(batch)
    gram = np.maximum(both - 1, 0) / np.maximum(context - 1, 1)
    alone = (np.maximum(single - 1, 0) + 0.5) / mass
    return np.bincount(level, weights=gram / (gram + alone), minlength=LEVELS), np.bincount(level, minlength=LEVELS).astype(float)


def _scores(batch: pa.RecordBatch, mass: float, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    single, both, context, level, firsts, sizes = _lookup(batch)
    share = np.where(context > 0, shares[level], 0.0)
    mixed = share * both / np.maximum(context, 1) + (1 - share) * (single + 0.5) / mass
    return sizes, np.add.reduceat(np.log10(mixed), firsts)
