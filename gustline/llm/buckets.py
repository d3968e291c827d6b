"""Hashed words and windows as packed rows: many numbers of one chunk of documents for one bucket in a row."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that lead to one bucket at most; a bucket's task holds about ten bytes for each word.
TEXT_PER_BUCKET = 12_000_000
#: Words of a chunk: documents are put together to so many before they are packed.
CHUNK_WORDS = 1_000_000


def bucket_count(docs: DataFrame, text_col: str = "text") -> int:
    """So many that each holds a bounded share of the text, and as many as shuffles have partitions at least."""
    total = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TEXT_PER_BUCKET))


def pack(values: np.ndarray, width: int | None = None) -> bytes:
    """The numbers' first bytes, then their second ones and so on, which the shuffle compresses well."""
    data = np.ascontiguousarray(values)
    return data.view(np.uint8).reshape(-1, data.itemsize)[:, :width].T.tobytes()


def unpack(data: bytes, kind, width: int | None = None) -> np.ndarray:
    size = np.dtype(kind).itemsize
    width = width or size
    out = np.zeros((len(data) // width, size), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.reshape(-1).view(kind)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (a public finaliser of multiply and shift steps)."""
    x = values ^ (values >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def chunks(batches, width: int, words_of, most: int = CHUNK_WORDS):
    """Rows of Arrow batches, `width` columns with the text at 1, together with their words, in chunks of `most` words."""
    rows, total = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            for row in zip(*(part.column(k).to_pylist() for k in range(width))):
                hashes = words_of(row[1])
                rows.append((*row[:1], hashes, *row[2:]))
                total += len(hashes) + 1
                if total >= most:
                    yield rows
                    rows, total = [], 0
    if rows:
        yield rows
