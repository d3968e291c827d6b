"""Words of texts as bytes, and texts as Arrow batches; shared by the operators that read whole texts.

Cutting UTF-8 at ASCII characters cannot cut a code point, so words are cut and hashed as bytes.
"""

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Every byte but 0-9, a-z and those of non-ASCII characters becomes a space; A-Z becomes a-z.
PLAIN = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256)
)


def plain_words(text: bytes | None) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z in lower case."""
    return (text or b"").translate(PLAIN).split()


def spaced_words(text: bytes | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of the text, unchanged; bytes.split() cuts at just these characters."""
    return (text or b"").split()


class WordHashes(dict):
    """XXH64 of words, remembered; trim() keeps the memory bounded."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def trim(self, most: int = 200_000) -> None:
        if len(self) > most:
            self.clear()


def as_bytes(name: str) -> Column:
    return F.col(name).cast("string").cast("binary")


def texts(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """The id as `id`, the text as UTF-8 bytes in `text`, and what else is asked for; no other column."""
    return docs.select(F.col(id_col).cast("long").alias("id"), as_bytes(text_col).alias("text"), *more)


def slices(batches, rows: int = 512):
    """Parts of Arrow batches, so that few texts are Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)],
        schema=schema,
    )
