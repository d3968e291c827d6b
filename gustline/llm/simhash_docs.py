"""SimHash near-duplicates of documents through an index of positional bytes with count filtering."""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gustline.llm.components import bucket_components
from gustline.llm.text import record, slices, texts
from gustline.sources.shared import write_stage

#: Fingerprints link at so many differing bits or fewer.
BITS = 3
#: So many of 8 bytes stay whole where BITS bits differ.
SHARED = 8 - BITS
#: Among the first INDEXED bytes at least INDEXED - BITS stay whole, so a pair meets in one set of four.
INDEXED = 7


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """Majority of the bits of the XXH64 (seed 42) of all word shingles, as a signed long."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: 1 - width].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends[width - 1 :].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 65536):
        part = hashes[start : start + 65536].byteswap().view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">u8")[0].astype(np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, bits): the 64-bit fingerprint of each row's whole text; no shuffle. Null or empty text: 0."""
    schema = pa.schema([("id", pa.int64()), ("bits", pa.int64())])

    def each(batches):
        for part in slices(batches):
            yield record(schema, part.column(0), [fingerprint(x) for x in part.column(1).to_pylist()])

    return texts(docs, id_col, text_col).mapInArrow(each, "id long, bits long")


def _byte(bits: Column, position: int) -> Column:
    return F.shiftrightunsigned(bits, 8 * position).bitwiseAND(F.lit(255))


def _linked() -> Column:
    """Tally the positional bytes a pair shares; pairs with enough of them are verified."""
    other = F.col("x").bitwiseXOR(F.col("y"))
    tally = sum((F.when(_byte(other, p) == 0, 1).otherwise(0) for p in range(8)), F.lit(0))
    return (tally >= SHARED) & (F.bit_count(other) <= BITS)


def near_groups(marked: DataFrame) -> DataFrame:
    """(bits, component) of all distinct fingerprints; component is the smallest id reachable.

    A list of the rows that have one byte at one position would hold a 256th of all
    rows, and its pairs would grow with their square. Count filtering gives more: two
    fingerprints that differ in 3 bits share 5 of 8 positional bytes at least, so 4 of any 7
    positions. The lists are kept by 4 positional bytes (35 of them for each fingerprint, each with a
    2^32nd of all rows if bits fall evenly), the shared bytes of each pair that meets are tallied, pairs
    with 5 or more are verified by their bits. Rows with equal fingerprints are one class before that.
    """
    classes = write_stage(marked.groupBy("bits").agg(F.min("id").alias("least")), "classes")
    keys = [
        sum((F.shiftleft(_byte(F.col("bits"), p), 8 * k) for k, p in enumerate(places)), F.lit(number * 2**32))
        for number, places in enumerate(combinations(range(INDEXED), INDEXED - BITS))
    ]
    members = classes.select(F.explode(F.array(*keys)).alias("key"), F.col("bits").alias("id"), "bits")
    linked = write_stage(bucket_components(members, _linked()), "linked")
    roots = classes.join(linked, classes.bits == linked.id, "left").select(
        "bits", "least", F.coalesce("component", "bits").alias("root")
    )
    return roots.join(roots.groupBy("root").agg(F.min("least").alias("component")), "root").select("bits", "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id (smallest id reachable over links).

    Repeated rows and ties give equal rows; a null or empty text has fingerprint zero and is linked like any
    other; a null id never names a component unless the component has no other. An
    empty table gives no rows. Starts jobs while it is built.
    """
    marked = write_stage(fingerprints(docs, id_col, text_col), "fingerprints")
    return marked.join(near_groups(marked), "bits").select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose id names their group, one row for each id, with all columns.

    Of rows that share id and group, any one stays; a group of null ids keeps one row.
    """
    marked = near_duplicates(docs, id_col, text_col)
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("__key")
    kept = marked.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(key).distinct()
    keyed = docs.withColumn("__key", F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))))
    return keyed.join(kept, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")
