"""Words of documents that stand in benchmark windows, found with one Aho-Corasick automaton."""

import re

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.llm.text import as_bytes, plain_words, record, slices, texts

#: Words of a window.
WIDTH = 10
#: Bytes of benchmark text that one automaton may be built of. A word stands in ten windows, so each byte
#: makes about ten nodes, which take some 300 bytes of a worker's memory.
MOST_CHARACTERS = 500_000
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def windows(items, width: int = WIDTH) -> dict[str, tuple[int, tuple[int, ...]]]:
    """Normalised windows of the items, each with its number of words and the items it stands in."""
    found: dict[str, tuple[int, set]] = {}
    for item, text in items:
        words = plain_words(text)
        for i in range(max(1, len(words) - width + 1) if words else 0):
            part = words[i : i + width]
            found.setdefault(f" {b' '.join(part).decode(errors='replace')} ", (len(part), set()))[1].add(item)
    return {k: (n, tuple(sorted(x for x in s if x is not None))) for k, (n, s) in found.items()}


def automaton(patterns: dict) -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for pattern, value in patterns.items():
        machine.add_word(pattern, value)
    machine.make_automaton()
    return machine


def occurrences(machine, text: bytes | None) -> tuple[int, list[tuple[int, int, tuple[int, ...]]]]:
    """The number of words, and (first word, word after the last, items) of each window found.

    The words, joined by single spaces, are scanned once; the spaces before an end give its word.
    """
    words = plain_words(text)
    if not words or not len(machine):
        return len(words), []
    joined = f" {b' '.join(words).decode(errors='replace')} "
    ends = list(machine.iter(joined))
    if not ends:
        return len(words), []
    spaces = np.flatnonzero(np.frombuffer(joined.encode("utf-32-le"), np.uint32) == 32)
    after = np.searchsorted(spaces, [e for e, _ in ends]).tolist()
    return len(words), [(k - n, k, items) for k, (_, (n, items)) in zip(after, ends)]


def _parts(items: DataFrame, id_col: str, text_col: str, most: int) -> list:
    """The items' windows as broadcasts, each of at most about `most` characters of text; one as a rule."""
    used = texts(items, id_col, text_col)
    total = used.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-total // most) or 1
    for k in range(count):
        part = used if count == 1 else used.where(F.pmod(F.xxhash64("text"), F.lit(count)) == k)
        yield items.sparkSession.sparkContext.broadcast(windows(tuple(r) for r in part.distinct().collect()))


def contaminated_words(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", most: int = MOST_CHARACTERS,
) -> DataFrame:
    """One row per document: doc_id, n_words, hit_words, spans, items.

    `hit_words` are the positions of hit words; `spans` their runs as characters [start, stop) of
    the original text; `items` the ids of the items with a window in the document, as strings
    in order. The automaton is sent to each worker process once and documents stream past it
    without a shuffle. A benchmark of over `most` characters is cut into parts; each has its own
    automaton and pass, and the hits of all passes are united, so no worker ever holds more than a part.

    Null and empty texts have no words. Items without words have no windows; an item with a null
    id hits words but is not listed. Repeated rows give repeated results. Bytes that are not UTF-8 count as U+FFFD.
    """
    parts = list(_parts(items, item_id, item_text, most))
    found = [_scan(docs, part, id_col, text_col) for part in parts]
    if len(found) == 1:
        return found[0].drop("digest")
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    united = every.groupBy("doc_id", "digest", "n_words").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_words")))).alias("hit_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        (F.count("*") / len(parts)).cast("int").alias("copies"),
    )
    return united.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("digest", "copies", "copy")


def _scan(docs: DataFrame, patterns, id_col: str, text_col: str) -> DataFrame:
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    schema = pa.schema([
        ("doc_id", pa.int64()), ("digest", pa.int64()), ("n_words", pa.int64()),
        ("hit_words", pa.list_(pa.int32())), ("spans", pa.list_(span)), ("items", pa.list_(pa.string())),
    ])

    def each(batches):
        machine = None
        for part in slices(batches):
            machine = machine or automaton(patterns.value)
            out = [[], [], [], []]
            for text in part.column(1).to_pylist():
                n, hits = occurrences(machine, text)
                for column, value in zip(out, (n, *_merged(text, n, hits))):
                    column.append(value)
            yield record(schema, part.column(0), part.column(2), *out)

    return texts(docs, id_col, text_col, F.xxhash64(text_col).alias("digest")).mapInArrow(
        each, "doc_id long, digest long, n_words long, hit_words array<int>, spans array<struct<start:long,stop:long>>, items array<string>"
    )


def _merged(text: bytes | None, n: int, hits: list) -> tuple[list[int], list[dict], list[str]]:
    if not hits:
        return [], [], []
    steps = np.zeros(n + 1, np.int64)
    for first, after, _ in hits:
        steps[first] += 1
        steps[after] -= 1
    inside = np.cumsum(steps[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    places = [m.span() for m in WORD.finditer(text.lower())]
    spans = []
    for first, after in edges.reshape(-1, 2).tolist():
        start = len(text[: places[first][0]].decode(errors="replace"))
        spans.append({"start": start, "stop": start + len(text[places[first][0] : places[after - 1][1]].decode(errors="replace"))})
    return np.flatnonzero(inside).tolist(), spans, sorted({str(i) for *_, items in hits for i in items})


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The digest of `contaminated_words`: counts, the listed items as one hash, and whether any word is hit."""
    return contaminated_words(docs, items, **options).select(
        "doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", most: int = MOST_CHARACTERS) -> DataFrame:
    """The documents without a hit word, with all columns.

    Null and empty texts have no hits and stay; repeated rows share their fate; an empty table gives none, and an empty
    benchmark drops none. Bytes that are not UTF-8 count as U+FFFD. Map-only for one automaton. Where the benchmark needs more of them, the digests of hit texts are gathered pass
    by pass and rows with such a text are left out.
    """
    parts = list(_parts(items, "item_id", "text", most))
    if len(parts) == 1:
        return docs.where(~F.coalesce(_hit_by(parts[0])(as_bytes(text_col)), F.lit(False)))
    bad = None
    for part in parts:
        hit = docs.where(_hit_by(part)(as_bytes(text_col))).select(F.sha2(text_col, 256).alias("__digest"))
        bad = hit if bad is None else bad.union(hit)
    marked = docs.withColumn("__digest", F.coalesce(F.sha2(text_col, 256), F.lit("")))
    return marked.join(bad.distinct(), "__digest", "left_anti").drop("__digest")


def _hit_by(patterns):
    machine = []

    def hit(batch: pd.Series) -> pd.Series:
        if not machine:
            machine.append(automaton(patterns.value))
        return pd.Series([bool(occurrences(machine[0], x)[1]) for x in batch], dtype=bool)

    return F.pandas_udf(hit, "boolean")
