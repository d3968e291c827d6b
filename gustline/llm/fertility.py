"""Quality rules on whole texts: base counts, and bands on how public tokenisers cut the text."""

import base64
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.llm.text import as_bytes, record, slices

#: Where the vocabulary files lie as a rule; a parameter everywhere.
FOLDER = "/opt/tokenizers"
#: No vocabulary file may be larger; they are sent to the workers.
MOST_BYTES = 16_000_000
#: A document needs so many words.
LEAST_WORDS = 50

#: Fixed values. For each vocabulary and each language (or else script): least characters per token,
#: most tokens per word, most share of tokens below a character, and least entropy of the tokens
#: as a share of the most that so many tokens can have, and that so many distinct ones can have.
BANDS = {
    "byte_bpe_multi_50k.tiktoken": {
        "en": (1.93, 3.05, 0.10, 0.465, 0.745),
        "de": (1.98, 3.15, 0.10, 0.465, 0.745),
        "fr": (1.78, 3.05, 0.10, 0.465, 0.745),
        "es": (1.83, 3.05, 0.10, 0.465, 0.735),
        "Latin": (1.80, 3.60, 0.20, 0.450, 0.730),
        "Cyrillic": (1.20, 5.00, 0.40, 0.450, 0.700),
        "Han": (0.50, 1e9, 0.80, 0.400, 0.700),
        "other": (0.20, 1e9, 1.00, 0.400, 0.650),
    },
    "byte_bpe_50k.tiktoken": {
        "en": (1.83, 3.00, 0.10, 0.450, 0.730),
        "de": (1.80, 3.30, 0.20, 0.450, 0.730),
        "fr": (1.67, 3.35, 0.25, 0.450, 0.730),
        "es": (1.60, 3.55, 0.20, 0.450, 0.720),
        "Latin": (1.30, 4.50, 0.35, 0.430, 0.700),
        "Cyrillic": (0.70, 9.00, 0.90, 0.400, 0.650),
        "Han": (0.30, 1e9, 0.95, 0.400, 0.600),
        "other": (0.15, 1e9, 1.00, 0.350, 0.550),
    },
}
#: Lead bytes of UTF-8 by script: Latin with its accents and extensions, Cyrillic, Han and kana.
LEADS = {
    "Latin": bytes([*range(65, 91), *range(97, 123), *range(0xC2, 0xCA)]),
    "Cyrillic": bytes([0xD0, 0xD1, 0xD2, 0xD3]),
    "Han": bytes(range(0xE3, 0xEA)),
}
SPACES = b" \t\n\v\f\r"
CONTINUATION = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"

#: How the text is cut before the merges of the rank files.
PATTERN = r""" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"""
#: Longer runs without white space are cut into pieces of this size, since merging takes the square of it.
RUN = re.compile(r"(\S{500})(?=\S)")


class Vocabulary:
    """A byte-level vocabulary of ranks, and the bands of its measures."""

    def __init__(self, content: bytes, bands: dict):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        self.encode = tiktoken.Encoding("text", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.part = np.zeros(max(ranks.values()) + 1, bool)
        self.part[[i for token, i in ranks.items() if _partial(token)]] = True
        self.bands = bands

    def measure(self, text: str, n_words: int, characters: int) -> tuple[float, float, float, float, float]:
        """Characters per token, tokens per word, share of tokens below a character, and the
        tokens' entropy over that of as many different ones and of the distinct ones."""
        ids = np.array(self.encode(RUN.sub(r"\1 ", text)), np.int64)
        if not len(ids) or not n_words:
            return 0.0, 0.0, 0.0, 0.0, 0.0
        counts = np.unique(ids, return_counts=True)[1]
        share = counts / len(ids)
        bits = float(-(share * np.log2(share)).sum())
        return (
            characters / len(ids), len(ids) / n_words, float(self.part[ids].mean()),
            bits / np.log2(max(2, len(ids))), bits / np.log2(max(2, len(counts))),
        )

    def passes(self, measured: tuple, lang: str | None, letters: bytes) -> bool:
        band = self.bands[lang] if lang in self.bands else self.bands[script(letters)]
        low, most, parts, flat, even = band
        return measured[0] >= low and measured[1] <= most and measured[2] <= parts and measured[3] >= flat and measured[4] >= even


def tools(sent: dict) -> list[Vocabulary]:
    """The tokenisers of a broadcast, built once by each worker process and kept beside its content."""
    if "built" not in sent:
        sent["built"] = [Vocabulary(content, sent["bands"][name]) for name, content in sent["files"].items()]
    return sent["built"]


def _partial(token: bytes) -> bool:
    try:
        token.decode()
    except UnicodeDecodeError:
        return True
    return False


def script(text: bytes) -> str:
    """The script that most of the letters are of."""
    sizes = {name: len(text) - len(text.translate(None, leads)) for name, leads in LEADS.items()}
    best = max(sizes, key=sizes.get)
    return best if sizes[best] else "other"


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int]:
    """Code points in words, symbols, lines equal to an earlier one, words in 3-word windows found twice or more."""
    characters = len(text.translate(None, CONTINUATION + SPACES))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    repeated = 0
    if len(words) >= 3:
        known: dict[bytes, int] = {}
        ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
        size = len(known)
        pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1]
        _, where, times = np.unique(pairs[:-1] * size + ids[2:], return_inverse=True, return_counts=True)
        inside = np.zeros(len(words), bool)
        twice = times[where] > 1
        for k in range(3):
            inside[k : len(words) - 2 + k] |= twice
        repeated = int(inside.sum())
    return characters, symbols, len(lines) - len(set(lines)), repeated


def load_vocabularies(folder: str = FOLDER, bands: dict = BANDS) -> dict:
    """The vocabularies that have bands, read on the driver; refused beyond MOST_BYTES each."""
    files = {}
    for name in bands:
        with open(f"{folder}/{name}", "rb") as file:
            files[name] = file.read(MOST_BYTES + 1)
        if len(files[name]) > MOST_BYTES:
            raise ValueError(f"{name} has over {MOST_BYTES} bytes")
    return {"files": files, "bands": bands}


def judge(data: bytes | None, lang: str | None, vocabularies: list[Vocabulary]) -> tuple:
    """The base counts, the measures of each vocabulary, whether the base rules fail, and the verdict."""
    data = data or b""
    text, words = data.decode(errors="replace"), data.split()
    base = base_counts(data, words)
    measured = [t.measure(text, len(words), base[0]) for t in vocabularies]
    failed = len(words) < LEAST_WORDS or 100 * base[3] > 50 * len(words)
    kept = not failed and all(t.passes(m, lang, data) for t, m in zip(vocabularies, measured))
    return len(words), *base, [list(m) for m in measured], failed, kept


def quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", vocabularies: dict | None = None
) -> DataFrame:
    """One row per document: doc_id, the base counts, `measures` of each vocabulary, base_failed and kept.

    Words are [^\\x20\\x09-\\x0D]+. A document is kept if it has 50 words, no more than half of
    them in repeated 3-word windows, and all vocabularies find it within the band of its
    language, or of the script of most of its letters where the language is null or has no band.
    Map-only; the driver sends the files.

    Null and empty texts have no words and are not kept. Repeated rows give repeated results. Bytes that are not UTF-8
    reach the tokenisers as U+FFFD and count as what they are in the base counts.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabularies or load_vocabularies())
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("measures", pa.list_(pa.list_(pa.float64()))),
        ("base_failed", pa.bool_()), ("kept", pa.bool_()),
    ])

    def each(batches):
        for part in slices(batches):
            rows = [judge(text, lang, tools(sent.value)) for text, lang in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
            if rows:
                yield record(schema, part.column(0), *zip(*rows))

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), as_bytes(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return read.mapInArrow(each, (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "measures array<array<double>>, base_failed boolean, kept boolean"
    ))


def keep_quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", vocabularies: dict | None = None) -> DataFrame:
    """The rows whose text and language pass, as `quality` judges them, with all columns; map-only.

    Null and empty texts go, repeated rows share their fate, and an empty table gives none.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabularies or load_vocabularies())

    def passes(batch: pd.Series, langs: pd.Series) -> pd.Series:
        return pd.Series([judge(t, lang, tools(sent.value))[-1] for t, lang in zip(batch, langs)], dtype=bool)

    return docs.where(F.pandas_udf(passes, "boolean")(as_bytes(text_col), F.col(lang_col).cast("string")))
