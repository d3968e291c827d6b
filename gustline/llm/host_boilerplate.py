"""Main text of web pages: markup names the article, suffix arrays of each host find what its pages repeat."""

import html
import re

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustline.llm.buckets import mix, pack, unpack
from gustline.llm.text import record
from gustline.llm.url_rules import host

#: Tokens of a repeated run at least.
RUN = 8
#: Pages of a host that are held against each other; larger hosts are cut into blocks of about this size by a hash.
BLOCK_PAGES = 256
#: Bytes of a run's hash, beside its bucket, and of the hash of the text that has it, that blocks of a host tell each other.
RUN_BYTES, WHO_BYTES = 5, 4
#: Text within an article is boilerplate in so many different articles of the host at least, and in this share of them.
MAIN_PAGES, MAIN_SHARE = 8, 0.8
#: Up to so many large hosts are sent to all tasks.
MOST_SENT = 100_000

#: Elements whose text is never shown, page furniture, inline elements, void elements.
SILENT = "script style noscript template svg math iframe object select textarea button title datalist canvas audio video".split()
FURNITURE = frozenset("nav aside form menu dialog footer header head".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class names, ids and roles that name page furniture.
HINTS = (
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice popup modal overlay "
    "newsletter subscribe subscription signup login social share sharing related recommended sidebar menu navbar nav navigation breadcrumb "
    "breadcrumbs pagination pager footer masthead comment comments disqus replies widget toolbar search contentinfo complementary"
).split()

#: Whole names of classes, ids and roles that name furniture within an article, where parts of names may be about anything.
NAMED = frozenset((
    "ad ads advert adverts advertisement advertising ad-container ad-slot ad-unit sponsor sponsored sponsored-content promo banner cookie-banner cookie-notice "
    "cookie-consent consent-banner notice popup modal newsletter newsletter-signup subscribe subscribe-box signup login share share-buttons sharing "
    "social-share social-links related related-posts related-articles recommended sidebar menu navbar nav navigation breadcrumb breadcrumbs pagination pager "
    "footer comment comments comment-list comments-area comment-section disqus disqus_thread toolbar complementary contentinfo"
).split())

#: Elements whose content is text only, up to their end tag or the end of the page.
RAW = frozenset("script style textarea title iframe noscript".split())
NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
TO_END = re.compile(r"[^>\"']*")
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in SILENT}
HINT = re.compile(r"^(?!has-|with-|no-)(?:.*[-_])?(?:%s)(?:[-_].*)?$" % "|".join(HINTS), re.I)


def _named_furniture(attributes: str, in_article: bool) -> bool:
    """Whether an element is hidden or its class, id or role names page furniture: within an article by a whole name, elsewhere by a part of one."""
    for found in ATTRIBUTE.finditer(attributes):
        name, value = found[1].lower(), (found[2] or "").strip("\"'")
        if name == "hidden" and value.lower() not in ("false", "until-found"):
            return True
        if name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and "display:none" in "".join(value.lower().split()):
            return True
        if name in ("class", "id", "role"):
            if any(n.lower() in NAMED if in_article else HINT.match(n) for n in value.split()):
                return True
    return False


def scan(page: str):
    """(text before a tag, closing, name, attributes) of each tag in order, and at last the text that is left.

    Comments, declarations and elements that are never shown are passed over. The page is read once: what is
    searched for to the end of the page without success is not searched for again. A quote that is never closed is
    a character like any other, and a tag that is never closed is text.
    """
    at = last = 0
    held, missing, size = [], set(), len(page)

    def find(what: str, start: int) -> int:
        place = -1 if what in missing else page.find(what, start)
        if place < 0:
            missing.add(what)
        return place

    while (at := find("<", at)) >= 0:
        if page.startswith("<!--", at):
            end = find("-->", at + 4)
            held.append(page[last:at] + " ")
            at = last = size if end < 0 else end + 3
            continue
        name = NAME.match(page, at + 1)
        if page[at + 1 : at + 2] in ("!", "?"):
            end = find(">", at)
        elif name:
            end = TO_END.match(page, name.end()).end()
            while end < size and page[end] != ">":
                close = find(page[end], end + 1)
                end = TO_END.match(page, (end if close < 0 else close) + 1).end()
            end = end if end < size else -1
        else:
            at += 1
            continue
        if end < 0:
            break
        before, held = "".join(held) + page[last:at], []
        tag = name[0].lower() if name else ""
        attributes = page[name.end() : end] if name else ""
        at = last = end + 1
        if tag in ENDS and not attributes.endswith("/"):
            close = None if tag in missing else ENDS[tag].search(page, at)
            if close is None:
                missing.add(tag)
            if close is not None or tag in RAW:
                held.append(before + " ")
                at = last = close.start() if close else size
                continue
        if tag:
            yield before, tag.startswith("/"), tag.lstrip("/"), attributes
        else:
            held.append(before + " ")
    yield "".join(held) + page[last:], False, "", ""


def page_text(page: str | None) -> tuple[str, str]:
    """(main, loose): the text of the page's articles, or else all text outside of page furniture.

    One pass over the tags keeps the name of the element that is skipped and how deep it is nested in itself, and how deep
    articles are. Elements that are not closed run to the end, but for skipped ones, which the first article ends.
    """
    pieces: dict[str, list[str]] = {"article": [], "main": [], "": []}
    depth = {"article": 0, "main": 0}
    skipped, nested = "", 0

    def take(piece: str) -> None:
        if piece and not skipped:
            pieces["article" if depth["article"] else "main" if depth["main"] else ""].append(html.unescape(piece))

    for before, closing, name, attributes in scan(page or ""):
        take(before)
        if skipped and name == "article" and not closing and not pieces["article"] and skipped != "article":
            skipped = ""
        if skipped == "head" and name == "body":
            skipped = ""
        if skipped:
            if name == skipped and not attributes.endswith("/"):
                nested += -1 if closing else 1
            if not nested:
                skipped = ""
            continue
        inside = bool(depth["article"] or depth["main"])
        if name and name not in INLINE:
            take("\n")
        if name in depth and (closing or not _named_furniture(attributes, True)):
            depth[name] = max(0, depth[name] + (-1 if closing else 1))
        elif not closing and name not in VOID and name not in ("", "html", "body"):
            own_header = name == "header" and inside
            if name in FURNITURE and not own_header or attributes and _named_furniture(attributes, inside):
                skipped, nested = name, 1
    clean = {k: " ".join("".join(v).split()) for k, v in pieces.items()}
    main = clean["article"] or clean["main"]
    return main, "" if main else clean[""]


def run_ranks(tokens: np.ndarray, page: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """(ranks, starts): where runs of `run` tokens of one page start, and each one's rank among all runs, equal for equal runs.

    A suffix array by prefix doubling: from ranks of suffixes by their first 1, 2, 4, ... tokens, ranks by twice as many,
    until `run` tokens are compared.
    """
    n = len(tokens)
    ends = np.searchsorted(page, page, side="right")
    ranks, size = np.unique(tokens, return_inverse=True)[1].astype(np.int64), 1
    while size < run:
        step = min(size, run - size)
        following = np.zeros(n, np.int64)
        inside = np.flatnonzero(np.arange(n) + step < ends)
        following[inside] = ranks[inside + step] + 1
        ranks = np.unique(ranks * (int(ranks.max()) + 2) + following, return_inverse=True)[1].astype(np.int64)
        size += step
    starts = np.flatnonzero(np.arange(n) + run <= ends)
    return ranks[starts], starts


def repeated(tokens: np.ndarray, page: np.ndarray, alike: np.ndarray, run: int) -> np.ndarray:
    """For each token, on how many different pages the most shared run of `run` tokens stands that covers it.

    `alike` numbers pages so that copies have one number.
    """
    ranks, starts = run_ranks(tokens, page, run)
    cover = np.zeros(len(tokens), np.int64)
    if len(starts):
        each = np.unique(ranks * (int(alike.max()) + 1) + alike[starts])
        shared = np.bincount(each // (int(alike.max()) + 1), minlength=int(ranks.max()) + 1)[ranks]
        for k in range(run):
            np.maximum.at(cover, starts + k, shared)
    return cover


def _numbered(streams: list[list[str]]) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
    known: dict[str, int] = {}
    tokens = np.array([known.setdefault(t, len(known)) for s in streams for t in s], np.int64)
    return known, tokens, np.repeat(np.arange(len(streams)), [len(s) for s in streams])


def _articles(texts: list[str], run: int) -> dict[str, str]:
    """Each different text of a small host's articles without the runs that most of the others repeat."""
    texts = sorted(set(texts))
    streams = [t.split() for t in texts]
    _, tokens, page = _numbered(streams)
    if len(texts) < 2 or not len(tokens):
        return dict(zip(texts, texts))
    keep = repeated(tokens, page, page, run) < max(MAIN_PAGES, MAIN_SHARE * len(texts))
    return _left(texts, streams, keep)


def _left(texts: list[str], streams: list[list[str]], keep: np.ndarray) -> dict[str, str]:
    out, at = {}, 0
    for text, stream in zip(texts, streams):
        flags = keep[at : at + len(stream)]
        at += len(stream)
        out[text] = text if flags.all() else " ".join(t for t, f in zip(stream, flags) if f)
    return out


def _buckets(values: np.ndarray, number: int):
    """(bucket, the places of its values) of every bucket that has some."""
    bucket = (values >> np.uint64(8 * RUN_BYTES)) % np.uint64(number)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    return [(int(bucket[places[0]]), places) for places in np.split(order, cuts) if len(places)]


def _digests(texts: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t.encode()) for t in texts], np.uint64)


class _Runs:
    """The different runs of a block's different texts, in an order that depends on the texts alone.

    `value` is a hash of each, `who` a hash of the one text that has it, or 0 where several have it.
    """

    def __init__(self, texts: list[str], run: int):
        self.texts, self.run = sorted(set(texts)), run
        self.streams = [t.split() for t in self.texts]
        known, tokens, page = _numbered(self.streams)
        self.n = len(tokens)
        self.value, self.who = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.starts = self.which = self.page = np.zeros(0, np.int64)
        if not self.n:
            return
        ranks, self.starts = run_ranks(tokens, page, run)
        if not len(ranks):
            return
        _, first, self.which = np.unique(ranks, return_index=True, return_inverse=True)
        self.page = page[self.starts]
        hashes = _digests(list(known))[tokens]
        value = np.zeros(len(first), np.uint64)
        for k in range(run):
            value = mix(value + hashes[self.starts[first] + k])
        self.value = value
        low, high = np.full(len(first), len(self.texts)), np.full(len(first), -1)
        np.minimum.at(low, self.which, self.page)
        np.maximum.at(high, self.which, self.page)
        digest = np.array([xxhash.xxh32_intdigest(t.encode()) | 1 for t in self.texts], np.uint32)
        self.who = np.where(low == high, digest[low], 0).astype(np.uint32)

    def shared(self, own: np.ndarray) -> np.ndarray:
        """In how many of the texts that are marked each run stands."""
        marked = own[self.page]
        each = np.unique(self.which[marked] * max(1, len(self.texts)) + self.page[marked])
        return np.bincount(each // max(1, len(self.texts)), minlength=len(self.value))

    def left(self, again: np.ndarray) -> dict[str, str]:
        """Each text without the runs that are marked."""
        change = np.zeros(self.n + 1, np.int64)
        starts = self.starts[again[self.which]]
        change[starts] += 1
        change[starts + self.run] -= 1
        return _left(self.texts, self.streams, np.cumsum(change)[: self.n] == 0)


SENT = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("part", pa.int64()), ("parts", pa.int64()),
    ("main", pa.binary()), ("loose", pa.binary()),
])
RUNS = pa.schema([("host", pa.string()), ("bucket", pa.int64()), ("part", pa.int64()), ("value", pa.binary()), ("who", pa.binary()), ("text", pa.binary())])
AGAIN = pa.schema([("host", pa.string()), ("part", pa.int64()), ("bucket", pa.int64()), ("again", pa.binary()), ("own", pa.binary()), ("values", pa.list_(pa.int64()))])
CLAIMS = pa.schema([("host", pa.string()), ("parts", pa.int64()), ("n", pa.int64()), ("values", pa.list_(pa.int64()))])
COUNTS = pa.schema([("host", pa.string()), ("values", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
RESULT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary", pa.list_(pa.int64()): "array<long>"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _unpacked(table: pa.Table, name: str) -> list[str]:
    undo = zstandard.ZstdDecompressor().decompress
    return [undo(x).decode() for x in table.column(name).to_pylist()]


def judge(table: pa.Table) -> pa.Table:
    """A bucket of a host: which of the runs that each block sent stand in more than one text of the host, and which of
    the articles it sent are its own: of blocks with equal ones the least has it."""
    values = [unpack(x, np.uint64, RUN_BYTES) for x in table.column("value").to_pylist()]
    value = np.concatenate(values)
    who = np.concatenate([unpack(x, np.uint32, WHO_BYTES) for x in table.column("who").to_pylist()])
    again = np.empty(len(value), bool)
    if len(value):
        order = np.lexsort((who, value))
        new = np.r_[True, np.diff(value[order]) != 0]
        starts = np.flatnonzero(new)
        least, most = who[order][starts], who[order][np.r_[starts[1:], len(order)] - 1]
        again[order] = ((least == 0) | (least != most))[np.cumsum(new) - 1]
    texts = [unpack(x, np.uint64) for x in table.column("text").to_pylist()]
    text, own = np.concatenate(texts), np.empty(sum(map(len, texts)), bool)
    order = np.lexsort((np.repeat(table.column("part").to_numpy(), [len(t) for t in texts]), text))
    own[order] = np.r_[True, np.diff(text[order]) != 0][: len(order)]
    told = np.split(again, np.cumsum([len(v) for v in values])[:-1]), np.split(own, np.cumsum([len(t) for t in texts])[:-1])
    columns = (table.column(c).to_pylist() for c in ("host", "part", "bucket"))
    return pa.table(record(AGAIN, *columns, *([np.packbits(x).tobytes() for x in flags] for flags in told), [None] * table.num_rows))


def _flags(sent: np.ndarray, parts: int, told: dict[int, dict], name: str) -> np.ndarray:
    """What the buckets told of the values that were sent to them."""
    flags = np.zeros(len(sent), bool)
    for bucket, places in _buckets(sent, parts):
        flags[places] = np.unpackbits(np.frombuffer(told[bucket][name], np.uint8), count=len(places)).astype(bool)
    return flags


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", run: int = RUN
) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    The text of a page is that of its article elements (or else main, or else all that is shown) without
    menus, headers, footers, sidebars, notices, adverts, forms and reader comments, as elements or class names tell them, with
    references decoded and single spaces. Then the pages of a host are held against each other, in blocks of about 256 pages,
    so that a host with a third of all pages is many tasks: a suffix array over the block's token streams finds its runs of 8 tokens.

    Of text that no article element marks, runs go that another unmarked text of the host has too, however large
    the host: blocks send their runs to buckets by hash, with the one text that has each, and the buckets answer which stand in
    more than one. So equal pages, which count once, keep their text, wherever they are. Runs are known by 40 bits beside the bucket, texts by 31.
    What is in an article goes only if four fifths of the host's different articles, and eight at least, repeat it, since articles
    may quote and copy each other. Of articles that several blocks have the least block counts one. A run of four fifths of all is one of four
    fifths in some block; so blocks claim those, each host's claims are counted in all of its blocks, and the sums decide.

    Null or empty html gives an empty text; pages whose url has no host are one host. Repeated rows give repeated results; an
    empty table gives none; other columns are not looked at.
    """
    url = F.col(url_col).cast("string")
    read = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), host(url).alias("host"), F.col(html_col).cast("string").alias("html"))
    large = read.groupBy("host").count().where(F.col("count") > BLOCK_PAGES).select("host", F.ceil(F.col("count") / BLOCK_PAGES).alias("parts"))
    few = large.limit(MOST_SENT + 1).count() <= MOST_SENT
    read = read.join(F.broadcast(large) if few else large, "host", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    part = F.pmod(F.xxhash64("page_id", "url"), "parts")

    def extract(batches):
        squeeze = zstandard.ZstdCompressor(3).compress
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                some = batch.slice(start, 64)
                both = [page_text(x) for x in some.column(5).to_pylist()]
                yield record(SENT, *some.columns[:5], *([squeeze(x[k].encode()) for x in both] for k in (0, 1)))

    def loose(table: pa.Table) -> list[str]:
        return [text for text, article in zip(_unpacked(table, "loose"), _unpacked(table, "main")) if text and not article]

    def articles(table: pa.Table) -> list[str]:
        return sorted({main for main in _unpacked(table, "main") if main})

    def tell(table: pa.Table) -> pa.Table:
        name, part, parts = (table.column(c)[0].as_py() for c in ("host", "part", "parts"))
        runs = _Runs(loose(table) if parts > 1 else [], run)
        texts = _digests(articles(table) if parts > 1 else [])
        places, owned, none = dict(_buckets(runs.value, parts)), dict(_buckets(texts, parts)), np.zeros(0, np.int64)
        rows = []
        for b in sorted({*places, *owned}):
            i = places.get(b, none)
            rows.append((name, b, part, pack(runs.value[i], RUN_BYTES), pack(runs.who[i], WHO_BYTES), pack(texts[owned.get(b, none)])))
        return pa.table(record(RUNS, *([row[k] for row in rows] for k in range(len(RUNS)))))

    def owned(table: pa.Table, told: dict[int, dict]) -> tuple[_Runs, np.ndarray]:
        """The runs of a block's articles, and which of these are its own."""
        texts, parts = articles(table), table.column("parts")[0].as_py()
        return _Runs(texts, run), _flags(_digests(texts), parts, told, "own")

    def claim(table: pa.Table, answers: pa.Table) -> pa.Table:
        name, parts = (table.column(c)[0].as_py() for c in ("host", "parts"))
        rows = []
        if parts > 1:
            runs, own = owned(table, {r["bucket"]: r for r in answers.to_pylist()})
            shared = runs.shared(own)
            claimed = runs.value[(shared > 0) & (shared >= MAIN_SHARE * own.sum())]
            rows = [(name, parts, int(own.sum()), claimed.view(np.int64))]
        return pa.table(record(CLAIMS, *([row[k] for row in rows] for k in range(len(CLAIMS)))))

    def tally(table: pa.Table, answers: pa.Table) -> pa.Table:
        told, rows = {r["bucket"]: r for r in answers.to_pylist()}, []
        if table.num_rows and -1 in told:
            runs, own = owned(table, told)
            found = np.isin(runs.value.view(np.int64), np.array(told[-1]["values"], np.int64))
            rows = [(table.column("host")[0].as_py(), runs.value[found].view(np.int64), runs.shared(own)[found])]
        return pa.table(record(COUNTS, *([row[k] for row in rows] for k in range(len(COUNTS)))))

    def keep(table: pa.Table, answers: pa.Table) -> pa.Table:
        parts = table.column("parts")[0].as_py()
        runs, both = _Runs(loose(table), run), list(zip(_unpacked(table, "main"), _unpacked(table, "loose")))
        if parts > 1:
            told = {r["bucket"]: r for r in answers.to_pylist()}
            again, marked = _flags(runs.value, parts, told, "again"), _Runs(articles(table), run)
            gone = np.array(told[-1]["values"] if -1 in told else [], np.int64)
            mains = marked.left(np.isin(marked.value.view(np.int64), gone))
        else:
            again, mains = runs.who == 0, _articles([main for main, _ in both if main], run)
        others = runs.left(again)
        kept = [mains[main] if main else others.get(text, "") for main, text in both]
        return pa.table(record(RESULT, table.column("page_id").to_pylist(), table.column("url").to_pylist(), kept, [len(x) for x in kept]))

    sent = read.select("page_id", "url", "host", part.alias("part"), "parts", "html").mapInArrow(extract, _ddl(SENT))
    # All readers of the blocks use one shuffle.
    blocks = sent.groupBy("host", "part")
    answers = blocks.applyInArrow(tell, _ddl(RUNS)).groupBy("host", "bucket").applyInArrow(judge, _ddl(AGAIN))

    def to_blocks(hosts: DataFrame) -> DataFrame:
        """The answers, and for each block of a host the `values` of the host as another one."""
        each = hosts.select("host", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "values")
        none = F.lit(None).cast("binary")
        return answers.unionByName(each.select("host", "part", F.lit(-1).cast("long").alias("bucket"), none.alias("again"), none.alias("own"), "values"))

    claims = blocks.cogroup(answers.groupBy("host", "part")).applyInArrow(claim, _ddl(CLAIMS))
    claims = claims.select("host", "parts", "n", F.posexplode_outer("values").alias("place", "value"))
    first = F.coalesce("place", F.lit(0)) == 0
    asked = claims.groupBy("host").agg(F.max("parts").alias("parts"), F.sum(F.when(first, F.col("n"))).alias("n"), F.collect_set("value").alias("values"))
    asked = asked.where(F.size("values") > 0)
    counts = blocks.cogroup(to_blocks(asked).groupBy("host", "part")).applyInArrow(tally, _ddl(COUNTS))
    counts = counts.select("host", F.explode(F.arrays_zip("values", "counts")).alias("one")).groupBy("host", F.col("one.values").alias("value")).agg(F.sum("one.counts").alias("count"))
    gone = counts.join(asked.select("host", "parts", "n"), "host").where(F.col("count") >= F.greatest(F.lit(MAIN_PAGES), F.lit(MAIN_SHARE) * F.col("n")))
    gone = gone.groupBy("host").agg(F.max("parts").alias("parts"), F.collect_list("value").alias("values"))
    return blocks.cogroup(to_blocks(gone).groupBy("host", "part")).applyInArrow(keep, _ddl(RESULT))
