"""The document operators against brute force, and on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gustline.llm import bloom_lm, decontaminate, fertility, fuzzy_lines, mixing, simhash_docs, substring_dedup
from gustline.llm.buckets import pack, unpack
from gustline.llm.components import bucket_components, components

LAYOUT = "doc_id long, text string, lang string, source string, n_chars long, id long, digest string, bucket int"
RND = random.Random(7)
VOCABULARY = ["".join(RND.choices("abcdefgh", k=RND.randint(2, 7))) for _ in range(400)]


def prose(n, seed):
    return " ".join(random.Random(seed).choices(VOCABULARY, k=n))


def documents(spark, rows):
    """Rows of (doc_id, text, source), with columns whose names the operators use themselves."""
    return spark.createDataFrame(
        [(i, t, "en", s, None if t is None else len(t), 7, "x", 3) for i, t, s in rows], LAYOUT)


AWKWARD = [
    (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (None, prose(60, 1), "b"), (4, prose(60, 1), "b"), (4, prose(60, 1), "b"),
    (4, prose(30, 9) + " " + prose(60, 1), "b"), (5, prose(30000, 2), "c"), (6, "Zü 中文 \U0001f600 x", None), (7, "a" * 5000, "c"), (8, prose(61, 1), "d"),
    (9, "\x00one\x1ctwo", "d"), (None, None, None),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return documents(spark, AWKWARD)


@pytest.fixture(scope="module")
def nothing(spark):
    return documents(spark, [])


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def rows_of(frame):
    return [(r.doc_id, r.text.encode()) for r in frame.select("doc_id", "text").collect()]


# Benchmark windows


def test_decontamination_marks_words_and_spans(spark):
    items = spark.createDataFrame(
        [(10, " ".join(f"W{i}" for i in range(12)), 0), (9, "Short item!", 0), (9, "Short item!", 0), (11, None, 0), (12, "--", 0), (None, "lone", 0)],
        "item_id long, text string, doc_id long")
    text = "x, w1 w2 W3 w4 w5 w6 w7 w8 w9 w10 - w11; short... ITEM lone"
    docs = documents(spark, [(1, text, ""), (2, "w1 w2 w3 w4 w5 w6 w7 w8 w9 nothing", ""), (3, None, "")])
    found = {r.doc_id: r for r in decontaminate.contaminated_words(docs, items).collect()}
    assert found[1].n_words == 15 and found[1].hit_words == list(range(1, 15)) and found[1].items == ["10", "9"]
    assert [text[s.start : s.stop] for s in found[1].spans] == [text[3:]]
    assert found[2].hit_words == [] and found[3].n_words == 0
    for most in (1, 20, 10**6):
        digests = {r.doc_id: tuple(r) for r in decontaminate.contamination(docs, items, most=most).collect()}
        assert digests[1][1:] == (15, 14, 2, hashlib.sha256(b"10,9").hexdigest(), True)
        assert [r.doc_id for r in decontaminate.drop_contaminated(docs, items, most=most).orderBy("doc_id").collect()] == [2, 3]


def test_decontamination_of_awkward_rows(spark, awkward, nothing):
    items = spark.createDataFrame([(1, prose(60, 1))], "item_id long, text string")
    found = decontaminate.contamination(awkward, items).collect()
    assert Counter((r.doc_id, r.n_hit) for r in found) == Counter(
        {(None, 60): 1, (4, 60): 3, (8, 60): 1, **{(i, 0): 1 for i in (1, 2, 3, 5, 6, 7, 9)}, (None, 0): 1})
    assert decontaminate.contamination(nothing, items).count() == 0
    assert decontaminate.drop_contaminated(awkward, items).columns == awkward.columns
    none = items.where("false")
    assert decontaminate.contamination(awkward, none).where("contaminated").count() == 0
    assert decontaminate.drop_contaminated(awkward, none).count() == len(AWKWARD)


# Substrings


def brute_repeats(rows, width):
    seen, out = {}, {}
    for ident, text in sorted(rows, key=lambda r: r[0]):
        words = (text or b"").split()
        hit = [False] * len(words)
        for k in range(len(words) - width + 1):
            window = tuple(words[k : k + width])
            if seen.setdefault(window, (ident, k)) != (ident, k):
                hit[k : k + width] = [True] * width
        out[ident] = (len(words), sum(hit), b" ".join(w for w, h in zip(words, hit) if not h).decode())
    return out


def test_substrings_equal_brute_force(spark, small):
    rows = [*rows_of(small), (10**6, b"a b a b a b a b a b"), (-5, b"a b a b")]
    frame = documents(spark, [(i, t.decode(), "") for i, t in rows])
    for width in (20, 3):
        found = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup.remove_repeats(frame, width=width).collect()}
        assert found == brute_repeats(rows, width)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), max_size=6), st.integers(1, 9))
def test_windows_are_found_within_a_chunk(texts, width):
    """The hash of a window depends on its words alone, and the earliest of equal ones is found."""
    numbers = {c: np.uint64(xxhash.xxh64_intdigest(c)) for c in "abc"}
    rows = [(i, np.array([numbers[c] for c in t], np.uint64), 0) for i, t in enumerate(texts)]
    if not any(len(t) for t in texts):
        return
    hashes, row, start = substring_dedup._windows(rows, width)
    windows = [(texts[r][s : s + width], r, s) for r, s in zip(row.tolist(), start.tolist())]
    assert len(windows) == sum(max(0, len(t) - width + 1) for t in texts)
    ids = np.arange(len(texts))
    later = substring_dedup._later(hashes, ids[row], start)
    for k, (words, r, s) in enumerate(windows):
        assert later[k] == any(w == words and (q, t) < (r, s) for w, q, t in windows)


def test_substrings_of_awkward_rows(awkward, nothing):
    found = substring_dedup.repeats_digest(awkward).collect()
    assert len(found) == len(AWKWARD) and substring_dedup.repeats_digest(nothing).count() == 0
    # The row without an id stands first; rows with equal ids are one document, of which the other text repeats.
    assert Counter((r.doc_id, r.n_words, r.n_removed) for r in found) >= Counter(
        {(None, 60, 0): 1, (4, 60, 60): 2, (4, 90, 60): 1, (8, 61, 60): 1, (5, 30000, 0): 1, (1, 0, 0): 1})


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=50), st.integers(1, 8))
def test_packing_round_trip(values, width):
    kept = np.array(values, np.uint64) % np.uint64(256**width - 1 if width < 8 else 2**64 - 1)
    assert unpack(pack(kept, width), np.uint64, width).tolist() == kept.tolist()


# Mixing


def test_targets_are_capped_and_reshared():
    assert mixing.targets([100, 100], [1, 1]) == [100, 100]
    assert mixing.targets([10, 190], [1, 1]) == [30, 170]
    assert mixing.targets([10, 20, 970], [5, 2, 1]) == [30, 60, 910]
    assert mixing.targets([0, 0], [5, 2]) == [0, 0] and mixing.targets([], []) == []


def test_splitting_tree_keeps_all_quotas():
    quotas = np.array([1000, 3, 0, 57])
    for shards in (1, 5, 16):
        tree = mixing.split_tree(quotas, shards, 1)
        assert (tree.sum(axis=0) == quotas).all() and (tree >= 0).all()
        assert tree.sum(axis=1).max() - tree.sum(axis=1).min() <= math.ceil(math.log2(shards + 1))
        assert (tree == mixing.split_tree(quotas, shards, 1)).all()


def test_mix_meets_targets(spark, small):
    found = mixing.mixed_sizes(small).join(small.select("doc_id", "source"), "doc_id").toPandas()
    again = mixing.mixed_sizes(small.repartition(3)).toPandas()
    assert dict(zip(found.doc_id, found.taken)) == dict(zip(again.doc_id, again.taken))
    assert (found.taken <= 3 * found["size"]).all() and len(found) == small.count()
    sizes = {i: len(t.split()) for i, t in rows_of(small)}
    assert dict(zip(found.doc_id, found["size"])) == sizes
    names = sorted(found.source.unique())
    totals = [int(found[found.source == n]["size"].sum()) for n in names]
    goals = mixing.targets(totals, [(5, 2, 1)[i % 3] for i in range(len(names))])
    for name, goal, total in zip(names, goals, totals):
        own = found[found.source == name]
        assert own.target.iloc[0] == pytest.approx(goal) and own.source_size.iloc[0] == total
        assert abs(own.taken.sum() - goal) <= own["size"].max()
    mixed = mixing.mix(small)
    taken = mixed.groupBy("doc_id").count().toPandas()
    assert {i: c * sizes[i] for i, c in zip(taken.doc_id, taken["count"])} == {i: t for i, t in zip(found.doc_id, found.taken) if t}
    assert mixed.select("mix_shard").distinct().count() == mixing.LEAST_SHARDS


def test_mix_of_awkward_rows(awkward, nothing):
    found = mixing.mixed_sizes(awkward).collect()
    assert len(found) == len(AWKWARD) and all(0 <= r.taken <= 3 * r["size"] for r in found)
    assert mixing.mixed_sizes(nothing).count() == 0 and mixing.mix(nothing).count() == 0
    assert mixing.mix(awkward).columns == [*awkward.columns, "mix_shard", "mix_round", "mix_order"]


# Quality


def test_base_counts():
    text = "a b c d\n a b c # 5% \n\na b c d\néé 中".encode()
    assert fertility.base_counts(text, text.split()) == (17, 2, 1, 11)
    assert fertility.base_counts(b"", []) == (0, 0, 0, 0)


def test_measures_equal_their_definition():
    tool = fertility.tools(fertility.load_vocabularies())[0]
    text = "Der große Hund, der große Hund; 中文!"
    ids = tool.encode(text)
    counts = Counter(ids)
    bits = -sum(c / len(ids) * math.log2(c / len(ids)) for c in counts.values())
    got = tool.measure(text, 7, 31)
    assert got[:2] == (31 / len(ids), len(ids) / 7) and got[2] == sum(bool(tool.part[i]) for i in ids) / len(ids)
    assert got[3] == pytest.approx(bits / math.log2(len(ids))) and got[4] == pytest.approx(bits / math.log2(len(counts)))


def test_labelled_documents_are_told_apart(spark):
    folder = SMALL.replace("0.001", "0.1")
    found = fertility.quality(spark.read.parquet(f"{folder}/documents.parquet"))
    found = found.where("not base_failed").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    kept = {r.quality: r.kept for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert kept[1] >= 0.995 and kept[0] <= 0.5


def test_quality_of_awkward_rows(spark, awkward, nothing):
    found = fertility.quality(awkward).collect()
    assert len(found) == len(AWKWARD) and fertility.quality(nothing).count() == 0
    assert all(r.base_failed and not r.kept for r in found if r.n_words < 50)
    kept = fertility.keep_quality(awkward)
    assert kept.columns == awkward.columns and kept.count() == sum(r.kept for r in found)
    unknown = documents(spark, [(1, "привет мир " * 60, "")]).withColumn("lang", F.lit(None).cast("string"))
    assert fertility.quality(unknown).first().base_failed
    assert fertility.script("привет".encode()) == "Cyrillic" and fertility.script(b"12") == "other"


# Lines


def test_lines_are_grouped(spark):
    base = prose(120, 3)
    words = base.split()
    changed = " ".join(words[:60] + ["zzz"] + words[61:])
    docs = documents(spark, [
        (1, f"{base}\nshort line", ""), (2, f"{base.upper()}!\n\nown words here", ""), (3, f"{changed}\nSHORT, line.\nmore of it", ""), (4, None, ""), (5, "", ""), (6, "short  line", ""),
    ])
    groups = {(r.doc_id, r.line): (r.kept_doc_id, r.kept_line) for r in fuzzy_lines.line_groups(docs).collect()}
    assert groups[2, 0] == (1, 0) and groups[3, 1] == (1, 1) and groups[6, 0] == (1, 1)
    assert set(groups) <= {(2, 0), (3, 0), (3, 1), (6, 0)}
    report = {r.doc_id: (r.n_lines, r.n_removed) for r in fuzzy_lines.line_report(docs).collect()}
    assert report[4] == (0, 0) and report[5] == (1, 0) and report[2] == (3, 1) and report[6] == (1, 1)
    left = {r.doc_id: r.text for r in fuzzy_lines.drop_repeated_lines(docs).collect()}
    assert left[1] == docs.where("doc_id = 1").first().text and left[2] == "\nown words here" and 6 not in left and left[5] == ""


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def least_hashes(words):
    signed = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    return sorted({h - 2**64 if h >= 2**63 else h for h in signed})


def majority(hashes):
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def line_blocks(words):
    """The blocks of a line as (kind, SimHash of their words)."""
    w = least_hashes([x for x in words if words.count(x) > 1] if len(words) >= 2 * len(set(words)) and len(words) > 1 else words)
    longer = least_hashes([x for x in words if len(x) >= 4])
    n, blocks = len(w), set()
    if n <= 8:
        width = 1 if n == 1 else 2 if n <= 3 else 3
        blocks |= {(-width, majority(c)) for c in combinations(w, width)}
    if n >= 7 and (n <= 24 or len(longer) < 8):
        blocks |= {(4, majority(w[k : k + 4])) for k in range(min(12, n - 3))}
    if n >= 18 and len(longer) >= 8:
        blocks |= {(3, majority(longer[k : k + 3])) for k in range(min(12, len(longer) - 2))}
    marks = {h & 63 for h in w[:16]}
    return blocks, marks


def may_be_near(a, b, marks_a, marks_b):
    return min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(marks_a ^ marks_b) <= 0.45 * (len(marks_a) + len(marks_b))


def test_line_groups_equal_brute_force(spark):
    """All pairs of different lines by shared blocks and edit distance, and the components they make."""
    rnd = random.Random(5)
    lines = [prose(rnd.randint(1, 90), 100 + i) for i in range(60)] + ["ab ab ab ab", "ab ab ab", "ab", "ab cd", "ab cd ef ab cd ef"]
    for i in range(0, 60, 2):
        words = lines[i].split()
        for _ in range(rnd.randint(1, 3)):
            words = [*words]
            at = rnd.randrange(len(words))
            words[at : at + rnd.randint(0, 1)] = [rnd.choice(VOCABULARY)] * rnd.randint(0, 2)
            words = words or ["x"]
            lines.append(" ".join(words))
    docs = documents(spark, [(i, line, "") for i, line in enumerate(lines)])
    parts = [x.lower().split() for x in lines]
    blocks = [line_blocks(w) for w in parts]
    root = list(range(len(lines)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(lines)):
        for j in range(i):
            met = blocks[i][0] & blocks[j][0] and may_be_near(lines[i], lines[j], blocks[i][1], blocks[j][1])
            if parts[i] == parts[j] or met and distance(lines[i], lines[j]) <= 0.2 * max(len(lines[i]), len(lines[j])):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    expected = {i: find(i) for i in range(len(lines)) if find(i) != i}
    assert {r.doc_id: r.kept_doc_id for r in fuzzy_lines.line_groups(docs).collect()} == expected and len(expected) > 40


def test_edited_given_lines_meet_their_origin(spark, small):
    """At each length nine of ten given lines that are edited and still similar by edit distance are linked, whatever their blocks."""
    rnd = random.Random(12)
    given_lines = sorted({w for r in small.select("text").collect() for x in r.text.split("\n") if (w := tuple(fuzzy_words(x)))})
    words = sorted({w for line in given_lines for w in line})
    pairs = []
    for low, high in ((5, 7), (8, 12), (13, 24), (25, 60), (61, 150), (151, 2000)):
        some = [line for line in given_lines if low <= len(line) <= high]
        for k in range(60):
            line = rnd.choice(some)
            edited = [*line]
            for _ in range(max(1, len(line) * (k % 3) // 20)):
                edited[rnd.randrange(len(edited))] = rnd.choice(words)
            if k % 4 == 3:
                del edited[rnd.randrange(len(edited))]
            pairs.append((low, " ".join(line), " ".join(edited)))
    docs = documents(spark, [(2 * i + j, pair[1 + j], "") for i, pair in enumerate(pairs) for j in (0, 1)])
    kept = {r.doc_id: r.kept_doc_id for r in fuzzy_lines.line_groups(docs).collect()}
    for low in sorted({p[0] for p in pairs}):
        similar = [i for i, (n, a, b) in enumerate(pairs) if n == low and a != b and near_by_words(a, b)]
        linked = sum(kept.get(2 * i + 1, 2 * i + 1) == kept.get(2 * i, 2 * i) for i in similar)
        print("lines of", low, "words on:", linked, "of", len(similar), "linked")
        assert len(similar) >= 15 and linked >= 0.9 * len(similar)


def fuzzy_words(line):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", line.lower())


def near_by_words(a, b):
    """Whether two texts with the same words but a few are 0.8 or more similar; only the stretch that differs is compared."""
    s, t, n = a.split(), b.split(), 0
    while n < min(len(s), len(t)) and s[n] == t[n]:
        n += 1
    m = 0
    while m < min(len(s), len(t)) - n and s[-1 - m] == t[-1 - m]:
        m += 1
    s, t = " ".join(s[n : len(s) - m]), " ".join(t[n : len(t) - m])
    # Stretches of over 1,500 characters come from less than a tenth of the words and so are near.
    return max(len(s), len(t)) > 1500 or distance(s, t) + 1 <= 0.2 * max(len(a), len(b))


def edited_long_lines():
    """Pairs of similar lines: one keeps no block among the least words of the other, one has over 1,000 characters and a letter changed in a quarter of the words."""
    rnd = random.Random(31)
    words = sorted({"".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(400)}, key=lambda w: least_hashes([w])[0])
    line, other = words[:60], words[:60]
    for k in (2, 5, 8, 11):
        other[k] = words[100 + k]
    first = [{majority(c[k : k + 3]) for k in range(12)} for c in (least_hashes(line), least_hashes(other))]
    assert not first[0] & first[1]
    long = [rnd.choice(words) + rnd.choice(words) for _ in range(200)]
    typed = [w[:-1] + "z" if k % 4 == 0 else w for k, w in enumerate(long)]
    return [(" ".join(line), " ".join(other)), (" ".join(long), " ".join(typed))]


def test_blocks_reach_all_words_and_long_lines_are_compared_by_characters(spark):
    """Similar lines are linked wherever they differ, and a line's length does not decide how near others must be."""
    pairs = edited_long_lines()
    docs = documents(spark, [(2 * i + j, text, "") for i, pair in enumerate(pairs) for j, text in enumerate(pair)])
    assert {r.doc_id: r.kept_doc_id for r in fuzzy_lines.line_groups(docs).collect()} == {1: 0, 3: 2}


@pytest.mark.parametrize("seed", [6, 7])
def test_all_buckets_take_part(spark, seed):
    """Members that have only some of their buckets in the first part: the second part looks at all of them."""
    rnd = random.Random(seed)
    buckets = [rnd.sample(range(40), rnd.randint(2, 7)) for _ in range(40)]
    members = spark.createDataFrame([(k, i, i) for k, ids in enumerate(buckets[:8]) for i in ids], "key long, id long, bits long")
    of_each = [(i, i, [k for k, ids in enumerate(buckets) if i in ids] * 2) for i in range(40)]
    every = spark.createDataFrame(of_each, "id long, bits long, keys array<long>")
    details = spark.createDataFrame([(i, i % 13) for i in range(40)], "id long, detail long")

    def check(pairs):
        return pairs.where("(a + b) % 7 = 0")

    gap = (F.abs(F.col("p") - F.col("q")) <= 9) | ((F.col("x") + F.col("y")) % 7 == 0)
    found = {r.id: r.component for r in bucket_components(members, F.lit(True), check, lambda ids: details.join(ids, "id"), gap, every).collect()}
    root = {i: i for i in range(40)}
    for _ in range(40):
        for ids in buckets:
            for a, b in combinations(ids, 2):
                if (a + b) % 7 == 0:
                    root[a] = root[b] = min(root[a], root[b])
    assert found == {i: r for i, r in root.items() if r != i or i in {q for p, q in root.items() if p != q}}


def test_distances_are_exact(spark):
    rnd = random.Random(8)
    rows = []
    for k in range(120):
        s = [rnd.choice(VOCABULARY[:30]) for _ in range(rnd.randint(1, 12))]
        t = [*s]
        for _ in range(rnd.randint(0, 4)):
            at = rnd.randrange(len(t) + 1)
            t[at : at + rnd.randint(0, 2)] = [rnd.choice(VOCABULARY[:30])] * rnd.randint(0, 2)
        rows.append((s, t or ["x"], rnd.choice([3, 8, 100])))
    frame = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, s array<string>, t array<string>, most int")
    for r in fuzzy_lines._distance(frame).collect():
        s, t, most = rows[r.k]
        exact = distance(" ".join(s), " ".join(t))
        assert r.distance == (exact if exact <= most else -1), (s, t, exact)


def test_most_similar_lines_are_linked(spark):
    """Against edit similarity alone, whatever the fingerprints: at each length nine of ten edited lines meet their origin."""
    rnd = random.Random(11)
    pairs = []
    for n in (5, 8, 12, 20, 30, 50, 100):
        for k in range(40):
            line = [f"{rnd.choice(VOCABULARY)}{rnd.choice(VOCABULARY)[:2]}" for _ in range(n)]
            edited = [*line]
            for _ in range(max(1, n * (k % 4) // 20)):
                edited[rnd.randrange(n)] = rnd.choice(VOCABULARY)
            pairs.append((n, " ".join(line), " ".join(edited)))
    docs = documents(spark, [(2 * i + j, pair[1 + j], "") for i, pair in enumerate(pairs) for j in (0, 1)])
    kept = {r.doc_id: r.kept_doc_id for r in fuzzy_lines.line_groups(docs).collect()}
    for n in {p[0] for p in pairs}:
        similar = [i for i, (m, a, b) in enumerate(pairs) if m == n and distance(a, b) <= 0.2 * max(len(a), len(b))]
        linked = sum(kept.get(2 * i + 1) == 2 * i for i in similar)
        assert len(similar) >= 20 and linked >= 0.9 * len(similar), (n, linked, len(similar))


def test_pairs_are_checked_once(spark):
    """Members of shared buckets of whom few are linked: no pair is given to the check twice, and none that counts is left out."""
    rnd, seen = random.Random(3), []
    buckets = [rnd.sample(range(40), rnd.randint(2, 6)) for _ in range(30)]
    members = spark.createDataFrame([(k, i, i) for k, ids in enumerate(buckets) for i in ids], "key long, id long, bits long")

    def check(pairs):
        seen.extend((max(r), min(r)) for r in pairs.collect())
        return pairs.where("(a + b) % 7 = 0")

    found = {r.id: r.component for r in bucket_components(members, F.lit(True), check).collect()}
    assert len(seen) == len(set(seen)) > 40
    root = {i: i for i in range(40)}
    for _ in range(40):
        for ids in buckets:
            for a, b in combinations(ids, 2):
                if (a + b) % 7 == 0:
                    root[a] = root[b] = min(root[a], root[b])
    assert found == {i: r for i, r in root.items() if r != i or i in {q for p, q in root.items() if p != q}}


def test_lines_that_share_frequent_words_are_not_checked(spark, monkeypatch):
    """Groups of lines with a block, a length and least words in common of which few are similar: their pairs are not all checked, and none that are similar are lost."""
    rnd, given = random.Random(21), []
    made = sorted({"".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(6000)}, key=lambda w: least_hashes([w])[0])
    lines = []
    for _ in range(30):
        lines.append(made[:20] + rnd.sample(made[1000:], 80))
        lines.append(["a", "b", "c", "d", "e"] + [x * 2 for x in rnd.sample(made[1000:], 3)])
    lines += [[*lines[40][:-3], *made[1000:1003]], [*lines[41][:-1], lines[41][-1][:-1] + "z"]]
    similar = fuzzy_lines._similar

    def counted(pairs, *more):
        given.append(pairs.count())
        return similar(pairs, *more)

    monkeypatch.setattr(fuzzy_lines, "_similar", counted)
    docs = documents(spark, [(i, " ".join(words), "") for i, words in enumerate(lines)])
    assert {r.doc_id: r.kept_doc_id for r in fuzzy_lines.line_groups(docs).collect()} == {60: 40, 61: 41}
    assert sum(given) <= 2 * len(lines)


@pytest.mark.parametrize("seed", [4, 5])
def test_details_lose_no_pairs(spark, seed):
    """Members with details, some given twice: components are those of all links that may hold, and no pair is checked twice."""
    rnd, seen = random.Random(seed), []
    buckets = [rnd.sample(range(40), rnd.randint(2, 9)) for _ in range(30)]
    members = spark.createDataFrame([(k, i, i) for k, ids in enumerate(buckets) for i in ids], "key long, id long, bits long")
    details = spark.createDataFrame([(i, i % 13) for i in range(40)] * 2, "id long, detail long")

    def check(pairs):
        seen.extend((max(r), min(r)) for r in pairs.collect())
        return pairs.where("(a + b) % 7 = 0")

    gap = F.abs(F.col("p") - F.col("q"))
    found = {r.id: r.component for r in bucket_components(members, F.lit(True), check, details, (gap <= 9) | ((F.col("x") + F.col("y")) % 7 == 0)).collect()}
    assert len(seen) == len(set(seen)) > 20
    root = {i: i for i in range(40)}
    for _ in range(40):
        for ids in buckets:
            for a, b in combinations(ids, 2):
                if (a + b) % 7 == 0:
                    root[a] = root[b] = min(root[a], root[b])
    assert found == {i: r for i, r in root.items() if r != i or i in {q for p, q in root.items() if p != q}}


def test_bytes_that_are_no_text(spark):
    """Strings that hold bytes which are not UTF-8, as Spark lets them."""
    rows = spark.createDataFrame([(1, bytearray(b"one \xff two three"),), (2, bytearray(b"\xc3")), (3, bytearray(b"word " * 60 + b"\xfe"))], "doc_id long, raw binary")
    docs = rows.select("doc_id", F.col("raw").cast("string").alias("text"), F.lit("en").alias("lang"))
    items = spark.createDataFrame([(7, "two three")], "item_id long, text string")
    found = {r.doc_id: (r.n_words, r.hit_words) for r in decontaminate.contaminated_words(docs, items).collect()}
    assert found == {1: (4, [2, 3]), 2: (1, []), 3: (61, [])}
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs, items).select("doc_id").collect()) == [2, 3]
    assert {r.doc_id: r.n_words for r in fertility.quality(docs).collect()} == {1: 4, 2: 1, 3: 61}
    assert fertility.keep_quality(docs).select("doc_id").count() == 0
    assert fuzzy_lines.line_report(docs).count() == 3 and simhash_docs.near_duplicates(docs).count() == 3


def test_a_line_of_symbols_is_left(spark):
    docs = documents(spark, [(1, "the same line", ""), (2, "the same line\n\u2605\U0001f600", ""), (3, "the same line\n...", "")])
    assert {r.doc_id: r.text for r in fuzzy_lines.drop_repeated_lines(docs).collect()} == {1: "the same line", 2: "\u2605\U0001f600"}


def test_lines_of_awkward_rows(awkward, nothing):
    assert fuzzy_lines.line_report(awkward).count() == len(AWKWARD) and fuzzy_lines.line_report(nothing).count() == 0
    left = fuzzy_lines.drop_repeated_lines(awkward)
    assert left.columns == awkward.columns and fuzzy_lines.drop_repeated_lines(nothing).count() == 0
    # Equal rows have one verdict; the row without an id is the first of its text.
    assert Counter(r.doc_id for r in left.collect())[4] in (0, 1) and left.where("doc_id is null").count() == 2


# Near duplicates


def brute_fingerprint(text):
    words = text.lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_brute_force(small):
    found = {r.doc_id: r.fingerprint for r in simhash_docs.near_duplicates(small).collect()}
    assert found == {i: f"{brute_fingerprint(t):016x}" for i, t in rows_of(small)}


def brute_components(bits):
    root = {i: i for i in bits}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in bits:
        for j in bits:
            if (bits[i] ^ bits[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in bits}


def test_groups_of_fingerprints_equal_brute_force(spark):
    """Chains and dense groups of near fingerprints, with copies."""
    rnd = random.Random(3)
    values = [rnd.getrandbits(64) for _ in range(40)]
    for v in values[:25]:
        for _ in range(8):
            for k in rnd.sample(range(64), rnd.randint(1, 4)):
                v ^= 1 << k
            values.append(v)
    hub = rnd.getrandbits(64)
    values += [hub ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(60)] + values[:5] + [0, 2**63, 2**64 - 1]
    bits = dict(enumerate(values))
    marked = spark.createDataFrame([(i, v - 2**64 if v >> 63 else v) for i, v in bits.items()], "id long, bits long")
    found = marked.join(simhash_docs.near_groups(marked), "bits")
    assert {r.id: r.component for r in found.collect()} == brute_components(bits)


def test_near_duplicates_of_awkward_rows(awkward, nothing):
    found = simhash_docs.near_duplicates(awkward).collect()
    assert len(found) == len(AWKWARD) and simhash_docs.near_duplicates(nothing).count() == 0
    zero = [r for r in found if r.fingerprint == "0" * 16]
    assert {r.component_id for r in zero} == {1} and {r.doc_id for r in zero} >= {1, 2, 3, None}
    left = simhash_docs.drop_near_duplicates(awkward)
    assert left.columns == awkward.columns and Counter(r.doc_id for r in left.collect()).most_common(1)[0][1] == 1
    assert simhash_docs.drop_near_duplicates(nothing).count() == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-9, 30), st.integers(-9, 30)), max_size=40))
def test_components_equal_brute_force(spark, edges):
    root = {n: n for e in edges if e[0] != e[1] for n in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    frame = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    assert {r.id: r.component for r in components(frame).collect()} == {n: find(n) for n in root}


def test_a_long_chain_is_one_component(spark):
    frame = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert components(frame).agg(F.count("*"), F.max("component")).first() == (301, 0)


# Language model


def test_base_scores_equal_brute_force(small):
    found = {r.doc_id: r for r in bloom_lm.score_documents(small).collect()}
    rows = [(i, [*t.lower().split(), None]) for i, t in rows_of(small)]
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    counts = Counter(w for i, ws in rows if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in rows:
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))


def test_the_filter_holds_quantised_counts():
    rnd = np.random.default_rng(1)
    keys, counts = rnd.integers(0, 2**63, 20000).astype(np.uint64), rnd.geometric(0.3, 20000)
    held = bloom_lm.Filter(bloom_lm.block(keys, counts))
    assert (held.level(keys) >= bloom_lm.levels(counts)).all()
    assert (held.level(keys) == bloom_lm.levels(counts)).mean() > 0.95
    assert (held.level(rnd.integers(0, 2**63, 20000).astype(np.uint64)) > 0).mean() < 0.03
    nothing = np.zeros(0, np.uint64)
    assert not bloom_lm.Filter(bloom_lm.block(nothing, nothing)).level(keys).any()


def test_scores_equal_brute_force(small):
    """With a filter so wide that it has no false members, every score follows from counts in a dictionary."""
    found = bloom_lm.score_documents(small, bits_each=2000).collect()
    rows = [(i, [*t.lower().split(), None]) for i, t in rows_of(small)]
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    one = Counter(w for i, ws in rows if not held[i] for w in ws)
    two = Counter(p for i, ws in rows if not held[i] for p in zip(["<start>", *ws], ws))
    mass = sum(one.values()) + 0.5 * (len(one) + 1)

    def level(c):
        return next(q for q in range(200) if c < 1.5**q - 1e-9) if c else 0

    def mean(c):
        members = [x for x in range(1, 3 * c + 3) if level(x) == level(c)] if c else [0]
        return (members[0] + members[-1]) / 2

    means, levels = {c: mean(c) for c in {0, *one.values(), *two.values()}}, {c: level(c) for c in {0, *one.values()}}

    def steps(ws):
        for u, v in zip(["<start>", *ws], ws):
            context = one[None] if u == "<start>" else one[u]
            yield means[one[v]], min(means[two[u, v]], means[context]), means[context], levels[context]

    explained, seen = Counter(), Counter()
    for i, ws in rows:
        if not held[i]:
            for single, both, context, q in steps(ws):
                gram, alone = max(both - 1, 0) / max(context - 1, 1), (max(single - 1, 0) + 0.5) / mass
                explained[q] += gram / (gram + alone)
                seen[q] += 1
    share = {q: min(0.95, explained[q] / n) for q, n in seen.items()}

    def score(ws):
        total = 0.0
        for single, both, context, q in steps(ws):
            w = share.get(q, 0.0) if context else 0.0
            total += math.log10(w * both / max(context, 1) + (1 - w) * (single + 0.5) / mass)
        return total

    expected = {i: score(ws) for i, ws in rows}
    assert len(found) == len(rows) and all(r.score == pytest.approx(expected[r.doc_id]) for r in found)


def test_score_prefers_what_it_has_learnt(spark):
    """Held-out texts of a language with word order score above their shuffled words, and above unigrams."""
    rnd = random.Random(1)
    order = {w: rnd.sample(VOCABULARY, 3) for w in VOCABULARY}

    def text(seed):
        r, out = random.Random(seed), []
        word = r.choice(VOCABULARY)
        for _ in range(80):
            out.append(word)
            word = r.choice(order[word])
        return out

    learnt = [(i, " ".join(text(i)), "") for i in range(600)]
    found = {r.doc_id: r for r in bloom_lm.score_documents(documents(spark, learnt)).where("held_out").collect()}
    assert len(found) > 80 and all(r.score > r.base_score + 20 for r in found.values())
    mixed = [(i, t if not bloom_lm.held_out(i) else " ".join(random.Random(i).sample(t.split(), 80)), "") for i, t, _ in learnt]
    shuffled = {r.doc_id: r.score for r in bloom_lm.score_documents(documents(spark, mixed)).where("held_out").collect()}
    assert all(found[i].score > shuffled[i] for i in found)


def test_scores_of_awkward_rows(spark, awkward, nothing):
    found = bloom_lm.score_documents(awkward).collect()
    assert len(found) == len(AWKWARD) and bloom_lm.score_documents(nothing).count() == 0
    assert {r.n_tokens for r in found if r.doc_id in (1, 2, 3)} == {1}
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in found)
    held = next(i for i in range(100) if bloom_lm.held_out(i))
    alone = bloom_lm.score_documents(documents(spark, [(held, "a b", "")])).first()
    assert (alone.train_tokens, alone.n_known, alone.n_tokens) == (0, 0, 3)


BASE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM 'SF/documents.parquet'),
w AS (SELECT doc_id, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word, generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS pos FROM d),
t AS (
  SELECT *, CASE WHEN lead(pos, 2) OVER p IS NOT NULL THEN word || ' ' || lead(word, 1) OVER p || ' ' || lead(word, 2) OVER p END AS three
  FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY pos)
),
c AS (SELECT *, three IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, three) > 1 AS again FROM t),
r AS (
  SELECT *, again OR coalesce(lag(again, 1) OVER p, false) OR coalesce(lag(again, 2) OVER p, false) AS covered
  FROM c WINDOW p AS (PARTITION BY doc_id ORDER BY pos)
),
per AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars, count(*) FILTER (covered) AS n_repeat_words FROM r GROUP BY 1),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (
  SELECT doc_id, sum(n - 1) AS n_dup_lines FROM (SELECT doc_id, line, count(*) AS n FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1, 2) GROUP BY 1
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
       coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
       coalesce(n_words, 0) < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN dup USING (doc_id)
"""


def test_base_counts_of_whole_tables_equal_sql(spark):
    import duckdb

    from gustline.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    told = duckdb.sql(f"SELECT {', '.join(names)} FROM ({BASE_SQL.replace('SF', folder)})").fetchall()
    found = [tuple(r) for r in QUERIES["op5_fertility"](spark, folder).select(*names).collect()]
    assert sorted(found) == sorted(tuple(int(x) if not isinstance(x, bool) else x for x in row) for row in told)
    assert len(found) >= 200 and any(row[4] for row in found) and any(row[5] for row in found)
