"""Pages and conversations on hand-written rows and against brute force."""

import heapq
import itertools
import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gustline.llm import chat_repair, host_boilerplate, url_rules
from gustline.llm.host_boilerplate import page_text

PAGES = "page_id long, url string, html string, host string, part long, node long"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], PAGES)


# Urls


def judged(spark, rows, rules=url_rules.RULES, redirects=None):
    table = spark.createDataFrame(list(rules), "rule string, verdict string")
    if redirects is not None:
        redirects = spark.createDataFrame(redirects, "source string, target string")
    return {r.page_id: r for r in url_rules.judge_urls(pages(spark, rows), table, redirects).collect()}


def test_hosts_paths_and_rules(spark):
    urls = [
        "https://A.Example.ORG/es/x?q#f", "http://example.org/en/12", "http://org", "http://notexample.org/en/1", "https://x.com/fr/", "https://x.com/de/1",
        "//x.com/de/1", "http://x.net?a=/de/", None, "http://É.com/fr/", "a://b://c.com/fr/", "http://x.com/frx",
    ]
    found = judged(spark, [(i, u, None) for i, u in enumerate(urls)])
    assert [(found[i].host, found[i].path, found[i].rule, found[i].verdict) for i in range(len(urls))] == [
        ("a.example.org", "/es/x", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"), ("org", "", None, "allow"),
        ("notexample.org", "/en/1", "org/", "allow"), ("x.com", "/fr/", "com/fr/", "allow"), ("x.com", "/de/1", "com/de/", "block"),
        ("", "", None, "allow"), ("x.net", "", None, "allow"), ("", "", None, "allow"), ("É.com", "/fr/", "com/fr/", "allow"),
        ("b:", "//c.com/fr/", None, "allow"), ("x.com", "/frx", None, "allow"),
    ]


def test_blocks_reach_aliases_but_not_allowed_urls(spark):
    canonical = '<link href="{}" rel="canonical">'
    rows = [
        (1, "http://a.net/1", canonical.format("http://x.com/de/1")), (2, "https://a.net/1/", None), (3, "http://b.net/2", '<META content="0; URL=/3" http-equiv=refresh>'),
        (4, "http://b.net/3", None), (5, "http://y.org/1", canonical.format("http://a.net/1")), (6, "http://c.net/", None), (7, "http://d.net/p?utm_source=x", None), (1, "http://a.net/1", None),
    ]
    rows += [(8, "one", None), (9, "two", None)]
    found = judged(spark, rows, redirects=[("one", "http://x.com/de/3"), ("http://b.net/2", "http://b.net/4"), ("http://b.net/4", "http://x.com/de/9"), ("http://d.net/p", "http://d.net/q")])
    assert {i: (r.rule, r.verdict) for i, r in found.items()} == {
        1: (None, "block"), 2: (None, "block"), 3: (None, "block"), 4: (None, "block"), 5: ("org/", "allow"), 6: (None, "allow"), 7: (None, "allow"), 8: (None, "block"), 9: (None, "allow")}


def test_urls_of_no_pages_and_without_rules(spark):
    assert judged(spark, []) == {} and judged(spark, [(1, "http://a.com/de/", "")], rules=[("zz/", "block")])[1].verdict == "allow"


# Main text


def test_markup_tells_the_article():
    page = (
        '<html><head><title>t</title></head><body class="has-sidebar"><nav>menu</nav><div class="cookie-notice">c<div>d</div></div><header>H</header><p>outside</p>'
        '<article class="post"><header><h1>T&eacute;st</h1></header><p>one<b>two</b><br>three &lt;x&gt;<!-- no --><form>f</form><script>var a="</p>";</script>'
        '<p>four\n\n five<section id="comments"><article>bad</article></section><aside>a</aside></article><article class="comment">bad</article><footer>z</footer></body>'
    )
    assert page_text(page) == ("Tést onetwo three <x> four five", "")
    assert page_text("<main><p>a</p><p>b</main><p>c") == ("a b", "")
    assert page_text("<p>hello <i>w</i>orld<div hidden>x</div><div class='ad'>y</div>&amp;") == ("", "hello world &")
    assert page_text('<div class="ads">never closed <article>kept') == ("kept", "")
    assert [page_text(x) for x in (None, "", "  ", "<p", "<script>x")] == [("", "")] * 2 + [("", "")] + [("", "<p")] + [("", "")]


def test_articles_keep_what_only_sounds_like_furniture():
    for attributes in ('class="overflow-hidden"', 'data-state="hidden-no"', 'class="related-work"', 'class="search-tips"', 'class="social-history"',
                       'hidden="false"', 'style="color:red"', 'title="a > b" class=\'x\'', "data-x='display:none'"):
        assert page_text(f"<article><div {attributes}><p>Real body text.</p></div> More.</article>") == ("Real body text. More.", "")
    for attributes in ("hidden", 'HIDDEN=""', 'style="display : none"', 'aria-hidden="true"', 'class="x comments"', "id=share", 'role="navigation"'):
        assert page_text(f"<article><div {attributes}><p>Gone.</p></div> More.</article>") == ("More.", "")
    assert page_text("<article>a <button>b</button> c <select><option>d</select> e <svg>f") == ("a c e f", "")
    assert page_text("<article>a < b <3 <!doctype x> <a href=\"x'y\">c</a> <p title='never closed>d</p> e") == ("a < b <3 c d e", "")


@pytest.mark.parametrize("piece", ["<script ", '<a "', "<a ", "<a '", "<", "</", "<!--", "<!", "<svg>", "<button>", '<p class="', "<p class='a\" ", "<style>", "<div hidden", "<article><nav>", "&amp", "<p a=b "])
def test_hostile_pages_take_time_by_their_length(piece):
    started = time.perf_counter()
    page_text(piece * (1_000_000 // len(piece)))
    assert time.perf_counter() - started < 3


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=20), min_size=1, max_size=5), st.integers(1, 6))
def test_shared_runs_equal_brute_force(streams, run):
    page = np.repeat(np.arange(len(streams)), [len(s) for s in streams])
    tokens = np.array([ord(c) for s in streams for c in s], np.int64)
    if not len(tokens):
        return
    expected = [0] * len(tokens)
    at = 0
    for s in streams:
        for k in range(len(s) - run + 1):
            n = sum(any(t[j : j + run] == s[k : k + run] for j in range(len(t) - run + 1)) for t in streams)
            for j in range(run):
                expected[at + k + j] = max(expected[at + k + j], n)
        at += len(s)
    assert host_boilerplate.repeated(tokens, page, page, run).tolist() == expected


def test_repeated_runs_go(spark):
    menu = " ".join(f"menu{i}" for i in range(12))
    notice = " ".join(f"notice{i}" for i in range(9))
    rnd = random.Random(2)
    own = [f"own{i} " + " ".join(rnd.choices("abcdefghijklmnop", k=40)) + f" end{i}" for i in range(20)]
    rows = [(i, f"http://h.net/{i}", f"<div>{menu}<p>{own[i]}</p></div>") for i in range(10)]
    rows += [(10 + i, f"http://g.net/{i}", f"<article><p>{notice}</p>{own[i]}</article>") for i in range(10)]
    rows += [(20 + i, f"http://f.net/{i}", f"<article>{own[i // 2]} {notice}</article>") for i in range(4)] + [(30, "http://e.net/", f"<p>{menu}"), (31, "http://e.net/", f"<p>{menu}")]
    rows += [(40, None, None), (None, "http://h.net/0", "")]
    found = {r.page_id: r for r in host_boilerplate.main_text(pages(spark, rows)).collect()}
    assert all(found[i].text == own[i] for i in range(10)) and all(found[10 + i].text == own[i] for i in range(10))
    assert all(found[20 + i].text == f"{own[i // 2]} {notice}" for i in range(4))
    assert found[30].text == found[31].text == menu and found[40].text == "" and found[None].n_chars == 0
    assert all(r.n_chars == len(r.text) for r in found.values()) and len(found) == len(rows)
    assert host_boilerplate.main_text(pages(spark, [])).count() == 0


def test_large_hosts_are_cut_into_blocks(spark):
    text = " ".join(f"w{i}" for i in range(10))
    n = 2 * host_boilerplate.BLOCK_PAGES + 5
    frame = pages(spark, [(i, f"http://h.net/{i}", f"<p>{text} own{i}") for i in range(n)])
    assert {r.text for r in host_boilerplate.main_text(frame).collect()} == {f"own{i}" for i in range(n)}


def test_a_template_on_few_pages_of_a_large_host_goes(spark):
    rnd = random.Random(5)
    template = " ".join(f"t{i}" for i in range(12))
    own = [" ".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=30)) + f" own{i}" for i in range(5000)]
    shown = [f"<p>{own[i]}</p>" + (f"<p>{template}</p>" if i % 20 == 0 else "") for i in range(5000)]
    rows = [(i, f"http://h.net/{i}", x) for i, x in enumerate(shown)]
    # Copies in different blocks keep their text; a run of two pages only goes, wherever they are.
    rows += [(10_000 + i, f"http://h.net/copy{i}", f"<p>{own[7]}</p>") for i in range(40)]
    rows += [(20_000 + i, f"http://h.net/two{i}", f"<p>one two three four five six seven eight nine</p>{i}") for i in range(2)]
    found = {r.page_id: r.text for r in host_boilerplate.main_text(pages(spark, rows)).collect()}
    assert all(found[i] == own[i] for i in range(5000)) and all(found[10_000 + i] == own[7] for i in range(40))
    assert [found[20_000 + i] for i in range(2)] == ["0", "1"]


def test_runs_of_a_host_equal_brute_force_in_any_blocks(spark):
    rnd, run = random.Random(9), 3
    texts = [" ".join(rnd.choices("abcdef", k=rnd.randrange(0, 14))) for _ in range(600)]
    found = {r.page_id: r.text for r in host_boilerplate.main_text(pages(spark, [(i, f"http://h.net/{i}", t) for i, t in enumerate(texts)]), run=run).collect()}
    having = {}
    for text in set(texts):
        words = text.split()
        for k in range(len(words) - run + 1):
            having.setdefault(tuple(words[k : k + run]), set()).add(text)
    for i, text in enumerate(texts):
        words = text.split()
        gone = {k + j for k in range(len(words) - run + 1) if len(having[tuple(words[k : k + run])]) > 1 for j in range(run)}
        assert found[i] == " ".join(w for k, w in enumerate(words) if k not in gone)


def test_runs_of_articles_are_counted_over_the_whole_host(spark):
    """A notice on 85 % of the different articles goes from all of them, one on 75 % from none, whatever block a page is in; copies count once."""
    rnd, n = random.Random(6), 3000
    most, many = (" ".join(f"{name}{i}" for i in range(9)) for name in ("most", "many"))
    own = [" ".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=30)) + f" own{i}" for i in range(n)]
    texts = [f"{own[i]}" + f" {most}" * (i % 20 < 17) + f" x{i} {many}" * (i % 4 < 3) for i in range(n)]
    rows = [(i, f"http://h.net/{i}", f"<article>{x}</article>") for i, x in enumerate(texts)]
    rows += [(n + i, f"http://h.net/copy{i}", f"<article>{texts[3]}</article>") for i in range(1500)]
    # What all of few articles repeat in every block, as copies, is no notice of eight articles.
    rows += [(10_000 + i, f"http://g.net/{i}", f"<article>{most} {i % 7}</article>") for i in range(2000)]
    found = {r.page_id: r.text for r in host_boilerplate.main_text(pages(spark, rows)).collect()}
    assert [found[i] for i in range(n)] == [t.replace(f" {most}", "") for t in texts]
    assert {found[n + i] for i in range(1500)} == {texts[3].replace(f" {most}", "")}
    assert [found[10_000 + i] for i in range(2000)] == [f"{most} {i % 7}" for i in range(2000)]


# Chats


def least_cost(given):
    done, queue = set(), [(0, 0, 0)]
    while queue:
        cost, k, s = heapq.heappop(queue)
        if (k, s) == (len(given), 3) or (k, s) == (0, 0) and not given:
            return cost
        if (k, s) in done:
            continue
        done.add((k, s))
        for t in range(1, 4):
            legal = (chat_repair.STATES[s], chat_repair.STATES[t]) in chat_repair.NEXT
            if legal:
                heapq.heappush(queue, (cost + chat_repair.INSERT, k, t))
            if k < len(given):
                moved = 0 if given[k] == t else chat_repair.RELABEL if given[k] else chat_repair.RELABEL_UNKNOWN
                if legal:
                    heapq.heappush(queue, (cost + moved, k + 1, t))
                if s == t:
                    heapq.heappush(queue, (cost + moved + chat_repair.MERGE, k + 1, t))
    return None


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 5, 6) for r in rows], "conv_id long, turn long, role string, text string, place long, chunk long")


@pytest.mark.parametrize("partitions", ["2", "9"])
def test_repairs_are_legal_and_cheapest(spark, partitions):
    rnd, rows = random.Random(4), []
    for i in range(60):
        for k in range(500 if i == 7 else rnd.choice([1, 2, 3, 6])):
            rows.append((None if i == 5 else i, k, rnd.choice(["system", "user", "assistant", " User", "bot", "??", None]), f"t{k}"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        out = chat_repair.repair(conversations(spark, rows)).orderBy("conv_id", "place", "part").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len({r.conv_id for r in out}) == 60
    for conv, group in itertools.groupby(out, lambda r: r.conv_id):
        group, own = list(group), [r for r in rows if r[0] == conv]
        cost = sum(
            chat_repair.INSERT if r.action == "insert" else chat_repair.MERGE * ("merge" in r.action)
            + (chat_repair.RELABEL if chat_repair.role_number(r.role) else chat_repair.RELABEL_UNKNOWN) * ("relabel" in r.action)
            for r in group
        )
        assert cost == least_cost([chat_repair.role_number(r[2]) for r in own])
        assert [r.turn for r in group if r.turn is not None] == [r[1] for r in own]
        turns = "".join(r.rendered for r in group).split("<|end|>\n")
        assert turns.pop() == ""
        state, texts = "start", []
        for turn in turns:
            role, text = turn.removeprefix("<|").split("|>\n", 1)
            assert (state, role) in chat_repair.NEXT
            state, texts = role, [*texts, *(text.split("\n") if text else [])]
        assert state == "assistant" and texts == [r[3] for r in own]


def test_rendering_and_awkward_turns(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "human", "hi"), (1, 2, "user", None), (2, 0, "assistant", "a"), (3, 1, "user", "late"), (3, None, "user", "first"),
        (4, 1, "user", "x"), (4, 1, "user", "x"), (5, 0, None, "y" * 100_000),
    ]
    out = chat_repair.repair(conversations(spark, rows)).orderBy("conv_id", "place", "part").collect()
    texts = {c: "".join(r.rendered for r in g) for c, g in itertools.groupby(out, lambda r: r.conv_id)}
    assert texts[1] == "<|system|>\nbe kind<|end|>\n<|user|>\nhi\n<|end|>\n<|assistant|>\n<|end|>\n"
    assert texts[2] == "<|user|>\n<|end|>\n<|assistant|>\na<|end|>\n"
    assert texts[3].startswith("<|user|>\nfirst\nlate<|end|>") or texts[3].startswith("<|user|>\nfirst<|end|>\n<|assistant|>\nlate")
    assert texts[4].count("x") == 2 and "y" * 100_000 in texts[5]
    assert [r.action for r in out if r.conv_id == 1] == ["keep", "keep", "merge", "insert"]
    assert chat_repair.repair(conversations(spark, [])).count() == 0
