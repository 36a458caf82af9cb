from __future__ import annotations

import random
import re
import time
from difflib import SequenceMatcher
from html import unescape

from corpus import SMALL, table

from tillstone.llm import extraction, queries

PAGES = "page_id long, url string, html string"


def texts(spark, rows):
    found = extraction.extracted(spark.createDataFrame(rows, PAGES)).collect()
    assert all(r.n_chars == len(r.text) for r in found)
    return {r.page_id: r.text for r in found}


def plain(html: str) -> list[str]:
    return [line[0] for line in extraction.lines(html) if not line[1]]


def test_markup_scripts_and_references_fall_away():
    html = (
        "<!DOCTYPE html><html><head><title>t</title><script>var a='</p><article>';</script></head><body><!-- <p>no</p> -->"
        "<p>One &amp; two&nbsp;three<br>four</p><p title='a > b'>fi<b>ve</b> \n six<p>&lt;seven&gt;<style>p{}</style> 8 &copy</body>"
    )
    assert plain(html) == ["One & two three", "four", "five six", "<seven> 8 ©"]


def test_what_stands_beside_the_text():
    html = (
        "<header>top<h1>x</h1></header><nav><ul><li>menu<li>more</ul></nav><div class='cookie-notice'><div>ok?</div></div>"
        "<article><header><h1>Title</h1></header><p>text<div class=\"ad\">buy<p>now</div><p>rest</article>"
        "<section id=comments><article>me too</article></section><aside>x</aside><form><p>mail</p></form><footer>(c)</footer>"
    )
    assert [(t, a) for t, hidden, a in extraction.lines(html) if not hidden] == [("Title", True), ("text", True), ("rest", True)]


def test_unclosed_menu_ends_with_the_article():
    assert plain("<nav><p>menu<article><p>text</article>after") == ["text", "after"]


def test_shared_is_a_longest_common_subsequence():
    rng = random.Random(2)

    def longest(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        return table[-1][-1]

    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(14))] for _ in range(2))
        found = extraction.shared(a, b)
        assert len(found) == longest(a, b)
        part, rest = [a[i] for i in sorted(found)], iter(b)
        assert all(x in rest for x in part)


def page(own: str, extra: str = "") -> str:
    return f"<body><div>Site name</div><p>{own} is told here at length, in words of its own</p><div>All rights</div>{extra}</body>"


def test_lines_of_the_site_are_deleted_and_copies_tell_nothing(spark):
    rows = [(1, "http://a.b/x/1", page("one")), (2, "http://a.b/x/2", page("two")), (3, "http://a.b/x/3", page("two"))]
    rows += [(4, "http://a.b/x/4", page("four")), (5, "http://lone.b/", page("five"))]
    got = texts(spark, rows)
    assert got[1] == "one is told here at length, in words of its own"
    assert got[2] == got[3] == "two is told here at length, in words of its own"
    assert got[5].startswith("Site name\nfive")


def test_an_articles_shared_lines_stay(spark):
    wrap = "<nav>menu</nav><article><p>Same licence line</p><p>{0} story</p></article>"
    got = texts(spark, [(i, f"http://a.b/{i}", wrap.format(i)) for i in range(4)])
    assert got == {i: f"Same licence line\n{i} story" for i in range(4)}


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "no scheme", ""), (2, "no scheme", ""), (None, "http://a/", "<p>x</p>"), (3, "http://c/", "<p" * 5000)]
    rows += [(4, "http://d/", "<p>word</p>" * 20_000), (5, "http://e/", "a" * 500_000), (6, "http://f/", "&" * 1000 + "<")]
    got = texts(spark, rows)
    assert got[1] == got[2] == "" and got[None] == "x" and len(got[5]) == 500_000 and got[4].count("\n") == 19_999
    assert extraction.extracted(spark.createDataFrame([], PAGES)).count() == 0
    own = "page_id long, url string, html string, host int, path string, text double"
    assert extraction.extracted(spark.createDataFrame([(1, "http://a/", "<p>x", 1, "p", 0.5)], own).drop("text")).first().text == "x"


def test_query_gives_the_articles(spark):
    """The pages' articles are read off with a pattern of this data set; every page must agree."""
    got = {r.page_id: r.text for r in queries.op1_extraction(spark, SMALL).collect()}
    pages = table(SMALL, "pages")
    assert len(got) == len(pages)
    for row in pages:
        article = re.search("<article>(.*?)</article>", row["html"], re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1|br)>", article)]
        want = "\n".join(b for b in blocks if b)
        assert got[row["page_id"]] == want, SequenceMatcher(None, got[row["page_id"]], want).ratio()


def test_classes_say_what_an_element_is():
    assert plain("<div class='site-header'>top</div><article class='post comments-open'><div class='header'>Title</div><p>a</article>") == ["Title", "a"]
    assert plain("<article>x</article><div id='c'><article class='comment'>no</article></div>") == ["x"]


def test_a_run_of_copies_loses_the_sites_lines(spark):
    for first in (True, False):  # the run is the host's first, or its last
        names = ["two"] * 4 + ["one"] if first else ["one"] + ["two"] * 4
        got = texts(spark, [(i, f"http://a.b/x/{i}", page(name)) for i, name in enumerate(names)])
        assert got == {i: f"{name} is told here at length, in words of its own" for i, name in enumerate(names)}
    alone = texts(spark, [(i, f"http://a.b/x/{i}", page("two")) for i in range(3)])
    assert set(alone.values()) == {"Site name\ntwo is told here at length, in words of its own\nAll rights"}


def test_a_site_of_mostly_shared_lines(spark):
    menu = "".join(f"<div>Place number {k} of a long menu</div>" for k in range(12))
    got = texts(spark, [(i, f"http://a.b/x/{i}", page(f"Tale {i}", menu)) for i in range(4)])
    assert got == {i: f"Tale {i} is told here at length, in words of its own" for i in range(4)}


def test_long_tables_and_broken_tags_take_linear_time():
    rng = random.Random(3)
    a, b = ([rng.choice("ab") for _ in range(100_000)] for _ in range(2))
    begun = time.monotonic()
    common = sorted(extraction.shared(a, b))
    part, rest = [a[i] for i in common], iter(b)
    assert len(common) > 75_000 and all(x in rest for x in part)
    for piece in ("<a ", '<a "', "<!", "<a '\" ", '<a ">"', "</", "<a b='", "<!--", "<x =\">"):
        extraction.lines(piece * 60_000)
    assert time.monotonic() - begun < 60


def test_halving_gives_a_longest_one_too(monkeypatch):
    rng = random.Random(4)
    for few in (0, 16):
        monkeypatch.setattr(extraction, "FEW", few)
        for _ in range(60):
            a, b = ([rng.choice("abc") for _ in range(rng.randrange(60))] for _ in range(2))
            monkeypatch.setattr(extraction, "PAIRS", 10**9)
            want = len(extraction.shared(a, b))
            monkeypatch.setattr(extraction, "PAIRS", 1)
            found = extraction.shared(a, b)
            part, rest = [a[i] for i in sorted(found)], iter(b)
            assert len(found) == want and all(x in rest for x in part)


def test_texts_do_not_depend_on_the_partitions(spark, monkeypatch):
    """A host with far more pages than a block, one large folder, copies, and hosts of one page."""
    monkeypatch.setattr(extraction, "BLOCK", 16)
    rng = random.Random(5)
    rows = [(i, f"http://big.b/{rng.choice(['x', 'x', f'f{i % 40}'])}/{i // 2}", page(f"tale {i // 3}")) for i in range(400)]
    rows += [(1000 + i, f"http://h{i}.b/1", page("lone")) for i in range(40)] + [(None, None, page("null"))] * 3
    df = spark.createDataFrame(rows, PAGES)
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for count in ("2", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", count)
            found.append(sorted(extraction.extracted(df.repartition(int(count))).collect(), key=str))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] and len(found[0]) == len(rows)
    own = sum(r.text == f"tale {r.page_id // 3} is told here at length, in words of its own" for r in found[0] if r.page_id is not None and r.page_id < 400)
    assert own >= 395  # a page whose block has copies of it only keeps its lines
