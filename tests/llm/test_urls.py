from __future__ import annotations

import math
import random

import pytest
from corpus import SMALL, table

from tillstone.llm import queries, urls

PAGES = "page_id long, url string"


def found(spark, rows, **settings):
    return {r.page_id: r for r in urls.filtered(spark.createDataFrame(rows, PAGES), **settings).collect()}


def parts(url: str | None) -> tuple[str, str]:
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[cut:]
    end = min([path.index(c) for c in "?#" if c in path], default=len(path))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    return host, path[:end]


def rule(host: str, path: str) -> tuple[str | None, str | None]:
    fits = []
    for verdict, text in urls.RULES:
        name, slash, rest = text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + rest):
            fits.append((len(text), text, verdict))
    return max(fits)[1:] if fits else (None, None)


ODD = [None, "", "x", "http://", "HTTP://Ex.COM", "a://b://c/d", "http://É.com/A?b#c", "http://u@h:80/p/q#r?s", "http://h?x/y",
       "http://com/", "http://notcom/", "https://www.example.com/en/1", "https://example.com/en/1", "http://a\nb.net/es/x\ny"]


def test_parts_and_rules(spark):
    got = found(spark, list(enumerate(ODD)))
    for i, url in enumerate(ODD):
        assert (got[i].host, got[i].path) == parts(url)
        assert got[i].rule == rule(*parts(url))[0]


def test_query_keeps_the_rules(spark):
    got = {r.page_id: r for r in queries.op8_urls(spark, SMALL).collect()}
    pages = table(SMALL, "pages")
    assert len(got) == len(pages)
    for page in pages:
        r = got[page["page_id"]]
        text, verdict = rule(*parts(page["url"]))
        assert (r.host, r.path, r.rule) == (*parts(page["url"]), text)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_templates_and_purity(spark):
    """Listings of a shop are labelled bad, its articles good; pages without a label follow their template."""
    rows, labels = [], []
    for i in range(200):
        rows += [(i, f"http://shop.org/buy/{i}.html"), (1000 + i, f"http://shop.org/read/story-{chr(97 + i % 26)}{i}/print")]
        if i % 2:
            labels += [(i, True), (1000 + i, False)]
    rows += [(5000, "http://else.org/buy/7.html")]
    known = spark.createDataFrame(labels, "page_id long, bad boolean")
    got = found(spark, rows, rules=[], labels=known)
    assert {got[i].template for i in range(200)} == {"/buy/*.html"}
    assert {got[1000 + i].template for i in range(200)} == {"/read/*/print"}
    assert {got[i].verdict for i in range(200)} == {"block"} and {got[1000 + i].verdict for i in range(200)} == {"allow"}
    assert got[5000].verdict == "allow"  # no label of its own host


def test_branches_alike_are_merged(spark):
    rows, labels = [], []
    for i, name in enumerate(["red", "blue", "green"] * 40):
        rows.append((i, f"http://a.org/{name}/{i}"))
        labels.append((i, name == "green"))
    got = found(spark, rows, rules=[], labels=spark.createDataFrame(labels, "page_id long, bad boolean"))
    by_name = {rows[i][1].split("/")[3]: got[i].template for i in got}
    assert by_name["green"] == "/green/*"
    assert got[2].verdict == "block" and got[0].verdict == "allow"
    alike = found(spark, rows, rules=[], labels=spark.createDataFrame([(i, i % 5 == 0) for i in range(120)], "page_id long, bad boolean"))
    assert {r.template for r in alike.values()} == {"/*/*"}


def test_deep_paths_repeated_rows_and_empty_tables(spark):
    rows = [(1, "http://a.b/" + "/".join("x" * 3 for _ in range(300))), (1, "http://a.b/"), (1, "http://a.b/"), (None, "http://a.b/y")]
    df = urls.filtered(spark.createDataFrame(rows, PAGES))
    assert df.count() == 4
    assert urls.filtered(spark.createDataFrame([], PAGES)).count() == 0
    own = spark.createDataFrame([(1, "http://a.b/c", "h", 3)], "page_id long, url string, host string, n int")
    assert urls.filtered(own).first().host == "a.b"


@pytest.mark.parametrize("segment,name", [("123", "*"), ("2024-01-02", "*"), ("12.html", "*.html"), ("deadbeef01", "*"), ("deadbeef", "deadbeef")])
def test_forms(spark, segment, name):
    assert found(spark, [(1, f"http://a.b/{segment}")])[1].template == f"/{name}"


def merged_by_hand(counted: dict[tuple[str, str], tuple[int, int]]) -> dict[tuple[str, str], str]:
    """(host, template) -> branch, one level after the other from the leaves up."""
    branch = {key: key[1] for key in counted}
    for level in range(max(len(t.split("/")) for _, t in counted) - 1, 0, -1):
        sums: dict = {}
        for key, (labels, bad) in counted.items():
            old = sums.get((key[0], branch[key]), (0, 0))
            sums[key[0], branch[key]] = (old[0] + labels, old[1] + bad)
        wild = {}
        for host, name in sums:
            parts = name.split("/")
            if len(parts) > level and not parts[level].startswith("*"):
                parts[level] = "*"
            wild[host, name] = "/".join(parts)
        into = {}
        for key, (labels, bad) in sums.items():
            group = [v for k, v in sums.items() if k[0] == key[0] and wild[k] == wild[key]]
            every, all_bad = sum(v[0] for v in group), sum(v[1] for v in group)
            rest = every - labels
            into[key] = key[1]
            if labels and rest:
                pooled = all_bad / every
                spread = math.sqrt(pooled * (1 - pooled) * (1 / labels + 1 / rest))
                if abs(bad / labels - (all_bad - bad) / rest) <= urls.SIGNIFICANT * spread:
                    into[key] = wild[key]
        branch = {key: into[key[0], name] for key, name in branch.items()}
    return branch


@pytest.mark.parametrize("seed", [1, 2])
def test_merging_like_by_hand(spark, seed):
    rng = random.Random(seed)
    counted = {}
    for _ in range(150):
        template = "".join("/" + rng.choice(["a", "b", "c", "*", "*.html"]) for _ in range(rng.randint(0, 4)))
        labels = rng.choice([0, 0, 3, 20, 60])
        counted[rng.choice(["h", "g"]), template] = (labels, rng.choice([0, labels, labels // 2, rng.randint(0, labels)]))
    rows = [(h, f"p{i}", t, 1, n, bad) for i, ((h, t), (n, bad)) in enumerate(counted.items())]
    paths = spark.createDataFrame(rows, "host string, path string, template string, n long, labels long, bad long")
    found = urls.templates(paths).collect()
    want = merged_by_hand(counted)
    assert {(r.host, r.template): r.branch for r in found} == want
    for r in found:
        mine = [counted[k] for k, name in want.items() if k[0] == r.host and name == r.branch]
        share = (sum(v[1] for v in mine) + 1) / (sum(v[0] for v in mine) + 2)
        assert r.share == pytest.approx(share) and r.rejected == (share > urls.PURITY)


def test_alike_sections_become_one_branch(spark):
    """Nine sections whose print pages are all bad, and one without labels."""
    sections = ["aaa", "bbb", "ccc", "ddd", "eee", "fff", "ggg", "hhh", "iii"]
    rows = [("h", f"/{s}/1/print", f"/{s}/*/print", 20, 20, 20) for s in sections] + [("h", "/kkk/1/print", "/kkk/*/print", 20, 0, 0)]
    paths = spark.createDataFrame(rows, "host string, path string, template string, n long, labels long, bad long")
    found = {r.template: (r.branch, r.rejected) for r in urls.templates(paths).collect()}
    assert {found[f"/{s}/*/print"] for s in sections} == {("/*/*/print", True)}
    assert found["/kkk/*/print"] == ("/kkk/*/print", False)
