"""Urls and HTML: fixed cases, and the whole small table."""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict

import pytest

from pyspark.sql import functions as F

from rategauge.llm import html, queries, urls
from tests.helpers import python_free

PAGES = [
    (1, "http://A.Example.net/en/1?x#y", "<article><h1>T &amp; U</h1><p>a  b<br>c<p>d</article>"),
    (2, "https://x.example.com/de/2", None),
    (3, "http://example.org#f", ""),
    (4, None, "<nav>menu</nav>plain &lt;text&gt;"),
    (5, "no scheme", "<p>one<p>two"),
    (6, "http://notexample.net/en/1", "<div class='ad'>buy</div><p>kept"),
    (7, "http://net/", "<script>var a='<p>no</p>'</script><p>yes"),
    (7, "http://net/", "<script>var a='<p>no</p>'</script><p>yes"),
    (8, "http://q.org?u=http://w.net/fr/", "<form>f</form><aside>s</aside><footer>g</footer>"),
    (9, "http://k.org/fr/abc/def", "<article><p>body</p><section class='comments'><p>first!</p></section></article>"),
]
SCHEMA = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, SCHEMA)


def test_rules(pages):
    got = {r.page_id: (r.host, r.path, r.rule) for r in urls.judged_urls(pages).collect()}
    assert got == {
        1: ("a.example.net", "/en/1", "example.net/en/"),
        2: ("x.example.com", "/de/2", "example.com/de/"),
        3: ("example.org", "", None),
        4: ("", "", None),
        5: ("", "", None),
        6: ("notexample.net", "/en/1", "net/"),
        7: ("net", "/", "net/"),
        8: ("q.org", "", None),
        9: ("k.org", "/fr/abc/def", "org/fr/"),
    }
    assert urls.judged_urls(pages).count() == len(PAGES)
    assert python_free(urls.judged_urls(pages))
    assert urls.judged_urls(pages.limit(0)).count() == 0


def test_templates_learn_from_labels(spark):
    rows = [(i, f"http://h.io/{'bad' if i % 2 else 'good'}/{i}") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "id long, bad int")
    got = urls.judged_urls(pages, labels).collect()
    assert {r.template for r in got} == {"/bad/*", "/good/*"}
    assert all((r.verdict == "block") == (r.page_id % 2 == 1) for r in got)


def test_rare_literals_become_wildcards(spark):
    names = [f"{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    pages = spark.createDataFrame([(i, f"http://h.io/user/{n}") for i, n in enumerate(names)], "page_id long, url string")
    assert {r.template for r in urls.judged_urls(pages).collect()} == {"/user/*"}


def test_extraction(pages):
    got = {r.page_id: r.text for r in html.extracted(pages).collect()}
    assert got == {
        1: "T & U\na b c\nd", 2: "", 3: "", 4: "plain <text>", 5: "one\ntwo", 6: "kept", 7: "yes", 8: "", 9: "body",
    }
    assert html.extracted(pages.limit(0)).count() == 0


def test_whole_table(spark, sf_dir):
    import html as decode

    rows = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in html.extracted(rows).collect()}
    for page in rows.collect():
        inside = re.search(r"<article>(.*?)(?:</article>|$)", page.html, re.S)[1].replace("<br>", " ")
        blocks = (decode.unescape(re.sub("<[^>]*>", "", b)).split() for b in re.split("</?(?:p|h1)>", inside))
        want = "\n".join(" ".join(b) for b in blocks if b)
        assert (got[page.page_id].text, got[page.page_id].n_chars) == (want, len(want))


def test_density_without_an_article():
    page = (
        "<body><div id=top><a href=x>Home</a> <a href=y>News</a></div><div class=layout><div class=left><ul>"
        + "".join(f"<li><a href={i}>Link number {i}</a></li>" for i in range(12))
        + "</ul></div><div class=text><h2>Head</h2>" + "<p>A sentence that is long enough to be text, with words. </p>" * 4
        + "</div></div></body>"
    )
    assert html.main_text(page).split("\n") == ["Head"] + ["A sentence that is long enough to be text, with words."] * 4


def line(k: int) -> str:
    return f"Sentence {k:03d} has words enough to be some sixty characters long"


def paragraphs(first: int, n: int = 4) -> str:
    return "".join(f"<p>{line(k)}</p>" for k in range(first, first + n))


def test_text_in_several_containers():
    links = "<ul>" + "".join(f"<li><a href={i}>Link number {i}</a></li>" for i in range(12)) + "</ul>"
    split = f"<div>{paragraphs(0)}</div><div class=ad>buy</div><h2>Next</h2><div>{paragraphs(4)}</div>"
    want = [*map(line, range(4)), "Next", *map(line, range(4, 8))]
    assert html.main_text(f"<body><div class=content>{split}</div></body>").split("\n") == want
    assert html.main_text(f"<body><div>{links}</div><div class=content>{split}</div></body>").split("\n") == want
    tail = f"<body><div>{links}</div><div><div>{paragraphs(0)}</div><div>{paragraphs(4)}</div><p>End</p></div></body>"
    assert html.main_text(tail).split("\n") == [*map(line, range(8)), "End"]


def test_several_articles():
    three = f"<article>{paragraphs(0)}</article><article><p>Short</p></article><article>{paragraphs(4)}</article>"
    want = [*map(line, range(4)), "Short", *map(line, range(4, 8))]
    for page in (three, f"<main>{three}</main>", f"<div><a href=x>Home</a></div><div>{three}</div>"):
        assert html.main_text(f"<body>{page}</body>").split("\n") == want


@pytest.mark.parametrize("wrapper", [
    'div class="page no-sidebar"', 'div class="has-header"', 'div class="content-with-sidebar"', 'div id="search-page"',
    'div class="page sidebar"', 'form action="/"', 'div class="widget-area"',
])
def test_wrappers_named_like_parts(wrapper):
    end = f"</{wrapper.split()[0]}>"
    want = list(map(line, range(4)))
    for inner in (f"<article>{paragraphs(0)}</article>", f"<div>{paragraphs(0)}</div>"):
        page = f"<body><{wrapper}><div class='ad-slot'>buy</div>{inner}{end}<div class=comments>{paragraphs(9, 9)}</div></body>"
        assert html.main_text(page).split("\n") == want


def test_names_inside_an_article():
    parts = "<p class='share-price'>Price</p><div class='side-by-side'><p>Both</p></div><div class='share-buttons'>Tweet</div>"
    rest = "<div class='cookie-notice'>Cookies</div><div id=site-footer>Foot</div><section class=related><article>Teaser</article></section>"
    page = f"<body><article>{paragraphs(0)}{parts}</article>{rest}</body>"
    assert html.main_text(page).split("\n") == [*map(line, range(4)), "Price", "Both"]
    assert html.main_text(f"<body><div>{paragraphs(0)}</div><form><div>Name</div></form></body>").split("\n") == list(map(line, range(4)))


def test_short_text_beside_many_links():
    links = "<div>" + "".join(f"<a href={k}>Link number {k}</a> " for k in range(20)) + "</div>"
    assert html.main_text(f"<body><p>Hi.</p>{links}</body>") == "Hi."
    assert html.main_text(f"<body>{links}<div>{paragraphs(0)}</div>{links}</body>").split("\n") == list(map(line, range(4)))


def test_labels_and_buttons_are_words_of_an_article_but_not_of_its_forms():
    form = "<form><p><label>Name</label></p><button>Send</button></form>"
    page = f"<article>{paragraphs(0)}<p>One <label>two</label> three.</p><p><button>Four</button></p>{form}</article>"
    want = [*map(line, range(4)), "One two three.", "Four"]
    assert html.main_text(f"<body><button>Menu</button>{page}</body>").split("\n") == want
    assert html.main_text(f"<body><div>{paragraphs(0)}</div>{form}</body>").split("\n") == list(map(line, range(4)))


def _labelled(spark, paths):
    rows = [(k, f"http://h.org{p}", bad) for k, (p, bad) in enumerate(paths)]
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[2] is not None], "id long, bad int")
    return {r.path: r for r in urls.judged_urls(pages, labels, rules=()).collect()}


def test_what_stands_below_rare_segments_is_counted_together(spark):
    """Each user has one page of either kind; only the kinds tell good from bad."""
    names = [f"{a}{b}" for a in "abcdefghijklmn" for b in "opqrstuvw"]
    paths = [(f"/{u}/{kind}/x", bad if k % 2 else None) for k, u in enumerate(names) for kind, bad in (("spam", 1), ("posts", 0))]
    got = _labelled(spark, paths)
    assert {r.template for r in got.values()} == {"/*/spam/x", "/*/posts/x"}
    assert all(r.verdict == ("block" if "spam" in p else "allow") for p, r in got.items())


def test_siblings_that_do_not_differ_share_their_subtrees(spark):
    """Two languages are labelled alike, so the bad section of one tells of the other's."""
    paths = [(f"/{lang}/{part}/p{k}a", bad) for lang in ("en", "fr") for part, bad in (("ads", 1), ("news", 0)) for k in range(30)]
    paths += [(f"/it/{part}/only", None) for part in ("ads", "news")]
    got = _labelled(spark, paths)
    assert got["/it/ads/only"].verdict == "block" and got["/it/news/only"].verdict == "allow"
    assert got["/it/ads/only"].purity == got["/en/ads/p1a"].purity


def test_deep_paths_ties_and_clashing_columns(spark):
    deep = "/" + "/".join("abcdefghijklmnopq")
    rows = [(1, "http://h.org" + deep), (1, "http://h.org" + deep), (2, None), (3, "x"), (4, "http://h.org/" + "y" * 100_000), (None, "HTTP://A.b/c")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = urls.judged_urls(pages).collect()
    odd = urls.judged_urls(pages.withColumns({c: F.lit("x") for c in "id host path static hit bad template branch n m b html".split()})).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, odd)) and len(got) == len(rows)
    assert [r.template for r in got if r.page_id == 1] == [deep] * 2
    assert [r.verdict for r in got if r.page_id == 2] == ["allow"]


def test_many_rules_are_joined(spark, monkeypatch):
    hosts = ["org", "a.org", "b.a.org", "x.net", "A.org.net", "org.", ""]
    urls_ = [f"http://{h}{p}" for h in hosts for p in ("", "/", "/en/x", "/fr/", "/en")] + [None, "none"]
    pages = spark.createDataFrame(list(enumerate(urls_)), "page_id long, url string")
    rules = [urls.Rule(v, h, p) for h, p, v in (("org", "/", "allow"), ("a.org", "/en/", "block"), ("a.org", "/", "block"), ("net", "/fr", "block"), ("b.a.org", "/en", "allow"))]
    inline = [(r.page_id, r.rule, r.verdict) for r in urls.judged_urls(pages, rules=rules).collect()]
    monkeypatch.setattr(urls, "INLINE_RULES", 1)
    joined = urls.judged_urls(pages, rules=rules)
    assert sorted(inline) == sorted((r.page_id, r.rule, r.verdict) for r in joined.collect())
    assert python_free(joined) and any(rule == "b.a.org/en" for _, rule, _ in inline)


def _plain_verdicts(rows, branches=50, z=1.96, prior=10.0, purity=0.5):
    """``{(host, path): (template, purity, verdict)}`` of ``(host, path, bad)``: the tree, grown in plain Python."""
    def general(s):
        ending = re.search(r"\.[A-Za-z]{1,5}$", s)
        varies = re.search("[0-9]", s) or re.match("[A-Fa-f]{12,}", s) or len(s) > 40
        return "*" + (ending[0] if ending else "") if varies else s

    trees = {}
    for _, path, _ in rows:
        segments = [general(s) for s in path.split("/") if s]
        last = ["/".join(segments[urls.DEPTH - 1 :])] if len(segments) > urls.DEPTH else segments[urls.DEPTH - 1 :]
        trees[path] = segments[: urls.DEPTH - 1] + last
    shown, branch = [[] for _ in rows], [(host,) for host, _, _ in rows]

    def counts(keys):
        out = defaultdict(lambda: [0, 0, 0])
        for key, (_, _, bad) in zip(keys, rows):
            if key is not None:
                for k, add in enumerate((1, bad is not None, bad or 0)):
                    out[key][k] += add
        return out

    for level in range(urls.DEPTH):
        at = [trees[path][level] if level < len(trees[path]) else None for _, path, _ in rows]
        each = counts([(b, s) if s is not None else None for b, s in zip(branch, at)])
        whole = counts([b if s is not None else None for b, s in zip(branch, at)])
        name = {(b, s): "*" if n * branches < whole[b][0] else s for (b, s), (n, _, _) in each.items()}
        arcs = counts([(b, name[b, s]) if s is not None else None for b, s in zip(branch, at)])
        for k, s in enumerate(at):
            if s is None:
                continue
            b = branch[k]
            called = name[b, s]
            (_, m, bad), (_, all_m, all_bad) = arcs[b, called], whole[b]
            alike = True
            if m and all_m - m:
                share = all_bad / all_m
                spread = math.sqrt(share * (1 - share) * (1 / m + 1 / (all_m - m)))
                alike = abs(bad / m - (all_bad - bad) / (all_m - m)) <= z * spread
            shown[k].append(called)
            branch[k] = (*b, "~" if alike else called)
    ends, hosts = counts(branch), counts([(host,) for host, _, _ in rows])
    labelled, all_bad = sum(m for _, m, _ in hosts.values()), sum(b for _, _, b in hosts.values())
    every = (labelled - all_bad + 1) / (labelled + 2)
    out = {}
    for (host, path, _), names, b in zip(rows, shown, branch):
        (_, hm, hb), (_, m, bad) = hosts[(host,)], ends[b]
        good = (m - bad + prior * ((hm - hb + prior * every) / (hm + prior))) / (m + prior)
        out[host, path] = ("/" + "/".join(names), good, "block" if good < purity else "allow")
    return out


def _same_verdicts(got, rows, rules=()):
    """``got`` against plain rules and the plain tree, for ``rows`` of ``(host, path, label)``."""
    def hit(host, path):
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return min(fits, key=lambda r: (-len(r.name), r.name), default=None)

    hits = {(host, path): hit(host, path) for host, path, _ in rows}
    bads = [(h, p, bad if hits[h, p] is None else int(hits[h, p].verdict == "block")) for h, p, bad in rows]
    want = _plain_verdicts(bads)
    assert len(got) == len(rows)
    for r in got:
        template, purity, learnt = want[r.host, r.path]
        rule = hits[r.host, r.path]
        assert (r.template, r.rule, r.verdict) == (template, rule and rule.name, rule.verdict if rule else learnt)
        assert r.purity == pytest.approx(purity, abs=1e-12)


@pytest.mark.parametrize("seed", [1, 2])
def test_tree_is_the_plain_one(spark, seed):
    """Three hosts, one of them with most pages; what a label says hangs on some of the segments."""
    draw = random.Random(seed)
    names = ["ads", "news", "spam", "en", "fr"] + [f"u{a}{b}" for a in "abcdefgh" for b in "opqrstuv"]
    rows = []
    for _ in range(1500):
        path = "".join("/" + draw.choice(names[: draw.choice([3, 5, len(names)])]) for _ in range(draw.randrange(5)))
        path += draw.choice(["", "/", f"/{draw.randrange(99)}.html", "/index.php", "/a/b/c/d/e/f/g"])
        bad = int(draw.random() < (0.9 if "spam" in path or "/ads/news" in path else 0.15))
        rows.append((draw.choice(["h.org", "h.org", "h.org", "k.net", "m.io"]), path, bad if draw.random() < 0.4 else None))
    pages = spark.createDataFrame([(k, f"http://{h}{p}") for k, (h, p, _) in enumerate(rows)], "page_id long, url string")
    labels = spark.createDataFrame([(k, bad) for k, (_, _, bad) in enumerate(rows) if bad is not None], "id long, bad int")
    got = urls.judged_urls(pages, labels, rules=()).collect()
    _same_verdicts(got, rows)
    assert {r.verdict for r in got} == {"allow", "block"} and any("/*" in r.template for r in got)
    ruled = (urls.Rule("block", "net", "/spam/"), urls.Rule("allow", "k.net", "/spam/en"), urls.Rule("block", "org", "/"))
    _same_verdicts(urls.judged_urls(pages, labels, rules=ruled).collect(), rows, ruled)


def test_every_page_is_judged_as_by_the_plain_tree(spark, sf_dir):
    label = {r.doc_id: int(r.quality == 0 or r.toxic == 1) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = queries.op6_url_filters(spark, sf_dir).collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    _same_verdicts(got, [(r.host, r.path, label.get(r.page_id)) for r in got], urls.RULES)
