import html
import random
import re

import pytest
from pyspark.sql import functions as F

from riskspark.llm import html_extract as op

PAGES = "page_id long, url string, html string"
WORDS = "alpha beta gamma delta été & <tag> \"quoted\" nine ten".split()


def article(rng):
    return [" ".join(rng.choice(WORDS) for _ in range(rng.randint(5, 40))) for _ in range(rng.randint(1, 6))]


def esc(text):
    return html.escape(text)


def plain_site(blocks, rng):
    body = "".join(f"<p>{esc(b)}</p>" for b in blocks)
    return (f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li><a href='/'>home</a></ul>"
            f"</nav><div class='ad'>buy now</div><article>{body}</article><footer>&copy; site</footer></body></html>")


def div_site(blocks, rng):
    body = "".join(f"<div class=para>{esc(b)}</div>" for b in blocks)
    return (f"<html><body><div id='top-menu'><a href=/>a</a></div><div class='wrap'><div id='page-{rng.randrange(9)}'>"
            f"<div class='left'><a href=x>l</a></div></div><div class='entry-content'>{body}"
            f"<div class='comments'><p>reader says hi</p></div></div></div><div class='cookie-notice'>accept</div>")


def unnamed_site(blocks, rng):
    body = "".join(f"<p>{esc(b)}" for b in blocks)  # left open
    return (f"<body><table><tr><td class=x1><a href=/>one</a> <a href=/>two</a><td class=x2>{body}</table>"
            f"<form><p>name <input></p></form><script>var a = '<p>no</p>';</script>")


def main_site(blocks, rng):
    body = "\n".join(f"<h2>{esc(b)}</h2>" if i == 0 else f"<p>{esc(b)}<br></p>" for i, b in enumerate(blocks))
    return (f"<html><body><header><h1>Site</h1></header><main role=main>{body}<aside>see also</aside>"
            f"<section class='newsletter-signup'><p>subscribe</p></section></main><footer>end</footer>")


@pytest.mark.parametrize("site", [plain_site, div_site, unnamed_site, main_site])
def test_sites_of_one_template(spark, site):
    rng = random.Random(9)
    texts = {i: article(rng) for i in range(12)}
    pages = spark.createDataFrame([(i, f"http://{site.__name__}/{i}", site(b, rng)) for i, b in texts.items()], PAGES)
    got = {r.page_id: r for r in op.main_texts(pages).collect()}
    assert {i: r.text for i, r in got.items()} == {i: "\n".join(b) for i, b in texts.items()}
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_documents_of_the_smallest_set(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in op.main_texts(pages).collect()}
    for r in pages.collect():
        inner = re.sub(r"</?b>|<br>", " ", re.search(r"<article>(.*?)</article>", r.html, re.S)[1])
        blocks = (re.sub(r"\s+", " ", html.unescape(b)).strip() for b in re.split(r"<[^>]*>", inner))
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("page,text", [
    ("", ""), ("just text", "just text"), ("<p>a<p>b", "a\nb"), ("a < b &amp; c&nbsp;d", "a < b & c d"), ("<p>x<br>y</p>", "x y"),
    ("<article><header><h1>Head</h1><p>by me</p></header><p>x</p></article>", "Head\nx"), ("<article><p>a</article", "a"),
    ("<div><nav>n</nav><p>one <b>two</b>three</p></div>", "one twothree"), ("<!-- <p>no</p> --><p>yes</p>", "yes"),
    ("<article><p>t</p><![CDATA[ x ]]><script>a<b</script><p title='a>b'>u</p></article>", "t\nu"),
    ("<article><ul><li>1<li>2</ul></article><div hidden>h</div>", "1\n2"), ("<p>" + "long " * 30_000 + "</p>", ("long " * 30_000).strip()),
    ("<article></article>", ""), ("</p></div>x", "x"), ("<article><p>&#233;&eacute;&bogus; &copy</p></article>", "éé&bogus; ©"),
])
def test_single_pages(page, text):
    assert op.extract(page, None) == text


def test_classes_of_equal_occurrence_and_nesting(spark):
    both = "<body><div id=a><p>x</p></div><div id=b>y</div></body>"
    pages = spark.createDataFrame([(i, "h", both if i % 2 else "<body><div id=a>x</div></body>") for i in range(4)],
                                  "page long, host string, html string")
    classes = op.templates(pages).first().classes
    assert [(c.pages, [r.role for r in c.roles]) for c in classes] == [
        (4, ["body", "body/div.a"]), (2, ["body/div.a/p", "body/div.b"])]
    assert [s[0] for s in op.nested([c.asDict(True) for c in classes])] == ["body", "body/div.a", "body/div.a/p", "body/div.b"]
    assert [s[0] for s in op.nested([{"roles": [dict(role="body", main=0, text=1, link=0)]},
                                     {"roles": [dict(role="div", main=0, text=1, link=0)]}])] == ["body"]


@pytest.mark.parametrize("page", [
    "<div class='page has-sidebar'><article><p>one</p></article></div>",
    "<div class='layout with-comments'><article><p>one</p></article></div>",
    "<form id=aspnetForm><div><article><p>one</p></article></div></form>",
    "<section class='text-notice'><article><p>one</p></article></section>",
    "<form id=aspnetForm><div id=top-menu>m</div><div class=content><p>one</p></div></form>".replace("<div id=top-menu>m</div>", ""),
    "<div class=sidebar><p>one</p></div>", "<nav><p>one</p></nav>", "<article><p>one</p><div class=comments><article>hi</article></div></article>",
    "<article><p>one</p></article><div id=comments-area><article>a first word</article><article>more</article></div>",
    "<article><p>one</p><div class='cookie-notice'>c</div><div class='top-menu item'>m</div></article><aside><article>other texts</article></aside>",
])
def test_wrappers_do_not_lose_the_article(page):
    assert op.extract(f"<html><body>{page}</body></html>", None) == "one"


def test_names_that_only_sound_like_parts_to_leave_out():
    page = "<article><div class=share-price><p>up</p></div><div class=social-policy><p>new law</p></div><div class='social-links'>x</div></article>"
    assert op.extract(page, None) == "up\nnew law"


def notice_site(i, words, notice="We use words."):
    return f"<body><article><h2>Part one</h2><p>{words}</p><div class=c7>{notice}</div></article></body>"


def test_texts_of_the_template_go(spark):
    rng = random.Random(3)
    texts = {i: " ".join(rng.choice(WORDS[:4]) + str(i) for _ in range(9)) for i in range(6)}
    rows = [(i, f"http://n/{i}", notice_site(i, t)) for i, t in texts.items()]
    # A host of copies: its article repeats, it is no template. The same notice on two of a host's pages is none either.
    rows += [(10 + i, "http://copies/", notice_site(0, "the same words all over")) for i in range(5)]
    rows += [(20 + i, f"http://two/{i}", notice_site(i, texts[i])) for i in range(2)]
    got = {r.page_id: r.text for r in op.main_texts(spark.createDataFrame(rows, PAGES)).collect()}
    assert [got[i] for i in texts] == [f"Part one\n{t}" for t in texts.values()]
    assert {got[10 + i] for i in range(5)} == {"Part one\nthe same words all over\nWe use words."}
    assert [got[20 + i] for i in range(2)] == [f"Part one\n{texts[i]}\nWe use words." for i in range(2)]


def test_repeated_rows_and_null_ids_leave_the_vectors_right(spark):
    one, two = "<body><div id=a>x</div></body>", "<body><div id=b>y</div></body>"
    for ids in ([1, 1, 2, 2], [None] * 4):
        pages = spark.createDataFrame([(i, "http://h/", p) for i, p in zip(ids, [one, one, two, two])], PAGES)
        assert sorted(r.text for r in op.main_texts(pages).collect()) == ["x", "x", "y", "y"]
    rows = spark.createDataFrame([(0, "h", one), (1, "h", one + " "), (2, "h", two), (3, "h", two + " ")], "page long, host string, html string")
    classes = op.templates(rows, least_pages=2).first().classes
    assert sorted(r.role for c in classes for r in c.roles) == ["body", "body/div.a", "body/div.b"] and len(classes) == 3


def test_long_names_are_told_apart():
    a, b = (op.roles_of(f"<div class='{'x' * 90}{c}'><p>t</p></div>")[0][0] for c in "ab")
    assert a != b and len(a) < 100


def brute_classes(pages):
    """Roles by their whole occurrence vectors, and text blocks by those over distinct pages."""
    vectors = {}
    for i, page in enumerate(pages):
        for r, n, _, out, _, _ in op.roles_of(page):
            vectors.setdefault(r, {})[i] = n, out
    classes, texts = {}, {}
    for name, v in vectors.items():
        if all(x == (1, 0) for x in v.values()) and len(v) >= 0.5 * len(pages):
            classes.setdefault(tuple(sorted(v)), set()).add(name)
    distinct = set(pages)
    for page in distinct:
        for b, n in op.blocks_of(page).items():
            texts.setdefault(b, []).append(n)
    blocks = {b for b, n in texts.items() if max(n) == 1 and len(n) >= max(op.LEAST_PAGES, 0.5 * len(distinct))}
    return sorted((len(v), sorted(names)) for v, names in classes.items()), blocks


def test_classes_against_brute_force(spark):
    rng = random.Random(5)
    bits = ["<div id=a>x</div>", "<div id=b><p>y</p></div>", "<p>same</p>", "<section class=s><p>z</p></section>", "<nav>n</nav>", "<p>{}</p>"]
    hosts = {}
    for host in range(12):
        for i in range(rng.randrange(1, 9)):
            page = "<body>" + "".join(rng.choice(bits).format(i) for _ in range(rng.randrange(6))) + "</body>"
            hosts.setdefault(f"h{host}", []).extend([page] * rng.choice([1, 1, 2]))
    rows = [(n, h, p) for n, (h, p) in enumerate((h, p) for h, ps in hosts.items() for p in ps)]
    found = {r.host: r for r in op.templates(spark.createDataFrame(rows, "page long, host string, html string")).collect()}
    for host, pages in hosts.items():
        classes, blocks = brute_classes(pages)
        assert sorted((c.pages, sorted(r.role for r in c.roles)) for c in found[host].classes) == classes
        assert set(found[host].blocks) == blocks


def test_nulls_repeated_pages_and_extra_columns(spark):
    page = plain_site(["one", "two"], random.Random(1))
    rows = [(1, None, page), (1, None, page), (None, "http://a/", page), (2, "http://a/", None), (3, "http://a/", ""), (4, "x", " ")]
    pages = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit(1) for c in ("page", "host", "slot", "text", "role", "n")})
    got = sorted(((r.page_id, r.text) for r in op.main_texts(pages).collect()), key=repr)
    assert got == sorted([(1, "one\ntwo"), (1, "one\ntwo"), (None, "one\ntwo"), (2, ""), (3, ""), (4, "")], key=repr)
    assert op.main_texts(spark.createDataFrame([], PAGES)).count() == 0
