from collections import Counter

import pytest
from pyspark.sql import functions as F

from compare import normal
from riskspark.llm import line_dedup as op

PAGES = "page_id long, url string, html string"


def text_rows(df):
    return {r.page_id: (r.n_lines, r.n_dropped, r.text) for r in df.collect()}


def test_lines_of_markup(spark):
    html = ("<html><script>var a='<p>no</p>'</script><style>p{}</style><!-- <p>no -->\n<p>One  <b>two</b>\n three<br/>four &amp; "
            "&lt;b&gt;<div class='x'> <a href='#'>Menu</a></div>tail <5 <script>open")
    pages = spark.createDataFrame([(html,), (None,), ("",), ("plain\ttext",)], "html string")
    got = [r[0] for r in pages.select(op.lines_of("html")).collect()]
    assert got == [["One two three", "four & <b>", "Menu", "tail <5"], [], [], ["plain text"]]


def test_hosts(spark):
    urls = ["http://A.example.org/x", "https://u:p@b.example:80/?q#f", "mailto:x", None, "//c", "ftp://d?x"]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in pages.select(op.host_of("url")).collect()] == ["a.example.org", "b.example", "", "", "", "d"]


def test_frequency_is_relative_to_the_site(spark):
    page = lambda *lines: "".join(f"<p>{x}</p>" for x in lines)
    rows = [(i, f"http://a/{i}", page("Menu", f"own {i}", "Menu", *(["half"] if i % 2 else []))) for i in range(10)]
    rows += [(100 + i, f"http://b/{i}", page(f"own {i}", *(["Menu"] if i < 5 else []))) for i in range(40)]
    rows += [(200 + i, "http://small/", page("Menu", f"own {i}")) for i in range(4)]
    rows += [(210 + i, "http://pair/", page("Menu", f"own {i}")) for i in range(2)] + [(220, "http://one/", page("Menu", "Menu"))]
    rows += [(230 + i, "http://ten/", page(*(["Menu"] if i < 4 else []), *(["few"] if i < 2 else []))) for i in range(10)]
    rows += [(300 + i, None, page("Menu")) for i in range(9)] + [(400, "http://a/", None), (401, "http://a/", "")]
    rows += [(500, "http://c/", page("same"))] * 5
    docs = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit(1) for c in ("host", "lines", "line", "n", "dropped")})
    got = text_rows(op.drop_boilerplate(docs))
    assert got[1] == (4, 3, "own 1") and got[2] == (3, 2, "own 2")
    assert got[100] == (2, 0, "own 0\nMenu") and got[200] == (2, 1, "own 0") and got[300] == (1, 0, "Menu")
    assert got[210] == (2, 1, "own 0") and got[220] == (2, 0, "Menu\nMenu")
    assert got[230] == (2, 1, "few") and got[232] == (1, 1, "")  # 4 of 10 pages are over the ratio, 2 of 10 are not
    assert got[400] == got[401] == (0, 0, "") and got[500] == (1, 1, "")
    assert Counter(r.page_id for r in op.drop_boilerplate(docs).collect())[500] == 5


@pytest.mark.parametrize("ratio,salt_pages", [(op.RATIO, op.SALT_PAGES), (0.05, 3)])
def test_against_sql(spark, ratio, salt_pages):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW pages AS SELECT * FROM '/root/testdata/sf0.001/pages.parquet'")
    cur = con.execute(op.sql(ratio))
    want = normal([d[0] for d in cur.description], cur.fetchall())
    df = op.drop_boilerplate(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"), ratio=ratio, salt_pages=salt_pages)
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == want


def test_no_python_in_the_plan(spark):
    df = op.drop_boilerplate(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_empty_table(spark):
    assert op.drop_boilerplate(spark.createDataFrame([], PAGES)).count() == 0
