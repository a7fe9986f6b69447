"""Line deduplication by site-relative frequency, with DataFrame functions only.

The lines of a page are the texts between its block tags and line breaks, without scripts, styles and comments, white space
folded. Pages are grouped by host; a line that repeats on the host and stands on more than ``ratio`` of its pages is
boilerplate of that host and is dropped from all its pages. The ratio decides on hosts of every size.

A page counts once for a line, so lines are made distinct inside their row before anything is shuffled, and counts are
combined before the shuffle. Lines travel as two hashes. A host has fewer boilerplate lines than ``1 / ratio`` times the
distinct lines of an average page, so they go to the pages as one array per host, which is copied once for every
``SALT_PAGES`` pages of the host: a host's pages are spread over more tasks the more there are.

Defined cases: a null or empty page has no lines and an empty text. Pages without a host in their url are no site and keep
all lines. A line on one page only does not repeat and stays, so a host of one page keeps all lines. A repeated row counts as a
page of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import text_or_empty

RATIO = 0.2
#: Pages on which a line stands if it repeats at all.
_REPEATS = 2
#: Pages of one host that meet one copy of its array.
SALT_PAGES = 1000

# Tags whose contents are no text, and tags that begin or end a line.
_SILENT = ("script", "style", "noscript", "template", "svg")
_BLOCKS = ("address article aside blockquote body br button center dd details dialog div dl dt fieldset figcaption figure "
           "footer form h1 h2 h3 h4 h5 h6 head header hr html iframe label legend li main menu nav ol option p pre section "
           "select summary table tbody td textarea tfoot th thead title tr ul").split()
# Character references that are decoded, the ampersand last.
_REFERENCES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))

# One "<" before all choices: they are only tried where it stands.
_SILENT_PATTERN = r"(?is)<(?:!--.*?(?:-->|\z)|" + "|".join(rf"{t}\b.*?(?:</{t}\s*>|\z)" for t in _SILENT) + ")"
_BLOCK_PATTERN = r"(?i)</?(?:" + "|".join(_BLOCKS) + r")(?:\s[^>]*|/)?>"
# White space that is not one blank already.
_SPACES = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#@]*@)?([^/?#:]*)"


def host_of(url: str | Column) -> Column:
    """Host of a url in lower case, empty if it has none."""
    return F.lower(F.regexp_extract(text_or_empty(url), _HOST, 2))


def lines_of(html: str | Column) -> Column:
    """The lines of a page, in order, none of them empty."""
    text = F.regexp_replace(F.regexp_replace(text_or_empty(html), _SILENT_PATTERN, " "), _SPACES, " ")
    text = F.regexp_replace(F.regexp_replace(text, _BLOCK_PATTERN, "\n"), r"<[/A-Za-z!?][^>]*>", "")
    for reference, meaning in _REFERENCES:
        text = F.replace(text, F.lit(reference), F.lit(meaning))
    text = F.regexp_replace(text, r" *\n[ \n]*", "\n")
    lines = F.split(F.regexp_replace(text, r"  +", " "), "\n")
    return F.filter(F.transform(lines, lambda line: F.trim(line)), lambda line: line != "")


def _hashes(lines: Column) -> Column:
    return F.transform(lines, lambda line: F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b")))


def boilerplate(pages: DataFrame, host: str = "host", lines: str = "lines", ratio: float = RATIO) -> DataFrame:
    """One row per host that has boilerplate: host, its number of pages, and the array of its lines' hashes."""
    sited = pages.where(F.col(host) != "")
    seen = sited.select(host, F.explode(F.array_distinct(_hashes(F.col(lines)))).alias("line"))
    counts = seen.groupBy(host, "line").agg(F.count("*").alias("n")).where(F.col("n") >= _REPEATS)
    totals = sited.groupBy(host).agg(F.count("*").alias("pages"))
    over = counts.join(totals, host).where(F.col("n") > F.lit(ratio) * F.col("pages"))
    return over.groupBy(host, "pages").agg(F.collect_list("line").alias("dropped"))


def drop_boilerplate(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", ratio: float = RATIO,
                     salt_pages: int = SALT_PAGES) -> DataFrame:
    """One row per page: page_id, url, host, n_lines, n_dropped, text (the lines that stay)."""
    # Written, as taking pages apart is most of the work and the lines are read twice.
    lined = materialize(
        pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), host_of(url).alias("host"),
                     lines_of(html).alias("lines")), "lines")
    # A host with many pages is spread over several tasks, each of which gets the host's array.
    salts = F.ceil(F.col("pages") / salt_pages)
    arrays = materialize(boilerplate(lined.select("host", "lines"), ratio=ratio), "boilerplate")
    sizes = arrays.where(F.col("pages") > salt_pages).select("host", salts.alias("salts"))
    salted = lined.join(sizes, "host", "left").withColumn(
        "salt", F.pmod(F.xxhash64("page_id", "url"), F.coalesce("salts", F.lit(1))))
    copies = arrays.select("host", "dropped", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)).alias("salt"))
    found = salted.join(copies, ["host", "salt"], "left")
    none = F.array().cast("array<struct<a: bigint, b: bigint>>")
    dropped = F.coalesce("dropped", none)
    tagged = F.arrays_zip(F.col("lines").alias("line"), _hashes(F.col("lines")).alias("hash"))
    stay = F.filter(tagged, lambda t: ~F.array_contains(dropped, t["hash"]))
    kept = found.withColumn("stay", F.transform(stay, lambda t: t["line"]))
    return kept.select("page_id", "url", "host", F.size("lines").cast("bigint").alias("n_lines"),
                       (F.size("lines") - F.size("stay")).cast("bigint").alias("n_dropped"),
                       F.array_join("stay", "\n").alias("text"))


def sql(ratio: float = RATIO) -> str:
    quoted = lambda p: p.replace("'", "''")
    text = rf"regexp_replace(regexp_replace(coalesce(html, ''), '{_SILENT_PATTERN}', ' ', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')"
    text = rf"regexp_replace(regexp_replace({text}, '{_BLOCK_PATTERN}', chr(10), 'g'), '<[/A-Za-z!?][^>]*>', '', 'g')"
    for reference, meaning in _REFERENCES:
        text = f"replace({text}, '{quoted(reference)}', '{quoted(meaning)}')"
    text = f"regexp_replace(regexp_replace({text}, ' *\\n[ \\n]*', chr(10), 'g'), '  +', ' ', 'g')"
    return rf"""WITH p AS (SELECT row_number() OVER () AS nth, page_id, url,
      lower(regexp_extract(coalesce(url, ''), '{_HOST}', 2)) AS host,
      list_filter(list_transform(string_split({text}, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS lines FROM pages),
    l AS (SELECT nth, host, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM p),
    c AS (SELECT host, line, count(DISTINCT nth) AS n FROM l WHERE host <> '' GROUP BY ALL),
    t AS (SELECT host, count(*) AS pages FROM p GROUP BY ALL),
    b AS (SELECT host, line FROM c JOIN t USING (host) WHERE n >= {_REPEATS} AND n > {ratio} * pages),
    k AS (SELECT nth, string_agg(l.line, chr(10) ORDER BY place) FILTER (b.line IS NULL) AS text,
            count(b.line) AS n_dropped FROM l LEFT JOIN b ON l.host = b.host AND l.line = b.line GROUP BY nth)
    SELECT page_id, url, host, CAST(len(lines) AS BIGINT) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
      coalesce(text, '') AS text FROM p LEFT JOIN k USING (nth)"""
