"""Main text of web pages by equivalence classes of template tokens.

A page is read as start tags, end tags and texts. A tag's role is the path of open tags down to it, each with its class or
id; a text's role is its tag's, with the text. Over all pages of a host, tokens with the same occurrence vector (how
often they occur in each page) form an equivalence class. A vector is never built: it is summed up as a hash over (page row,
count), so counting is a plain aggregation. Page rows are numbered, so null and repeated ids are no matter. Classes whose roles occur on at least ``SUPPORT`` of a host's pages and once on each of these are valid: they are nested into a
template by their paths, one inside the other, and what lies between them are slots. Of these slots the one with the main
text is chosen per host: by what its tag and its class or id say it is, else by its share of the text.

On each page the slot's text is extracted: menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
comments are left out by the roles inside and around it. So are texts that belong to the template: blocks, no headings, that
stand in one place, once a page, on ``SUPPORT`` of the host's distinct pages and on ``LEAST_PAGES`` of them at least, unless
they are most of a page's slot: then it is the article that repeats. A page that lacks its host's slot, and a page of a host
without one, falls back to the best slot of its own, and to its whole body without those parts.

Names leave out text if a class, id or role is one of ``_OUT_WORDS``, or ends in one before words of layout (``cookie-notice``,
``comments-area``); ``has-sidebar`` and ``share-price`` do not. An article or main tag inside a part that only its name or a
form leaves out is taken up again. A page that would have no text is read once more with names and forms disregarded, and
then with nothing left out but what is never shown.

The text of a block has character references decoded and white space folded; blocks are joined by a line break.

Defined cases: a null or empty page has an empty text. Pages without a host are one host. Unclosed and crossing tags end with
the nearest open tag around them. Rows may repeat: they keep the classes of roles as they are, and texts count over distinct
pages.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .common import small_batches, text_or_empty
from .line_dedup import host_of

#: Share of a host's pages on which a class must occur to be part of its template.
SUPPORT = 0.5
#: Distinct pages that must share a text before it can be part of their template.
LEAST_PAGES = 3
#: Share of the text that a slot without a telling name needs, and of its links at most.
TEXT_SHARE, LINK_SHARE = 0.5, 0.5
#: A longer class or id is told apart by a hash of the whole.
LONGEST_NAME = 80
#: The outer steps of a longer role are replaced by their hash, so that a role is of bounded size.
LONGEST_ROLE = 400

# Kinds of tags.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template svg iframe object textarea select math canvas".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split())
_OUT_TAGS = frozenset("nav header footer aside form button label menu dialog title head input datalist".split()) | _RAW
_CLOSES = {  # a start tag ends these open ones
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
_INSIDE = {  # and never beyond these
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"},
    "option": {"select"},
}
_CLOSES_P = _BLOCK - {"html", "head", "body", "title", "option", "optgroup", "tr", "td", "th", "tbody", "thead", "tfoot", "caption"}
_FORMATTING = frozenset("a b big code em font i s small span strike strong sub sup tt u".split())
# Words of class, id and role attributes.
_OUT_WORDS = frozenset(
    "ad ads advert advertisement adverts adsense banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar aside footer header masthead topbar cookie cookies consent gdpr notice notices popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations comment comments "
    "commentlist disqus respond replies reply widget toolbar pagination pager search searchform copyright legal disclaimer "
    "contentinfo complementary alert alertdialog dialog".split())
#: Words of layout, which say nothing about what is inside, and beginnings that speak of the page around.
_LAYOUT_WORDS = frozenset(
    "area section container wrapper wrap list box block inner outer bar slot item items link links unit panel region holder "
    "col column row group module left right top bottom".split())
_ABOUT_WORDS = frozenset("has with without no hide show is".split())
_MAIN_WORDS = frozenset(
    "article articlebody content main maincontent post postcontent entry entrycontent story storybody body text".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|$)""", re.I)
_SPACE = re.compile(r"[\s\x1c-\x1f]+")
_WORD = re.compile(r"[a-z]+")
_HEADING = re.compile(r"(?:^|/)h[1-6](?:[./]|$)")


class Open(NamedTuple):
    """An open tag: its kind, its role, and whether it or a tag around it leaves out the text."""

    tag: str
    out: bool
    main: int
    role: str
    dead: bool
    linked: bool
    #: Left out for good, or inside a living article or main tag: nothing inside is taken up again.
    settled: bool


#: What a tag with its attributes is, as far as it has been looked up.
_KINDS: dict[tuple[str, str, int], tuple[str, bool, int, bool]] = {}
_KEPT_KINDS = 20_000


def _leaves_out(name: str) -> bool:
    parts = _WORD.findall(name)
    while len(parts) > 1 and parts[-1] in _LAYOUT_WORDS:
        parts.pop()
    return bool(parts) and parts[-1] in _OUT_WORDS and not (len(parts) > 1 and parts[0] in _ABOUT_WORDS)


def _kind(tag: str, attributes: str, level: int) -> tuple[str, bool, int, bool]:
    """Step in the role, whether the tag leaves out its text, how much it names main text, and whether it does so for good."""
    known = _KINDS.get((tag, attributes, level))
    if known is not None:
        return known
    names, hidden, kind = [], False, ""
    for name, value in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), value.strip("\"'")
        if name == "role":
            kind = value.lower()
        elif name == "hidden" or name == "aria-hidden":
            hidden |= name == "hidden" or value.lower() == "true"
        elif value:
            names.append(value.lower())
    tokens = " ".join([*names, kind]).split()
    joined = {"".join(_WORD.findall(n)) for n in " ".join(names).split()}
    by_name = tag not in ("html", "body", "article", "main") and any(map(_leaves_out, tokens))
    for_good = tag in _RAW or tag in ("title", "head", "datalist") or level < 2 and (hidden or tag in _OUT_TAGS and tag != "form")
    out = for_good or level < 1 and (tag == "form" or by_name)
    main = 3 if tag == "article" else 2 if tag == "main" or kind in ("main", "article") else 1 if joined & _MAIN_WORDS and not out else 0
    label = _SPACE.sub(".", " ".join(names).strip())
    if len(label) > LONGEST_NAME:
        label = f"{label[:LONGEST_NAME]}~{crc32(label.encode('utf-8', 'replace')):08x}"
    if len(_KINDS) >= _KEPT_KINDS:
        _KINDS.clear()
    found = _KINDS[tag, attributes, level] = f"{tag}.{label}" if label else tag, out, main, for_good
    return found


def _events(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("open", tag, attributes) and ("close", tag, "") in page order."""
    at, size = 0, len(page)
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            yield "text", page[at:], ""
            return
        if mark > at:
            yield "text", page[at:mark], ""
        found = _TOKEN.match(page, mark) or _LOOSE.match(page, mark)
        if found is None:
            if page[mark + 1:mark + 2].isalpha() or page[mark + 1:mark + 3][:1] == "/" and page[mark + 2:mark + 3].isalpha():
                return  # a tag that the page's end cuts off
            yield "text", "<", ""
            at = mark + 1
            continue
        at = found.end()
        if found[0].startswith("<![CDATA["):
            continue
        if not found.lastindex:
            continue
        tag = found[2].lower()
        if found[1]:
            yield "close", tag, ""
            continue
        yield "open", tag, found[3]
        if tag in _RAW and not found[3].endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = size if end is None else end.end()
            yield "close", tag, ""


def walk(page: str, level: int = 0) -> Iterator[tuple[str, list[Open], str]]:
    """("open" | "break" | "text", open tags, text); the list is the walker's own and changes.

    Level 1 disregards names and forms, level 2 all that may be shown.
    """
    stack: list[Open] = []
    for kind, what, attributes in _events(page):
        if kind == "text":
            yield "text", stack, what
        elif kind == "open":
            if what in _CLOSES_P:
                _close(stack, {"p"}, {"button", "table", "td", "th", "li", "div", "article", "section"})
            if what in _CLOSES:
                _close(stack, _CLOSES[what], _INSIDE[what])
            if what in _BLOCK:
                while stack and stack[-1].tag in _FORMATTING and what not in ("body", "html", "head"):
                    stack.pop()  # left open before a block
                yield "break", stack, ""
            step, out, main, for_good = _kind(what, attributes, level)
            if not stack:
                stack.append(Open(what, out, main, step, out, what == "a", for_good or main > 1))
            else:
                top = stack[-1]
                role = f"{top.role}/{step}"
                if len(role) > LONGEST_ROLE:
                    role = f"{crc32(top.role.encode('utf-8', 'replace')):08x}/{step}"
                again = main > 1 and not out and top.dead and not top.settled
                dead = out or top.dead and not again
                stack.append(Open(what, out, 1 if again else main, role, dead, top.linked or what == "a",
                                  top.settled or for_good or main > 1 and not dead))
            yield "open", stack, ""
            if what in _VOID or attributes.endswith("/") and what not in _BLOCK:
                stack.pop()
                if what in ("br", "hr"):
                    yield ("break" if what == "hr" else "text"), stack, "\n"
        else:
            if what in _BLOCK:
                yield "break", stack, ""
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == what:
                    del stack[i:]
                    break
                if what in _FORMATTING and stack[i].tag in _BLOCK:
                    break


def _close(stack: list[Open], tags: set[str], limit: set[str]) -> None:
    for i in range(len(stack) - 1, -1, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in limit:
            return


def roles_of(page: str, level: int = 0) -> list[tuple[str, int, int, int, int, int]]:
    """(role, count, main, out, text length, link length) of a page's block tags; lengths are those of the text inside."""
    counts: Counter = Counter()
    facts: dict[str, tuple[int, int]] = {}
    texts: Counter = Counter()
    links: Counter = Counter()
    for kind, stack, text in walk(page, level):
        if kind == "open":
            top = stack[-1]
            if top.tag in _BLOCK:
                counts[top.role] += 1
                facts[top.role] = top.main, int(top.dead)
        elif kind == "text" and stack and not stack[-1].dead and (size := len(text.strip())):
            linked = stack[-1].linked
            for o in stack:
                if o.tag in _BLOCK:
                    texts[o.role] += size
                    if linked:
                        links[o.role] += size
    return [(r, n, *facts[r], texts[r], links[r]) for r, n in counts.items()]


def _folded(parts: list[str]) -> str:
    return _SPACE.sub(" ", entities.unescape("".join(parts))).strip(" ")


def _token(role: str, text: str) -> int:
    """Number of a text block in its place, as a signed 64-bit hash."""
    return int.from_bytes(blake2b(f"{role}\n{text}".encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def blocks_of(page: str) -> Counter:
    """How often each text block stands in its place on a page; headings are no template."""
    found: Counter = Counter()
    block: list[str] = []
    place = ""

    def end() -> None:
        text = _folded(block)
        block.clear()
        if text and not _HEADING.search(place):
            found[_token(place, text)] += 1

    for kind, stack, text in walk(page):
        if kind == "break":
            end()
        elif kind == "text" and stack and not stack[-1].dead:
            if not block:
                place = _block_role(stack)
            block.append(text)
    end()
    return found


def _block_role(stack: list[Open]) -> str:
    return next((o.role for o in reversed(stack) if o.tag in _BLOCK), "")


def text_of(page: str, slot: str, template: frozenset[int] = frozenset(), level: int = 0) -> str | None:
    """Text of the slot of a page, without the parts that are no main text; None if the page has no such slot.

    Blocks of the template go as well, unless they are more than half of the text.
    """
    blocks: list[tuple[str, bool]] = []
    block: list[str] = []
    place, seen = "", False

    def end() -> None:
        text = _folded(block)
        if text:
            blocks.append((text, bool(template) and _token(place, text) in template))
        block.clear()

    inside, depth = False, 0
    for kind, stack, text in walk(page, level):
        if inside and (len(stack) < depth or stack[depth - 1].role != slot):
            end()
            inside = False
        if kind == "open":
            if not inside and stack[-1].role == slot:
                seen = inside = True
                depth = len(stack)
        elif inside:
            if kind == "break":
                end()
            elif not stack[-1].dead or _heading_in_header(stack[depth:]):
                if not block:
                    place = _block_role(stack)
                block.append(text)
    end()
    if not seen:
        return None
    mine = sum(len(t) for t, common in blocks if not common)
    all_of_it = 2 * mine < sum(len(t) for t, _ in blocks)
    return "\n".join(t for t, common in blocks if all_of_it or not common)


def _heading_in_header(inner: list[Open]) -> bool:
    """An article's own header holds its heading."""
    outs = [o for o in inner if o.out]
    return all(o.tag == "header" for o in outs) and any(o.tag in ("h1", "h2", "h3") for o in inner)


def choose(candidates: list[tuple[str, int, int, int]]) -> str | None:
    """The slot with the main text among (role, main, text length, link length)."""
    named = [c for c in candidates if c[1] and c[2]]
    if named:
        return max(named, key=lambda c: (c[1], c[2], -len(c[0]), c[0]))[0]
    most = max((c[2] for c in candidates), default=0)
    full = [c for c in candidates if c[2] and c[2] >= TEXT_SHARE * most and c[3] <= LINK_SHARE * c[2]]
    return max(full, key=lambda c: (c[0].count("/"), c[2], c[0]))[0] if full else None


def nested(classes: list[dict]) -> list[tuple[str, int, int, int]]:
    """The template's slots: the outermost class begins it, later ones add the roles that lie within it."""
    slots: dict[str, tuple[str, int, int, int]] = {}
    for found in classes:
        roles = [(r["role"], r["main"], r["text"], r["link"]) for r in found["roles"]]
        around = slots.keys() | {r[0] for r in roles}
        slots |= {r[0]: r for r in roles if not slots or _within(r[0], around)}
    return list(slots.values())


def _within(role: str, around: set[str]) -> bool:
    """Whether a tag of the template is open around a role."""
    while "/" in role:
        role = role.rpartition("/")[0]
        if role in around:
            return True
    return False


def extract(page: str, slot: str | None, template: frozenset[int] = frozenset()) -> str:
    """Main text of a page, given its host's slot and the text blocks of its template."""
    if slot is not None and (text := text_of(page, slot, template)):
        return text
    for level in range(3):
        own = choose([(r, m, t, a) for r, n, m, out, t, a in roles_of(page, level) if n == 1 and not out])
        if text := (text_of(page, own, template, level) if own is not None else None) or _rest(page, level):
            return text
    return ""


def _rest(page: str, level: int = 0) -> str:
    """All text outside the parts that are no main text."""
    blocks, block = [], []
    for kind, stack, text in walk(page, level):
        if kind == "break":
            blocks.append("".join(block))
            block = []
        elif kind == "text" and not (stack and stack[-1].dead):
            block.append(text)
    blocks.append("".join(block))
    return "\n".join(t for t in map(_folded, ([b] for b in blocks)) if t)


def _roles(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Tags by their role, and texts by the number of role and text."""
    columns = ["host", "page", "role", "block", "content", "n", "main", "out", "text", "link"]
    for frame in frames:
        rows = []
        for host, page, html in zip(frame["host"], frame["page"], frame["html"]):
            content = _token("", html)
            rows.append((host, page, "", 0, content, 1, 0, 1, 0, 0))  # the page itself
            rows += [(host, page, r, 0, 0, *rest) for r, *rest in roles_of(html)]
            rows += [(host, page, "", block, content, n, 0, 0, 0, 0) for block, n in blocks_of(html).items() if block]
        yield pd.DataFrame(rows, columns=columns)


def templates(pages: DataFrame, support: float = SUPPORT, least_pages: int = LEAST_PAGES) -> DataFrame:
    """One row per host: host, its valid classes, most frequent first: (pages, roles: (role, main, text, link)), and blocks:
    the numbers of the texts that are part of the template.

    ``pages`` has host, page (a number of its own for each row) and html.
    """
    small_batches(pages.sparkSession)
    found = pages.select("host", "page", "html").mapInPandas(
        _roles, "host string, page bigint, role string, block bigint, content bigint, n bigint, main int, out int, text bigint, link bigint")
    # One row per role, and per text and content of a page.
    tokens = materialize(found.groupBy("host", "role", "block", "content").agg(
        F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.count("*").alias("pages"), F.max("n").alias("most"),
        F.max("main").alias("main"), F.max("out").alias("out"), F.sum("text").alias("text"), F.sum("link").alias("link")), "page-tokens")
    page_rows = tokens.where("role = '' AND block = 0").groupBy("host").agg(F.sum("pages").alias("all"), F.count("*").alias("contents"))
    sizes = page_rows.withColumnRenamed("host", "of")
    here = F.col("host").eqNullSafe(F.col("of"))  # null is a host as any other
    # A token of other pages than half of the host's, or more than one a page, is in no valid class; so classes are bounded.
    often = tokens.where("role <> '' AND most = 1 AND out = 0").join(sizes, here).where(F.col("pages") >= F.lit(support) * F.col("all"))
    texts = tokens.where("block <> 0").groupBy("host", "block").agg(F.count("*").alias("pages"), F.max("most").alias("most"))
    common = texts.where((F.col("most") == 1) & (F.col("pages") >= least_pages)).join(sizes, here).where(
        F.col("pages") >= F.lit(support) * F.col("contents"))
    classes = often.groupBy("host", "vector", "pages").agg(
        F.sort_array(F.collect_list(F.struct("role", "main", "text", "link"))).alias("roles"))
    blocks = common.groupBy("host").agg(F.sort_array(F.collect_list("block")).alias("blocks"))
    hosts = classes.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("pages", "roles")), asc=False).alias("classes"))
    return hosts.join(blocks.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of")), "left").select(
        "host", "classes", F.coalesce("blocks", F.array().cast("array<bigint>")).alias("blocks"))


def main_texts(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", support: float = SUPPORT,
               least_pages: int = LEAST_PAGES) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(key).alias("page"), F.col(url).alias("url"), host_of(url).alias("host"),
                        text_or_empty(html).alias("html"))

    @F.pandas_udf("string")
    def slot_of(classes: pd.Series) -> pd.Series:
        return pd.Series([choose(nested(host)) for host in classes], dtype=object)

    @F.pandas_udf("string")
    def text(page: pd.Series, slot: pd.Series, blocks: pd.Series) -> pd.Series:
        none: frozenset[int] = frozenset()
        return pd.Series([extract(p, s, none if b is None else frozenset(b.tolist())) for p, s, b in zip(page, slot, blocks)], dtype=object)

    hosts = templates(rows.select("host", "html", F.monotonically_increasing_id().alias("page")), support, least_pages)
    # Written first: a small table is then known to be small, and the pages need no shuffle.
    slots = materialize(hosts.select("host", slot_of("classes").alias("slot"), "blocks"), "slots")
    taken = rows.join(slots, "host", "left").select("page", "url", text.asNondeterministic()("html", "slot", "blocks").alias("text"))
    return taken.select(F.col("page").alias("page_id"), "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
