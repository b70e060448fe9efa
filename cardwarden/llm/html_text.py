"""Main text of web pages by site template removal.

Every block element of a page is hashed with all below it. Spark counts, per host, in how many different pages a
subtree recurs; subtrees that many pages of the host share are its template and are deleted, with what they hold.
A paragraph, heading or list item recurs only together with what stands before and after it, as those of a template do: a heading
that many texts have stays. Elements whose tag or role says that they are no main text go as well, and those whose class or id
says so if they hold neither a marked article nor most of the page. Where a page marks its article (article or main), only
what is inside the mark counts. Paragraphs and the like inside a marked article are never
template, however often a site repeats them: different articles may share a passage.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.common import BROADCAST_ROWS, stored

#: A subtree is template if it is in so many different pages of its host, however large the host is.
LEAST_PAGES = 4

# Names of HTML
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody"
    " tfoot thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe object svg canvas title textarea xmp noembed noframes".split())
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt blockquote pre tr figcaption caption summary address".split())
_NO_TEXT = frozenset("head nav aside footer form button select datalist dialog menu label fieldset".split()) | _RAW
_NO_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
_NO_TEXT_CLASSES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead banner ad ads advert adverts advertisement sponsor"
    " sponsored promo cookie cookies consent notice popup modal overlay newsletter subscribe signup login comment comments disqus reply"
    " replies share sharing social related recommended pagination pager widget toolbar skip".split()
)
#: Words that may stand beside one of those in a name, as in "site-header"; "has-sidebar" and "related-work" say something else
_BESIDE = frozenset(
    "a the site page global main top bottom left right primary secondary sub js wrap wrapper container inner outer box block list items item"
    " links link area bar section panel content form button buttons icon icons text body posts post articles stories thread count title heading"
    " mobile desktop sticky fixed slot unit row col column group region zone module component".split()
)
#: Start tags that end an open element of the same group
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}, "thead": {"thead", "tbody", "tfoot"}, "tbody": {"thead", "tbody", "tfoot"}, "tfoot": {"thead", "tbody", "tfoot"}}
_SCOPE = frozenset("html body article section div table ul ol dl main aside nav form blockquote td th".split())

# A quote opens a value after "=" only; elsewhere it is a character like others. A tag that isn't closed ends with the page
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>=]*+(?:=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>])?[^>=]*+)*+)(?:>|\Z)|<[!?/][^>]*>?", re.S)
_ATTRIBUTE = re.compile(r"""([a-z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|\b(hidden)\b""", re.I)


@dataclass
class Page:
    """The block elements of a page, in order of their start, and its blocks of text."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["#page"])
    silent: list[bool] = field(default_factory=lambda: [False])  # by tag or role
    named: list[bool] = field(default_factory=lambda: [False])  # by class or id
    hash: list[int] = field(default_factory=lambda: [0])
    blocks: list[tuple[int, str]] = field(default_factory=list)  # element, text


def _names_no_text(names: str, inside_article: bool) -> bool:
    """Whether one of these classes or ids is a name of something that is no main text."""
    for name in names.split():
        words = set(re.findall(r"[a-z]+", name))
        said = words & _NO_TEXT_CLASSES
        if said and words <= _NO_TEXT_CLASSES | _BESIDE and not (inside_article and said == {"header"}):
            return True
    return False


def _says_no_text(tag: str, attributes: str, inside_article: bool) -> tuple[bool, bool]:
    """Whether an element is no main text by its tag or role, and whether it is none by its class or id."""
    if tag in _NO_TEXT or tag == "header" and not inside_article:
        return True, False
    if not attributes or tag in ("html", "body", "article", "main") and "comment" not in attributes:
        return False, False
    named = False
    for name, value, hidden in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if hidden or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
            return True, False
        if name == "role" and value in _NO_TEXT_ROLES:
            return True, False
        named |= name in ("class", "id") and _names_no_text(value, inside_article)
    return False, named


def parse(source: str) -> Page:
    """The page's elements and blocks. Broken markup is read as browsers do: what isn't closed ends with its parent."""
    page = Page()
    stack: list[tuple[str, int]] = [("#page", 0)]  # tag, number of the nearest block element
    open_tags: dict[str, int] = {}
    silent_inline = 0  # open inline elements that hold no text
    content: list[list[str]] = [[]]
    text: list[str] = []
    articles = 0

    def flush() -> None:
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                page.blocks.append((stack[-1][1], joined))
            text.clear()

    def pop() -> None:
        nonlocal articles, silent_inline
        tag, number = stack.pop()
        open_tags[tag] -= 1
        if tag in _BLOCKS:
            digest = xxhash.xxh3_64_intdigest("".join(content[number]).encode("utf-8", "surrogatepass"))
            page.hash[number] = digest - (1 << 64) if digest >> 63 else digest
            content[page.parent[number]].append(f"<{digest:x}>")
            content[number] = []
            articles -= tag in ("article", "main")
        elif tag in _NO_TEXT:
            silent_inline -= 1

    def pop_to(tags: set[str] | frozenset[str]) -> None:
        """Close the innermost open element of these tags, unless a scope lies between."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                flush()
                while len(stack) > i:
                    pop()
                return
            if stack[i][0] in _SCOPE:
                return

    at = 0
    for match in _TOKEN.finditer(source):
        start, end = match.span()
        if start < at:
            continue
        if start > at:
            piece = html.unescape(source[at:start])
            content[stack[-1][1]].append(piece)
            if not silent_inline:
                text.append(piece)
        at = end
        tag = match[2]
        if not tag:
            continue
        tag = tag.lower()
        if match[1]:
            if not open_tags.get(tag):
                continue
            if tag in _BLOCKS:
                flush()
            while True:
                last = stack[-1][0]
                pop()
                if last == tag:
                    break
            continue
        if tag in _RAW and not match[3].endswith("/"):
            close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, end)
            at = close.end() if close else len(source)
            continue
        if tag in _BLOCKS:
            flush()
            if open_tags.get("p"):
                pop_to({"p"})
            if tag in _ENDS:
                pop_to(_ENDS[tag])
            number = len(page.tag)
            page.parent.append(stack[-1][1])
            page.tag.append(tag)
            silent, named = _says_no_text(tag, match[3], articles > 0)
            page.silent.append(silent_inline > 0 or silent)
            page.named.append(named)
            page.hash.append(0)
            content.append([f"{tag} "])
            if tag in _VOID:
                continue
            stack.append((tag, number))
            open_tags[tag] = open_tags.get(tag, 0) + 1
            articles += tag in ("article", "main")
        else:
            if tag in ("br", "td", "th", "img"):
                text.append(" ")
            content[stack[-1][1]].append(f"<{tag}>")
            if tag in _VOID or match[3].endswith("/"):
                continue
            stack.append((tag, stack[-1][1]))
            open_tags[tag] = open_tags.get(tag, 0) + 1
            silent_inline += tag in _NO_TEXT
    if at < len(source):
        piece = html.unescape(source[at:])
        content[stack[-1][1]].append(piece)
        if not silent_inline:
            text.append(piece)
    flush()
    while len(stack) > 1:
        pop()
    _resolve_names(page)
    return page


def _resolve_names(page: Page) -> None:
    """Silence the elements that a class or id names, but for those around a marked article or most of the text."""
    if not any(page.named):
        return
    n = len(page.tag)
    hidden, size, marked = [False] * n, [0] * n, [False] * n
    for e in range(1, n):
        hidden[e] = hidden[page.parent[e]] or page.silent[e]
        marked[e] = page.tag[e] in ("article", "main") and not hidden[e] and not page.named[e]
    for e, text in page.blocks:
        size[e] += 0 if hidden[e] else len(text)
    for e in range(n - 1, 0, -1):  # children come after their parents
        size[page.parent[e]] += size[e]
        marked[page.parent[e]] |= marked[e]
    for e in range(1, n):
        page.silent[e] |= page.named[e] and not marked[e] and (2 * size[e] <= size[0] or page.tag[e] in ("article", "main"))


def _roots(page: Page) -> tuple[list[bool], list[bool]]:
    """Whether each element is inside a marked article that isn't silent, or there is none; and inside of the closest kind of mark."""
    n = len(page.tag)
    in_article, in_main, silent = [False] * n, [False] * n, [False] * n
    for e in range(1, n):
        up = page.parent[e]
        quiet = silent[e] = silent[up] or page.silent[e]
        in_article[e] = in_article[up] or (not quiet and page.tag[e] == "article")
        in_main[e] = in_main[up] or (not quiet and page.tag[e] == "main")
    if any(in_main):
        either = [a or m for a, m in zip(in_article, in_main, strict=True)]
        return either, in_article if any(in_article) else in_main
    return (in_article if any(in_article) else [True] * n), in_article


def candidates(page: Page) -> Iterator[tuple[int, int]]:
    """(element, hash) of what may be a template: all blocks but the page's frame and the prose of a marked article.

    The hash of a prose element is taken together with those of both its neighbours.
    """
    _, article = _roots(page)
    n = len(page.tag)
    before, after, last = [0] * n, [0] * n, [0] * n  # element 0, the page, stands for none
    for e in range(1, n):
        up = page.parent[e]
        before[e], after[last[up]], last[up] = last[up], e, e
    after[0] = 0
    for e in range(1, n):
        tag = page.tag[e]
        if tag in ("html", "body", "article", "main", "hr") or (article[e] and tag in _PROSE):
            continue
        key = page.hash[e]
        if tag in _PROSE and (before[e] or after[e]):
            key = xxhash.xxh3_64_intdigest(repr((page.hash[before[e]], key, page.hash[after[e]])).encode())
            key -= (key >> 63) << 64
        yield e, key


def main_text(source: str | None, templates: frozenset[int] | set[int] = frozenset()) -> str:
    """Text blocks of a page, joined by an empty line, without those in templates (hashes of subtrees)."""
    if not source:
        return ""
    page = parse(source)
    inside, _ = _roots(page)
    gone = [False] * len(page.tag)
    template = {e for e, key in candidates(page) if key in templates} if templates else set()
    for e in range(1, len(page.tag)):
        gone[e] = gone[page.parent[e]] or page.silent[e] or e in template
    return "\n\n".join(text for e, text in page.blocks if inside[e] and not gone[e])


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, subtree, page): each candidate's hash, and a hash of what the page says."""
    for batch in batches:
        hosts, hashes, pages = [], [], []
        for host, source in zip(batch["host"].to_pylist(), batch["html"].to_pylist(), strict=True):
            if not source:
                continue
            page = parse(source)
            said = xxhash.xxh3_64_intdigest(repr([t for e, t in page.blocks if not page.silent[e]]).encode("utf-8", "surrogatepass")) >> 1
            found = {key for _, key in candidates(page)}
            hosts += [host] * len(found)
            hashes += found
            pages += [said] * len(found)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(hashes, pa.int64()), pa.array(pages, pa.int64())], ["host", "subtree", "page"])


def host(url: str = "url"):
    """The host of a URL, lower-cased, empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(url).cast("string"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def site_templates(pages: DataFrame) -> DataFrame:
    """(host, subtree): hashes of the subtrees that LEAST_PAGES different pages of the host share.

    A page is told from others by its text, so copies of one page count once. A host may have any number of templates:
    one in each row.
    """
    seen = pages.select(host().alias("host"), F.col("html").cast("string").alias("html")).mapInArrow(_subtrees, "host string, subtree long, page long")
    counted = seen.distinct().groupBy("host", "subtree").agg(F.count("*").alias("n"))
    return stored(counted.where(F.col("n") >= LEAST_PAGES).select("host", "subtree"), "templates")


def _page_subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, host, subtree): each candidate's hash."""
    for batch in batches:
        rows, hosts, hashes = [], [], []
        for row, host, source in zip(batch["row"].to_pylist(), batch["host"].to_pylist(), batch["html"].to_pylist(), strict=True):
            if source:
                page = parse(source)
                found = {key for _, key in candidates(page)}
                rows += [row] * len(found)
                hosts += [host] * len(found)
                hashes += found
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(hosts, pa.string()), pa.array(hashes, pa.int64())], ["row", "host", "subtree"])


def _own_templates(own: DataFrame, templates: DataFrame) -> DataFrame:
    """Rows of own that are templates. The number of templates has no bound, so the join is never by broadcast, which goes through the driver.

    A block of all pages of a large host gives it many narrow rows, which adaptive execution splits.
    """
    return own.join(templates.hint("merge"), ["host", "subtree"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(s, frozenset(t or ())) for s, t in zip(batch["html"].to_pylist(), batch["templates"].to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
        )


def page_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of pages, which needs page_id, url and html.

    text: the blocks of main text in page order, with an empty line between; references decoded, white space
    inside a block is one space. n_chars: its code points. A null or empty html, or one without main text, gives
    an empty text. A null url, or one without host, counts as of one site without name. Repeated rows
    come out each; other columns are ignored; an empty table gives an empty one; pages of any length are read whole.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host().alias("host"))
    templates = site_templates(pages)
    if templates.count() <= BROADCAST_ROWS:
        lists = templates.groupBy("host").agg(F.collect_list("subtree").alias("templates"))
        joined = rows.join(F.broadcast(lists), "host", "left")
    else:
        # numbers are written once: another reading may number the rows in another way
        rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "pages")
        # of the templates of a host, each page gets its own
        own = _own_templates(rows.select("row", "host", "html").mapInArrow(_page_subtrees, "row long, host string, subtree long"), templates)
        joined = rows.join(own.groupBy("row").agg(F.collect_list("subtree").alias("templates")), "row", "left")
    return joined.select("page_id", "url", "html", "templates").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
