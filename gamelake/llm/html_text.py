"""Main text of web pages (operator 12) by the distribution of text over line blocks.

A page is stripped to lines: block-level tags end a line, borders of page
regions leave blank lines, and menus, footers, adverts, forms, comments and
the like are stripped with the markup. A block is the text length of a
sliding window of lines. The text surges where a block first holds enough
and dives where the blocks fall to zero. The heaviest such stretch names the
region that is the article (its ``article`` or ``main`` element, else the
container it stands in), and the stretches of that region are kept whole.

One pass over each page inside Arrow map tasks; no shuffle.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gamelake.llm.tables import small_batches

#: Lines of a block.
WINDOW = 3
#: Characters of a block at which text surges (half the page's highest block, if that is less).
SURGE = 80

MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup; none of it is text of the page.
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
#: Elements that are never article text.
STRIPPED = frozenset("nav footer aside form button select dialog menu noscript template svg object canvas audio video head".split())
REGIONS = frozenset("article main".split())
CONTAINERS = frozenset("body div".split())
LINES = frozenset("""address blockquote caption center dd details dir dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hgroup
    hr html legend li ol p pre section summary table tbody td tfoot th thead tr ul br""".split())
#: An opening tag ends the open element of its row here, up to the next container.
ENDS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPE = REGIONS | CONTAINERS | STRIPPED | frozenset("ul ol dl table blockquote section".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words in class names and ids of parts that are not the article.
PARTS = frozenset("""ad ads adbox adslot adunit adsbygoogle promo promotion banner nav navigation menu footer masthead consent gdpr notice
    notices notification popup modal overlay subscribe subscription signup login respond disqus share sharing social related
    recommended widget toolbar pagination pager search skip""".split())
#: Beginnings of such words.
PART_STEMS = ("advert", "sponsor", "navbar", "breadcrumb", "sidebar", "cookie", "newsletter", "comment")
#: With one of these, a class says something about the page, not about the element.
ABOUT = frozenset("has with no without open closed enabled disabled".split())
HEADER = frozenset("header topbar".split())


def _words(value: str) -> Iterator[str]:
    for name in re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower().split():
        words = re.split(r"[^a-z]+", name)
        if not ABOUT.intersection(words):
            yield from words


def _stripped(tag: str, attrs: str, in_article: bool) -> bool:
    """Whether an element of the page is no article text, by its name, role, class and id."""
    if tag in STRIPPED or (tag == "header" and not in_article):
        return True
    if "=" not in attrs and "hidden" not in attrs or tag in ("html", "body", "main"):
        return False
    for m in ATTRIBUTE.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value, re.I) or name == "role" and value.lower() in ROLES:
            return True
        if name in ("class", "id"):
            words = set(_words(value))
            if tag == "article":
                if any(w in ("ad", "teaser", "related") or w.startswith(("advert", "comment")) for w in words):
                    return True
            elif words & PARTS or any(w.startswith(PART_STEMS) for w in words) or (not in_article and words & HEADER):
                return True
    return False


class Line:
    """A line of the stripped page: its text, how much of it is link text, and the containers it stands in (outermost first)."""

    __slots__ = ("text", "size", "links", "path")

    def __init__(self, text: str, links: int, path: tuple):
        self.text, self.links, self.path = text, links, path
        self.size = len(text)


def stripped_lines(page: str) -> list[Line | None]:
    """The page's lines; None for a blank line at a border. A container is (number, is region) in ``path``."""
    lines: list[Line | None] = []
    part: list[str] = []
    links = number = dropped = in_link = in_region = 0
    path: tuple = ()
    stack: list[tuple[str, bool]] = []
    open_tags: Counter = Counter()

    def end_line(blank: int = 0) -> None:
        nonlocal links
        text = " ".join("".join(part).split())
        part.clear()
        if text:
            lines.append(Line(text, links, path))
        links = 0
        lines.extend([None] * blank)

    def border(tag: str) -> int:
        return WINDOW if tag in REGIONS else 2 if tag in CONTAINERS else 0

    def leave(size: int) -> None:
        nonlocal dropped, in_link, in_region, path
        while len(stack) > size:
            tag, cut = stack.pop()
            open_tags[tag] -= 1
            if tag != "a":
                end_line()
            dropped -= cut
            if tag in REGIONS:
                in_region -= 1
            if border(tag):
                path, in_link = path[:-1], 0
                end_line(border(tag))

    def close_to(tags, scope) -> None:
        """Leave the innermost open element of ``tags``, unless one of ``scope`` stands above it."""
        if not any(open_tags[t] for t in tags):
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                leave(i)
                return
            if stack[i][0] in scope:
                return

    at = 0
    while at < len(page):
        found = MARKUP.search(page, at)
        stop = found.start() if found else len(page)
        if stop > at and not dropped:
            text = html.unescape(page[at:stop])
            part.append(text)
            if in_link:
                links += len(text.strip())
        if not found:
            break
        at = found.end()
        if not found["name"]:
            continue
        tag = found["name"].lower()
        if found["close"]:
            if tag == "a":
                in_link = 0
            elif tag == "br":
                end_line()
            elif tag == "p" and not open_tags["p"]:
                end_line()
            else:
                close_to((tag,), () if tag in SCOPE else SCOPE)
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
            continue
        if tag == "a":
            in_link = "href" in found["attrs"].lower()
            continue
        block = tag in LINES or tag in CONTAINERS or tag in REGIONS or tag in STRIPPED
        if block:
            if tag != "br":
                close_to(("p",), SCOPE)
            end_line()
            if tag in ENDS:
                close_to(ENDS[tag], SCOPE - {"li"})
        if tag in VOID:
            continue
        cut = not dropped and _stripped(tag, found["attrs"], in_region > 0) or bool(dropped)
        if block or cut:
            if border(tag):
                end_line(border(tag))
                number += 1
                path += ((number, tag if tag in REGIONS else ""),)
            in_region += tag in REGIONS
            dropped += cut
            stack.append((tag, cut))
            open_tags[tag] += 1
    end_line()
    return lines


def stretches(lines: list[Line | None]) -> list[tuple[int, int, int, int]]:
    """(first line, end, weight, highest block) of every stretch from a surge to the next dive.

    Link text weighs nothing outside ``article`` and ``main``.
    """
    sizes = [0 if x is None else x.size if any(kind for _, kind in x.path) else max(x.size - x.links, 0) for x in lines]
    blocks = [sum(sizes[i: i + WINDOW]) for i in range(len(sizes))]
    enough = min(SURGE, (max(blocks, default=0) + 1) // 2)
    out, i = [], 0
    while i < len(sizes):
        if not sizes[i]:
            i += 1
            continue
        end = i
        while end < len(sizes) and blocks[end]:  # the dive
            end += 1
        highest = max(blocks[i:end])
        if highest >= enough:
            out.append((i, end, sum(sizes[i:end]), highest))
        i = end
    return out


def article_text(page: str | None) -> str:
    """The main text of one page, its lines joined by one space; empty if there is none."""
    lines = stripped_lines(page or "")
    found = stretches(lines)
    if not found:
        return ""
    regions: Counter = Counter()
    for first, end, weight, _ in found:
        inside = [c for c in lines[first].path if c[1] == "article"] or [c for c in lines[first].path if c[1]]
        if inside:
            regions[inside[-1]] += weight
    if regions:  # the whole region, also what does not surge there
        home = max(regions, key=lambda c: (regions[c], -c[0]))
        return " ".join(x.text for x in lines if x is not None and home in x.path)
    main = max(found, key=lambda s: (s[2], -s[0]))
    top = lines[main[0]].path

    def strong(stretch, home) -> bool:
        path = lines[stretch[0]].path
        return path[:len(home)] == home and (len(home) > 1 or path == home or stretch[3] * 2 >= main[3])

    # Go up while the parent, below the body, holds other stretches as strong as this one.
    while len(top) > 1 and any(lines[s[0]].path[:len(top) - 1] == top[:-1] and lines[s[0]].path[:len(top)] != top and s[3] * 2 >= main[3]
                               for s in found):
        top = top[:-1]
    kept = [x.text for s in found if strong(s, top) for x in lines[s[0]: s[1]] if x is not None]
    return " ".join(kept)


def main_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without ``html_col``, with ``text`` (main text, empty if none) and ``n_chars`` (its code points).

    A null or empty page gives an empty text; pages of any length are read
    whole; every row is one page, repeated rows too; an empty table stays
    empty. Columns called ``text`` or ``n_chars`` are replaced, others pass.
    """
    keep = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    source = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html_col}`").cast("string").alias("_page"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    small_batches(pages.sparkSession, 400)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [article_text(page) for page in batch.column(len(keep)).to_pylist()]
            columns = [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "text", "n_chars"])

    return source.mapInArrow(extract, schema)
