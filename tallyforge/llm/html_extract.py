"""Main text of HTML pages by tag-path ratios.

A page is cut into blocks, the text between block-level tags. For each path of
block-level tags from the root to a block, the page's text length, punctuation
and link text are added up; divided by the path's blocks they give its text and
punctuation ratios. The ratios are smoothed along the page's blocks, fused, and
weighted by what tags and attributes on the path say of its role. Blocks whose
path reaches a share of the page's best path tell where the content is: the
elements that hold them are its containers. The main text is every block of a
container, however short it is beside the longest one: headings, list items,
cells and captions included, and a first heading that stands before the
container. Only blocks that are links and nothing else have to reach the share
themselves where no element says that it holds the article, since menus look
like that.

Classes and ids are evidence and no verdict. A name like `ad-slot` or
`comments` on an element below the container makes its blocks doubtful: their
path counts for DOUBT of its ratio and has to reach the share itself. The same
name around the whole text changes nothing: where a path is RICHER times as rich
as all others it is the text in spite of its name.
A `form` is doubtful, too, as some pages are one form. Only elements that HTML
itself sets apart (`nav`, `footer`, `aside`, such roles, hidden ones, a `header`
outside the article) are left out as such.

One page is one row, so tasks need nothing from each other and nothing is
shuffled. Work is linear in the page.

Defined results
---------------
Null or empty html: empty text. Text without any tag: one block. Unclosed tags
are closed as browsers do for paragraphs, list items and table cells; a form
control or drawing that is never closed hides nothing. A link around several
blocks that hold WRAP of the page's text is no link but the text; where links
leave no path any text of its own, they count as text. Formulas and what an
`object` or `noscript` shows in its place are text. Elements
nested deeper than DEEPEST count as parts of the one there, as in browsers, and
keep their text. A `<` that begins no tag, or a tag that never ends, is text.
Inline tags do not end a block, `br` is white space. Repeated rows give repeated
rows; an empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, namedtuple
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import ship, table

#: Weight of paths inside an element that holds the article, against 1 for others.
ARTICLE_WEIGHT = 4.0
#: Weight of a path for each element on it whose name casts doubt and that is not on the richest path; that one has to be RICHER times as rich for each.
DOUBT, RICHER = 0.02, 10.0
#: A path tells of a container from these shares of the best path's fused ratio: inside an element that holds the article, and elsewhere.
KEEP_INSIDE, KEEP_SHARE = 0.02, 0.2
#: Weights of a block and its neighbours when ratios are smoothed.
SMOOTH = (0.25, 0.5, 0.25)
#: Open elements that are told apart.
DEEPEST = 512

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img object noscript math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd semantics menclose merror mpadded mphantom mspace".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no tags, only text that is not shown; the first four hide the rest of the page if they are never closed.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
ENDLESS = frozenset("script style textarea title".split())
#: Elements that are left out with all that they hold, if they are closed.
LEFT_OUT = frozenset("select button svg canvas template datalist annotation annotation-xml".split())
#: Share of a page's text from which a link around several blocks is no link.
WRAP = 0.25
SET_APART = frozenset("nav footer aside menu dialog head".split())
SET_APART_ROLES = frozenset("navigation contentinfo complementary search menu menubar dialog alertdialog banner".split())
ARTICLE_TAGS = frozenset(("article", "main"))
#: Words that cast doubt, where a name in class or id consists of them and of NEUTRAL words only.
DOUBTED = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager sidebar aside footer masthead topbar comment comments commentlist discussion discussions talkback reactions disqus respond replies newsletter subscribe subscription signup login share sharing social related recommended widget widgets toolbar copyright".split()
)
NEUTRAL = frozenset("banner list box bar block container wrapper wrap section area slot unit item items inner outer body content text title link links button buttons form left right top bottom main header head site page global post posts entry article articles blog story user reader primary secondary group panel row column col full small large wide".split())
STORY = frozenset(("articlebody", "article", "story", "post"))
#: Start tags that close an open element of the tags named here.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Tags that are part of a text; what holds them is its container.
PIECES = frozenset("p h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd blockquote pre address figure figcaption caption table thead tbody tfoot colgroup tr td th details summary hr".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

NAME = re.compile(r"/?[A-Za-z][^\s/>]*")
#: The end of a tag, or a value in quotes, inside which no tag ends.
STOP = re.compile(r">|=\s*([\"'])")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
COMMENT_END = re.compile(r"--!?>")
SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/\s*$")
HREF = re.compile(r"(?:^|[\s\"'/])href(?=[\s=/]|$)", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。、！？¿¡]")
PAGES = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def doubtful(name: str) -> bool:
    """Whether a name of class or id says that its element is not the article: `ad-slot` does, `no-sidebar` and `search-results` do not."""
    said = [w for w in re.split(r"[^a-z]+", name) if w]
    return not DOUBTED.isdisjoint(said) and all(w in DOUBTED or w in NEUTRAL for w in said)


@lru_cache(maxsize=4096)
def role(tag: str, attributes: str) -> tuple[str, bool, bool, bool]:
    """(step of a path, whether set apart, whether it holds the article, whether its name casts doubt)."""
    values: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(attributes):
        values.setdefault(name.lower(), value.strip("\"'").lower())
    step = f"{tag}.{values['class']}" if values.get("class") else tag
    names = (values.get("class", "") + " " + values.get("id", "")).split()
    hidden = "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", "")
    apart = hidden or tag in SET_APART or not SET_APART_ROLES.isdisjoint(values.get("role", "").split())
    holds = tag in ARTICLE_TAGS or values.get("itemprop") == "articlebody" or values.get("role") in ("main", "article")
    holds = holds or (tag in ("div", "section") and any(not STORY.isdisjoint(re.split(r"[^a-z]+", n)) and not doubtful(n) for n in names))
    return step, apart, holds and not apart, tag == "form" or (tag not in ("html", "body") and any(map(doubtful, names)))


class Element:
    """An open element. `path` numbers its steps from the root, `article` is the outermost element on it that holds the article,
    `doubts` counts the elements on it whose names cast doubt."""

    __slots__ = ("up", "tag", "path", "apart", "article", "doubts", "header")

    def __init__(self, up: Element | None, tag: str, path: int, apart: bool = False, holds: bool = False, doubt: bool = False):
        self.up, self.tag, self.path = up, tag, path
        self.apart = apart or (up is not None and up.apart)
        self.article = (up.article if up else None) or (self if holds else None)
        self.doubts = doubt + (up.doubts if up else 0)
        self.header = tag == "header" or (up is not None and up.header)

    def weight(self) -> float:
        if self.apart or (self.header and not self.article):
            return 0.0
        return ARTICLE_WEIGHT if self.article else 1.0

    def container(self) -> Element:
        """The nearest element that is no piece of a text; a cell that holds other elements is one, too."""
        e = self
        while e.up and e.tag in PIECES and not (e.tag in ("td", "th") and e is not self):
            e = e.up
        return e


Block = namedtuple("Block", "element text linked plain")


def closed(source: str, tag: str) -> dict[int, int]:
    """Where each element of a tag that is closed begins and ends; of those inside each other each has its own end."""
    ends, open_ = {}, []
    for m in re.finditer(rf"<(/?){re.escape(tag)}(?=[\s/>])([^>]*)>", source, re.I):
        if not m[1] and not SELF_CLOSED.search(m[2]):
            open_.append(m.start())
        elif m[1] and open_:
            ends[open_.pop()] = m.end()
    return ends


def blocks(source: str) -> list[Block]:
    """Every block in page order: its element, text, characters in links, whether any are outside."""
    out: list[Block] = []
    stack = [Element(None, "", 0)]
    open_tags: Counter = Counter()
    paths: dict[tuple[int, str], int] = {}
    parts: list[str] = []
    anchors = link = 0  # number of links so far, the open one
    linked: Counter = Counter()  # the block's characters by link
    plain = False  # whether any of its text stands outside links
    left_out: dict[str, dict[int, int]] = {}
    over = 0  # open elements below the deepest

    def end_block() -> None:
        nonlocal plain
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(stack[-1], text, dict(linked), plain))
            parts.clear()
        linked.clear()
        plain = False

    def close(tag: str, until: tuple[str, ...] = ()) -> None:
        if open_tags[tag]:
            for at in range(len(stack) - 1, 0, -1):
                if stack[at].tag == tag:
                    end_block()
                    for e in stack[at:]:
                        open_tags[e.tag] -= 1
                    del stack[at:]
                    return
                if stack[at].tag in until:
                    return

    def write(text: str) -> None:
        nonlocal plain
        parts.append(text)
        if link:
            linked[link] += len(text)
        elif not text.isspace():
            plain = True

    at, size = 0, len(source)
    endless = False  # no later tag ends
    never: set[str] = set()  # raw elements that are not closed any more
    unquoted: set[str] = set()  # quotes that do not occur any more
    while at < size:
        begin = source.find("<", at)
        if begin < 0:
            write(source[at:])
            break
        if begin > at:
            write(source[at:begin])
        if source.startswith("<!--", begin):
            short = next((x for x in (">", "->") if source.startswith(x, begin + 4)), "")
            end = None if short else COMMENT_END.search(source, begin + 4)
            at = begin + 4 + len(short) if short else end.end() if end else size
            continue
        if source.startswith(("<!", "<?"), begin):
            end = source.find(">", begin)
            at = end + 1 if end >= 0 else size
            continue
        name = None if endless else NAME.match(source, begin + 1)
        if name is None:
            write("<")
            at = begin + 1
            continue
        end = name.end()
        while True:
            stop = STOP.search(source, end)
            if stop is None or stop.group() == ">":
                break
            end, quote = stop.end(), stop.group(1)
            if quote not in unquoted:
                closing_quote = source.find(quote, end)
                if closing_quote < 0:
                    unquoted.add(quote)
                else:
                    end = closing_quote + 1
        if stop is None:
            endless = True
            write("<")
            at = begin + 1
            continue
        at = stop.end()
        attributes = source[name.end() : stop.start()]
        tag = name.group().lower()
        closing = tag.startswith("/")
        tag = tag.lstrip("/")
        if tag in INLINE:
            if tag == "a":
                anchors += 1
                link = anchors if not closing and HREF.search(attributes) else 0
            elif tag == "br":
                parts.append(" ")
            continue
        if closing:
            if over and tag not in RAW and tag not in LEFT_OUT and tag not in VOID:
                over -= 1
                end_block()
            elif tag == "p" and not open_tags["p"]:
                end_block()
            else:
                close(tag)
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(source, at) if tag not in never else None
            if end:
                at = end.end()
            elif tag in ENDLESS:
                at = size
            else:
                never.add(tag)
            continue
        if tag in LEFT_OUT:
            if tag not in left_out:
                left_out[tag] = closed(source, tag)
            at = max(at, left_out[tag].get(begin, at))
            continue
        if tag in CLOSES_P:
            close("p", ("table", "button"))
        for other in CLOSES.get(tag, ()):
            close(other, ("ul", "ol", "dl", "table"))
        end_block()
        if tag not in VOID:
            if tag == "body":
                close("head")
            if len(stack) > DEEPEST:
                over += 1
                continue
            step, apart, holds, doubt = role(tag, attributes)
            path = paths.setdefault((stack[-1].path, step), len(paths) + 1)
            stack.append(Element(stack[-1], tag, path, apart, holds, doubt))
            open_tags[tag] += 1
    end_block()
    totals, spread, whole = Counter(), Counter(), sum(len(b.text) for b in out)
    for b in out:
        totals.update(b.linked)
        spread.update(b.linked.keys())
    around = {k for k, n in totals.items() if spread[k] > 1 and n > WRAP * whole}
    return [b._replace(linked=sum(n for k, n in b.linked.items() if k not in around), plain=b.plain or not around.isdisjoint(b.linked)) for b in out]


def smooth(values: list[float]) -> list[float]:
    """Weighted geometric means of neighbours, each raised by one."""
    logs = [math.log1p(v) for v in (values[0], *values, values[-1])]
    return [math.expm1(sum(w * logs[i + k] for k, w in enumerate(SMOOTH))) for i in range(len(values))]


def containers(telling: list[Element]) -> tuple[set[Element], set[int]]:
    """(elements that hold the telling blocks' elements, paths of those that say that they hold the article)."""
    articles = {e.article.path for e in telling if e.article}
    others = [(e, e.container()) for e in telling if not e.article]
    # texts that stand right in elements side by side are paragraphs of what holds these
    beside: dict[Element | None, set[Element]] = {}
    for e, c in others:
        if e is c:
            beside.setdefault(e.up, set()).add(e)
    return {c.up if c is e and c.up and len(beside[e.up]) > 1 else c for e, c in others}, articles


def ratios(found: list[Block]) -> dict[int, float]:
    """The fused ratio of every path."""
    paths = [b.element.path for b in found]
    sums: dict[int, list[float]] = {}
    for b, p in zip(found, paths):
        s = sums.setdefault(p, [0.0, 0.0, 0.0])
        s[0] += max(0, len(b.text) - b.linked)
        s[1] += len(PUNCTUATION.findall(b.text))
        s[2] += 1
    text_ratio = smooth([sums[p][0] / sums[p][2] for p in paths])
    mark_ratio = smooth([sums[p][1] / sums[p][2] for p in paths])
    fused: dict[int, list[float]] = {}
    for b, p, t, k in zip(found, paths, text_ratio, mark_ratio):
        fused.setdefault(p, []).append(b.element.weight() * t * math.log(math.e + k))
    return {p: sum(v) / len(v) for p, v in fused.items()}


def main_text(source: str | None) -> str:
    found = blocks(source or "")
    if not found:
        return ""
    ratio = ratios(found)
    if not any(ratio.values()):  # all text is links
        found = [b._replace(linked=0, plain=True) for b in found]
        ratio = ratios(found)
    paths = [b.element.path for b in found]
    doubts = {p: b.element.doubts for b, p in zip(found, paths)}
    richest = max(ratio, key=lambda p: ratio[p] * RICHER ** -doubts[p])
    score = {p: r * DOUBT ** max(0, doubts[p] - doubts[richest]) for p, r in ratio.items()}
    best = max(score.values())

    def tells(e: Element) -> bool:
        sure = e.article is not None and e.doubts == e.article.doubts
        return e.weight() > 0 and score[e.path] > 0 and score[e.path] >= best * (KEEP_INSIDE if sure else KEEP_SHARE)

    holds, articles = containers([b.element for b in found if tells(b.element)])
    holder: dict[Element, Element | None] = {}

    def held_by(e: Element | None) -> Element | None:
        """The container that an element is in, if any."""
        if e is None or e in holds:
            return e
        if e not in holder:
            if e.article:
                holder[e] = e.article if e.article.path in articles else None
            else:
                holder[e] = held_by(e.up)
        return holder[e]

    inside = [held_by(b.element) for b in found]
    first = next((i for i, c in enumerate(inside) if c), 0)
    least = min((c.doubts for c in inside if c), default=0)
    kept = []
    for at, (b, c) in enumerate(zip(found, inside)):
        e = b.element
        if e.weight() == 0:
            continue
        steps = {e.tag, e.up.tag if e.up else ""}
        sure = c is not None and e.doubts == c.doubts and (b.plain or not HEADINGS.isdisjoint(steps) or e.article)
        title = at < first and "h1" in steps and e.doubts <= least
        if sure or title or tells(e):
            kept.append(b.text)
    return "\n".join(kept)


def extract(pages: DataFrame, page: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    ship(pages.sparkSession)

    def run(rows):
        for batch in rows:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=PAGES)

    return pages.select(F.col(page).cast("long"), F.col(url).cast("string"), F.col(source).cast("string")).mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op2_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {"op2_tag_paths": op2_tag_paths}
ORACLE: dict[str, str] = {}
