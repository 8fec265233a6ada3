"""Main text of web pages by equivalence classes of template tokens.

A page is read as containers (block elements that hold others) and the text blocks in them. A container's token
is its chain of tags and names with its place among siblings of one name, so that siblings are told apart. A text block
outside articles is a token by its container and words. For all pages of a host, a token's occurrence vector says on which
pages it is, how often; it is kept as a count and a sum of hashes of (page, times), which is combined before it moves, so that a host
of any size is one row per token and task. Tokens with equal vectors are an equivalence class. A class is valid if it occurs on at
least ``support`` of the host's pages (and on two pages or more). The valid classes, each in the order of its tokens on the page, nested where
one's containers enclose another's, are the host's template; text blocks of valid classes are the template's own words.

What lies directly in a template's container, or below it in containers that are no part of the template, is a slot. A slot
holds data if its text varies: it has more than half as many different contents as the host has different pages. Menus, headers and footers repeat, so they are no data, whatever their tags
and names. Where several slots vary, tags and names decide between them: slots in an article or main element go before others,
containers without a telling tag, name or heading are no data beside a slot with ``BESIDE`` times as long texts, and slots in elements that tell by tag, role or name to be a menu, header, footer, sidebar, notice, advert, form or comments
are left out, inside articles too. The text of a page is that of its data slots and of containers that the template doesn't know, less the
template's own words outside articles: an article that a host repeats is still its text.

Where a host has no slot that varies (one page, or copies of one), or a page lacks its data slots, the page is read alone: its article
or main element, else the innermost container that holds all text outside the frame. A name frames whole, by its last part, or
by its first part before a word like "box", but never what holds an article, a main element or most of the page's text; an article or
main element with a frame's whole name ("comment") is no main element.

Scripts, styles, comments and markup are never text; character references are decoded once; white space inside a block
becomes one space; blocks are joined by one space in page order. Null and empty pages give an empty text, a page without
any container but with text gives that text; URLs without a host, null ones too, count as one host each page. Unclosed and stray tags are
tolerated, what follows a tag cut off by the page's end is no text; repeated rows and page ids are rows each; very long pages are read whole, in
time that grows with their length.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from qloom.llm.shared import boxed, cut, unboxed
from qloom.sources.tables import scan

SUPPORT = 0.5
# hosts' templates up to so many rows are broadcast; more are shuffled
BROADCAST_HOSTS = 20_000

_OPEN = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|/?[a-zA-Z])", re.I)
_TAG_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
# one attribute with its value, or what may stand between attributes; never backtracks over what it has read
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*)?))?")
# elements whose content is no text; those of the first line reach to the page's end if they aren't closed
_SWALLOWS = frozenset("script style".split())
_RAW = _SWALLOWS | frozenset("noscript template svg math iframe object canvas textarea select".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# elements that the start of another block, or of one of their kind, ends
_IMPLIED = {"p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}}
CONTAINERS = frozenset("html head body div section article main nav header footer aside form ul ol dl table menu dialog fieldset figure details".split())
# elements that end a block of text where they start or end
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody tfoot caption blockquote pre hr br figcaption summary address center title option legend label button".split()
)
_SKIPPED_TAGS = frozenset("head nav header footer aside form menu dialog button".split())
_FRAME_WORDS = (
    "nav|navbar|navigation|menu|header|masthead|footer|sidebar|side|aside|ad|ads|advert|adverts|advertisement|"
    "sponsor|sponsored|promo|banner|notice|cookie|cookies|consent|gdpr|popup|modal|newsletter|subscribe|signup|login|form|search|"
    "comment|comments|commentlist|respond|disqus|discussion|reply|replies|share|sharing|social|related|recommended|breadcrumb|breadcrumbs|"
    "pagination|pager|widget|toolbar|tags|hidden|copyright|legal"
)
_SKIPPED_NAME = re.compile(rf"^(?P<before>.*-|)(?:{_FRAME_WORDS})$")
_SKIPPED_START = re.compile(
    r"^(?:ad|ads|advert|advertisement|sponsor|sponsored|cookie|cookies|consent|newsletter|subscribe|comment|comments|reply|share|sharing|social|"
    r"related|recommended|breadcrumb|breadcrumbs|popup|sidebar|nav|menu|footer)-(?:slot|box|container|wrapper|wrap|unit|block|area|list|section|bar|links?|items?|"
    r"buttons?|inner|top|bottom|left|right|text|\d+)$"
)
_MAIN = ("article", "main")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# a plain container is no data slot beside one whose texts are so many times as long
BESIDE = 8
_SPACE = re.compile(r"\s+")


def _names(attributes: list[tuple[str, str]]) -> tuple[list[str], bool]:
    """(class and id names, whether the element is hidden or has a role of the page's frame)."""
    names: list[str] = []
    framed = False
    for key, value in attributes:
        value = value.lower()
        if key in ("class", "id"):
            names += re.sub(r"[_\s]+", " ", value.replace("_", "-").replace("--", "-")).split()
        elif key == "role":
            framed |= value in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "dialog", "alert")
        elif key == "hidden":
            framed |= value != "until-found"
        elif key == "aria-hidden":
            framed |= value == "true"
        elif key == "style" and "display:none" in value.replace(" ", ""):
            framed = True
    return names, framed


_TOLD = frozenset("class id role hidden aria-hidden style".split())


def _tags_of(source: str) -> Iterator[tuple[int, int, str, bool, bool, list[tuple[str, str]]]]:
    """(start, end, tag, whether it ends an element, whether it closes itself, attributes that tell something) of each tag.

    Comments, declarations and elements without text are one span with an empty tag. Reads on where a span ended, and looks for an end
    that isn't there once, so that time grows with the length.
    """
    at, size = 0, len(source)
    lower: str | None = None
    lacks: set[str] = set()
    while True:
        m = _OPEN.search(source, at)
        if not m:
            return
        start, opened = m.start(), m[0].lower()
        if opened in ("<!--", "<![cdata[", "<!", "<?"):
            mark = {"<!--": "-->", "<![cdata[": "]]>"}.get(opened, ">")
            end = source.find(mark, m.end())
            at = size if end < 0 else end + len(mark)
            yield start, at, "", False, False, []
            continue
        name = _TAG_NAME.match(source, start)
        tag, end, told = name[1].lower(), name.end(), []
        while True:
            found = _ATTRIBUTE.match(source, end)
            if not found:
                break
            end = found.end()
            if source[end : end + 1] in ("'", '"') and found[2] is found[3] is found[4] is None and found[0].rstrip().endswith("="):
                end = size  # a quoted value without an end
                break
            key = found[1].lower()
            if key in _TOLD:
                told.append((key, found[2] or found[3] or found[4] or ""))
        end = source.find(">", end)
        if end < 0:
            yield start, size, "", False, False, []
            return
        closes = source[start + 1] == "/"
        alone = source[end - 1] == "/" and source[end - 2 : end - 1] != "="
        at = end + 1
        if tag in _RAW and not closes and not alone and tag not in lacks:
            lower = source.lower() if lower is None else lower
            stop = lower.find(f"</{tag}", at) if len(lower) == size else source.find(f"</{tag}", at)
            if stop < 0 and tag not in _SWALLOWS:
                lacks.add(tag)
            elif stop < 0:
                yield start, size, "", False, False, []
                return
            else:
                close = source.find(">", stop)
                at = size if close < 0 else close + 1
                yield start, at, "", False, False, []
                continue
        yield start, at, tag, closes, alone, told


class Page:
    """A page as containers and blocks of text, each with the container around it (-1: none)."""

    def __init__(self, html: str | None):
        self.tags: list[str] = []
        self.parent: list[int] = []
        # a container's chain of names, and with places among siblings of one name, which tells it from all others of the host
        self.path: list[int] = []
        self.mark: list[int] = []
        self.is_main: list[bool] = []
        # a container of no telling tag or name, and without a heading of its own
        self.plain: list[bool] = []
        # the outermost article or main element around or at a container (-1: none), and whether an article is
        self.top: list[int] = []
        self.in_article: list[bool] = []
        sure: list[bool] = []
        named: list[bool] = []
        outer: list[int] = []
        holds: set[int] = set()
        self.blocks: list[tuple[int, str]] = []
        seen: Counter[tuple[int, str]] = Counter()
        stack: list[int] = []
        opened: Counter[str] = Counter()
        parts: list[str] = []
        in_title = False

        def close() -> None:
            text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                self.blocks.append((stack[-1] if stack else -1, text))

        def leave() -> None:
            opened[self.tags[stack.pop()]] -= 1

        at, source = 0, html if isinstance(html, str) else ""
        for start, end, tag, closes, alone, attributes in _tags_of(source):
            if start > at and not in_title:
                parts.append(source[at:start])
            at = end
            if tag == "title":
                in_title = not closes
            block = tag in BLOCKS
            if block and not closes and stack:
                # a framed paragraph or item ends where the next begins
                last = self.tags[stack[-1]]
                if last in _IMPLIED and (_IMPLIED[last] is None or tag in _IMPLIED[last]):
                    close()
                    leave()
            if closes:
                if block:
                    close()
                if opened[tag]:
                    close()
                    while self.tags[stack[-1]] != tag:
                        leave()
                    leave()
                continue
            if block:
                close()
                if stack and tag in _HEADINGS:
                    self.plain[stack[-1]] = False
            names, framed = _names(attributes) if attributes else ([], False)
            skipped = [x for x in map(_SKIPPED_NAME.match, names) if x]
            starts = any(map(_SKIPPED_START.match, names))
            # any element may tell by its name to be no text, inside a text by its whole name
            told = framed or (tag not in CONTAINERS and (starts or any(not x["before"] for x in skipped)))
            if (tag not in CONTAINERS and tag != "button" and not told) or alone or tag in _VOID or not tag:
                continue
            if told and not block:
                close()
            if tag == "body" and stack and self.tags[stack[-1]] == "head":
                leave()
            k, around = len(self.tags), stack[-1] if stack else -1
            inside = around >= 0 and self.top[around] >= 0
            # an article named as a comment or an advert is no main element
            is_main = tag in _MAIN and not any(not x["before"] for x in skipped) and not starts
            name = ".".join([tag, *(re.sub(r"\d+", "", x) for x in names)])
            seen[(around, name)] += 1
            path, mark = (self.path[around], self.mark[around]) if around >= 0 else (0, 0)
            self.tags.append(tag)
            self.parent.append(around)
            self.path.append(xxhash.xxh64_intdigest(f"{path}/{name}") >> 1)
            self.mark.append(xxhash.xxh64_intdigest(f"{mark}/{name}/{seen[(around, name)]}") >> 1)
            self.is_main.append(is_main)
            self.plain.append(tag in ("div", "ul", "ol", "dl", "table") and not names)
            self.top.append(self.top[around] if inside else k if is_main else -1)
            within = around >= 0 and self.in_article[around]
            self.in_article.append(within or (is_main and tag == "article"))
            # an article's own header holds its title
            titles = tag == "header" and inside
            sure.append(framed or (around >= 0 and sure[around]) or (tag in _SKIPPED_TAGS and not titles))
            named.append(tag not in ("html", "body") and (bool(skipped) or starts) and not titles)
            # what a container has to hold most text of for its names not to count: comments and the like of an article may be longer than it
            whole = inside and (starts or not all(x["before"] for x in skipped))
            outer.append(self.top[around] if whole else -1)
            stack.append(k)
            opened[tag] += 1
            if is_main and not sure[k] and not within:
                # stops at what is marked already
                x = k
                while x >= 0 and x not in holds:
                    holds.add(x)
                    x = self.parent[x]
        if at < len(source) and not in_title:
            parts.append(source[at:])
        close()

        # names never frame what holds an article or most of the page's text
        amounts = [0] * (len(self.tags) + 1)  # the last is the page
        for k, text in self.blocks:
            amounts[k] += 0 if k >= 0 and sure[k] else len(text)
        for k in range(len(self.tags) - 1, -1, -1):
            amounts[self.parent[k]] += amounts[k]
        self.framed = [False] * (len(self.tags) + 1)
        for k, around in enumerate(self.parent):
            most = 2 * amounts[k] > amounts[-1] if outer[k] < 0 else amounts[k] == amounts[outer[k]]
            self.framed[k] = sure[k] or self.framed[around] or (named[k] and k not in holds and not most)

    def in_main(self, k: int) -> bool:
        return k >= 0 and self.top[k] >= 0

    def token(self, k: int, text: str) -> int:
        return xxhash.xxh64_intdigest(f"{self.mark[k] if k >= 0 else 0}\n{text}") >> 1

    def own_texts(self) -> dict[int, list[str]]:
        """Texts that lie directly in each container."""
        out: dict[int, list[str]] = {}
        for k, text in self.blocks:
            out.setdefault(k, []).append(text)
        return out

    def main_alone(self) -> int:
        """The main container as the page alone tells: its outermost and fullest article or main element, else the innermost with all text outside the frame."""
        amounts = [0] * (len(self.tags) + 1)
        for k, text in self.blocks:
            if not self.framed[k]:
                amounts[k] += len(text)
        for k in range(len(self.tags) - 1, -1, -1):
            amounts[self.parent[k]] += amounts[k]
        for tag in _MAIN:
            # outermost ones: an article in a main element is inside no article, a main element may be in none at all
            tops = [
                k
                for k, t in enumerate(self.tags)
                if t == tag and self.is_main[k] and amounts[k] and not self.framed[k]
                and (self.top[k] == k or (tag == "article" and not (self.parent[k] >= 0 and self.in_article[self.parent[k]])))
            ]
            if tops:
                return max(tops, key=lambda k: (amounts[k], -k))
        most, best = amounts[-1], -1
        for k, around in enumerate(self.parent):
            # children follow their containers
            if most and amounts[k] == most and around == best:
                best = k
        return best


def main_text(
    page: Page, data: frozenset[int] = frozenset(), ways: frozenset[int] = frozenset(), known: frozenset[int] = frozenset(), words: frozenset[int] = frozenset()
) -> str:
    """The text of a page: in the host's data slots where it has any, else in its own main container.

    data, ways and known are marks of containers: those whose slot varies, those around them, and all of the host's template; words are its own texts.
    """
    n, alone = len(page.tags), page.main_alone()
    mine = [k for k, m in enumerate(page.mark) if m in data]
    article = any(page.in_main(k) for k in mine)
    inside = [False] * (n + 1)
    if mine and (article or not page.in_main(alone)):
        # containers that the template doesn't know are the page's own, where they lie on the way to data
        way = [False] * n + [True]
        inside[-1] = not article
        for k, around in enumerate(page.parent):
            m = page.mark[k]
            way[k] = m in data or m in ways if m in known else way[around]
            new = way[around] and (page.in_main(k) or not article)
            inside[k] = m in data if m in known else inside[around] or new
    else:
        # several articles side by side, named alike, are one slot
        same = page.path[alone] if page.in_main(alone) else None
        inside[-1] = alone < 0
        for k, around in enumerate(page.parent):
            inside[k] = inside[around] or k == alone or page.path[k] == same
    out = []
    for k, text in page.blocks:
        if inside[k] and not page.framed[k] and not (words and not page.in_main(k) and page.token(k, text) in words):
            out.append(text)
    return " ".join(out)


_TOKENS = "host string, token long, around long, is_text boolean, content long, chars long, place long, framed boolean, main boolean, plain boolean, vector long"
# stands for the page as a whole
_PAGE = 0


def _occurrences(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each page's tokens: containers with what lies directly in them, and text blocks outside articles, with the hash of (page, times)."""
    names = [x.split()[0] for x in _TOKENS.split(", ")]
    for f in frames:
        rows = []
        for mark, host, source in zip(f["mark"], f["host"], f["html"]):
            page = Page(source)

            def part(n: int, mark=mark) -> int:
                return xxhash.xxh64_intdigest(f"{mark}:{n}") >> 24  # 40 bits, so that sums of 2 ** 23 pages stay exact

            texts = page.own_texts()
            whole = xxhash.xxh64_intdigest("\n".join(t for _, t in page.blocks)) >> 1
            rows.append((host, _PAGE, -1, False, whole, 0, -1, False, False, False, part(1)))
            for k, m in enumerate(page.mark):
                own = "\n".join(texts.get(k, ()))
                around = page.mark[page.parent[k]] if page.parent[k] >= 0 else _PAGE
                rows.append((host, m, around, False, xxhash.xxh64_intdigest(own) >> 1, len(own), k, page.framed[k], page.in_main(k), page.plain[k], part(1)))
            counts = Counter(page.token(k, t) for k, t in page.blocks if not page.in_main(k))
            rows += [(host, t, 0, True, 0, 0, 0, False, False, False, part(n)) for t, n in counts.items()]
            if len(rows) > 20_000:
                yield pd.DataFrame(rows, columns=names)
                rows = []
        yield pd.DataFrame(rows, columns=names)


def templates(pages: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per host of two pages or more: (host, slots, data, ways, known, words).

    ``pages`` has the columns mark (unlike for any two pages), host and html. slots are the template's containers with text of their
    own, in page order: (class, container, around, variation, chars, data); data, ways and known are marks of containers, words the hashes of the template's own texts.
    """
    seen = pages.where("host is not null").mapInPandas(_occurrences, _TOKENS)
    hosts = pages.where("host is not null").groupBy("host").agg(F.count("*").alias("n_pages")).where("n_pages > 1")
    contents = seen.groupBy("host", "token", "is_text", "content").agg(
        F.count("*").alias("on_pages"),
        F.sum(F.col("vector").cast("decimal(38,0)")).alias("vector"),
        F.sum("chars").alias("chars"),
        F.sum("place").alias("place"),
        F.sum(F.col("framed").cast("long")).alias("framed"),
        F.max("main").alias("main"),
        F.min("plain").alias("plain"),
        F.max("around").alias("around"),
    )
    tokens = cut(
        contents.groupBy("host", "token", "is_text").agg(
            F.sum("on_pages").alias("on_pages"),
            F.count("*").alias("contents"),
            *[F.sum(c).alias(c) for c in ("vector", "chars", "place", "framed")],
            F.max("main").alias("main"),
            F.min("plain").alias("plain"),
            F.max("around").alias("around"),
        )
    )
    valid = tokens.join(hosts, "host").where(F.col("on_pages") >= F.greatest(F.lit(2), F.col("n_pages") * support))
    # classes: equal vectors of one host
    container = F.struct(F.col("vector").cast("string").alias("class"), *[c for c in ("token", "around", "contents", "on_pages", "chars", "place", "framed", "main", "plain")])
    classes = valid.groupBy("host", "on_pages", "vector").agg(
        F.collect_list(F.when(~F.col("is_text"), container)).alias("containers"), F.collect_list(F.when(F.col("is_text"), F.col("token"))).alias("words")
    )
    # at most pages' tokens / support of them, whatever the number of pages
    template = classes.groupBy("host").agg(F.flatten(F.collect_list("containers")).alias("classes"), F.flatten(F.collect_list("words")).alias("words"))
    slot = "struct<class:int,container:long,around:long,variation:double,chars:long,data:boolean>"

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for host, found, words in zip(f["host"], f["classes"], f["words"]):
                groups: dict[tuple, list[dict]] = {}
                for c in found:
                    groups.setdefault((c["on_pages"], c["class"]), []).append(c)
                rows.append((host, *_slots(list(groups.values())), list(words)))
            yield pd.DataFrame(rows, columns=["host", "slots", "data", "ways", "known", "words"])

    return template.mapInPandas(choose, f"host string, slots array<{slot}>, data array<long>, ways array<long>, known array<long>, words array<long>")


def _slots(classes: list[list[dict]]) -> tuple[list[dict], list[int], list[int], list[int]]:
    """(slots in page order, marks of those that hold data, of containers around them, of all containers) of a host's valid classes."""
    # outer classes first: by the mean place of their first token
    ordered = sorted((sorted(g, key=lambda c: c["place"] / c["on_pages"]) for g in classes if g), key=lambda g: g[0]["place"] / g[0]["on_pages"])
    pages = next((c["contents"] for g in ordered for c in g if c["token"] == _PAGE), 1)
    containers = [(i, c) for i, g in enumerate(ordered) for c in g if c["token"] != _PAGE]
    varies = [
        (i, c)
        for i, c in containers
        if c["chars"] and c["contents"] > 1 and 2 * c["contents"] > pages * c["on_pages"] / max(x["on_pages"] for _, x in containers) and 2 * c["framed"] <= c["on_pages"]
    ]
    around, ways = {c["token"]: c["around"] for _, c in containers}, set()

    def chain(token: int) -> set[int]:
        out = set()
        while token in around and token not in out:
            out.add(token)
            token = around[token]
        return out

    # tags decide between slots that vary, then length
    varies = [x for x in varies if x[1]["main"]] or varies
    if varies:
        fullest = max((c for _, c in varies), key=lambda c: (c["chars"] / c["on_pages"], -c["token"]))
        over, mean = chain(fullest["token"]), fullest["chars"] / fullest["on_pages"]
        varies = [
            (i, c) for i, c in varies
            if not c["plain"] or BESIDE * c["chars"] / c["on_pages"] >= mean or c["token"] in over or fullest["token"] in chain(c["token"])
        ]
    data = [c["token"] for _, c in varies]
    chosen = set(data)
    slots = [
        {"class": i, "container": c["token"], "around": c["around"], "variation": c["contents"] / max(pages, 1), "chars": c["chars"], "data": c["token"] in chosen}
        for i, c in containers
        if c["chars"]
    ]
    for token in data:
        ways |= chain(token) - ways
    return slots, data, sorted(ways), list(around)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", support: float = SUPPORT, broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    host = F.nullif(F.lower(F.regexp_extract(F.col(f"`{url}`"), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    own = pages.select(
        boxed(F.col(f"`{key}`")).alias("page_id"), F.col(f"`{url}`").alias("url"), host.alias("host"), F.col(f"`{html}`").alias("html")
    )
    # two rows alike in everything have equal vectors whichever is which
    marked = own.select(F.xxhash64("page_id", "url", "html").alias("mark"), "host", "html")
    known = cut(templates(marked, support)).select("host", "data", "ways", "known", "words")
    # rows and marks are both counted, so that what is broadcast has a bound in bytes
    size = known.agg(F.count("*").alias("n"), F.sum(F.size("data") + F.size("ways") + F.size("known") + F.size("words")).alias("marks")).first()
    small = size["n"] <= broadcast_hosts and (size["marks"] or 0) <= 50 * broadcast_hosts
    joined = own.join(F.broadcast(known) if small else known, "host", "left").select("page_id", "url", "html", "data", "ways", "known", "words")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets = lambda x: frozenset() if x is None else frozenset(x.tolist() if hasattr(x, "tolist") else x)
        for f in frames:
            out = [main_text(Page(source), *map(sets, marks)) for source, *marks in zip(f["html"], f["data"], f["ways"], f["known"], f["words"])]
            yield pd.DataFrame({"page_id": f["page_id"], "url": f["url"], "text": out, "n_chars": [len(x) for x in out]})

    done = joined.mapInPandas(run, "page_id long, url string, text string, n_chars long")
    return done.withColumn("page_id", unboxed(F.col("page_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(scan(spark, sf_dir, "pages"))


QUERIES = {"op10_html_text": query}
