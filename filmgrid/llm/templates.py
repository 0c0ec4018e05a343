"""Main text of web pages by template deduction.

Tokens are tags and pieces of text, told apart by the elements around them. A token's occurrence vector says how often it
occurs on each page of a host; tokens with equal vectors that are frequent enough form an equivalence class. A class is
valid if its tags come in one order on every page and always begin in the same gap of the class around it. The valid
classes, nested into each other, are the host's template; a piece of text whose vector is that of a valid class belongs
to the template, too. What stands in the gaps is the pages' own. Of the gaps, those in menus, headers, footers, sidebars,
notices, adverts, forms and comments go, and so do links that are part of the template; the article stays.

Vectors are never gathered: a vector is compared by its sums of (count x a number drawn from the page), which add up task
by task before the shuffle, so that a host may hold any share of the pages. Tags are counted on all pages. Pieces of text
are many. A piece that half of a host's pages hold is on a quarter of the pages that a task holds together in tasks with at
least a third of the pages, so tasks name such pieces, and the next pass over the pages counts exactly those that are named
often enough, of which there are few. Hosts of a few pages use the template of all pages.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmgrid.llm.reputation import url_parts
from filmgrid.session import written

#: hosts of fewer pages have no template of their own
MIN_PAGES = 5
#: share of a host's pages that hold a token of the template
MIN_SHARE = 0.25
#: share of a host's pages that hold a piece of text of the template; tasks name pieces with at least MIN_SHARE
TEXT_SHARE = 0.5
#: tags that make a class
MIN_TAGS = 2
#: share of the words outside of menus and the like that the main element holds, where no element says it is the article
MAIN_SHARE = 0.6
#: counted tokens that a task holds before it passes them on
HELD = 200_000
#: page numbers and sums of them are kept modulo this, so that sums over millions of tasks fit into a long
MODULUS = 1 << 40

# HTML elements by how they are read.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var p li dt dd tr td th thead tbody tfoot colgroup caption option optgroup h1 h2 h3 h4 h5 h6".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 "
    "h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Elements, roles and words in class names that mark what is not the article.
ASIDE = frozenset("nav header footer aside form menu dialog button select noscript template svg object canvas audio video head label fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs header footer masthead comment comments reply replies disqus cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended widget "
    "toolbar pagination pager search form hidden".split()
)

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s<>/"']*)((?:[^<>"']|"[^"]*"|'[^']*')*+)>|<[!?][^>]*>""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
# numbers of pages and posts, which would tell apart what is the same; classes are numbered by kind
_DIGITS, _LONG_DIGITS = re.compile(r"[0-9]+"), re.compile(r"[0-9]{3,}")
_NAME = re.compile(r"[a-z]+")


def _hash(text: str) -> int:
    """A signed long, the same in every task."""
    return xxhash.xxh64_intdigest(text) - (1 << 63)


@lru_cache(1 << 16)
def _element(name: str, attributes: str) -> tuple[str, bool]:
    """How an element is told apart (name, id and classes, without numbers of pages) and whether it marks something beside the article."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
    label = f"{found.get('id', '')} {found.get('class', '')}"
    words = set(_NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", label).lower()))
    role = found.get("role", "").lower()
    aside = name in ASIDE or role in ROLES or "display:none" in found.get("style", "").replace(" ", "").lower()
    aside = aside or bool(re.search(r"(^|\s)hidden(\s|=|$)", attributes)) or found.get("aria-hidden", "") == "true"
    if name == "article":
        aside = bool(words & {"comment", "comments", "reply", "replies"})
    elif name not in ("html", "body", "main") and role != "main":
        aside = aside or bool(words & WORDS)
    classes = " ".join(sorted(found.get("class", "").split()))
    return f"{name} {_DIGITS.sub('0', found.get('id', ''))} {_LONG_DIGITS.sub('0', classes)}", aside


@lru_cache(1 << 16)
def _step(path: int, signature: str) -> int:
    return _hash(f"{path}/{signature}")


def read(page: str) -> Iterator[tuple]:
    """The page's tokens in order: ``("start" | "end", name, token, path, aside, opened)`` and ``("text", "", token, path, text, False)``.

    ``path`` is the number of the innermost open element; ``opened`` says whether the token opens or closes an element
    on the path. Elements whose end tag is often left out, and inline ones, are not on the path unless they mark
    something beside the article. End tags without a start are passed over; raw text goes with its element.
    """
    stack: list[tuple[str, int]] = []
    open_now: dict[str, int] = defaultdict(int)
    path, at = 0, 0
    search = _TAG.search
    while True:
        tag = search(page, at)
        piece = page[at : tag.start()] if tag else page[at:]
        if piece:
            text = entities.unescape(piece) if "&" in piece else piece
            if not text.isspace():
                yield "text", "", _hash(f"{path} {' '.join(text.split())}"), path, text, False
            else:
                yield "text", "", 0, path, text, False
        if tag is None:
            return
        at = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if tag[1]:
            if open_now[name]:
                gone = ""
                while gone != name:
                    gone, number = stack.pop()
                    open_now[gone] -= 1
                    path = stack[-1][1] if stack else 0
                    yield "end", gone, _step(number, "/"), path, False, True
            elif name in INLINE:
                yield "end", name, _step(path, "/" + name), path, False, False
            continue
        signature, aside = _element(name, tag[3])
        if name in RAW:
            end = re.compile(f"</{name}", re.IGNORECASE).search(page, at)
            at = page.find(">", end.end()) + 1 or len(page) if end else len(page)
            yield "start", name, _step(path, signature), path, aside, False
            continue
        if stack and stack[-1][0] in ("p", "li") and (name in BLOCKS if stack[-1][0] == "p" else name == "li"):
            gone, number = stack.pop()  # one that marks something beside the article and has no end tag
            open_now[gone] -= 1
            path = stack[-1][1] if stack else 0
            yield "end", gone, _step(number, "/"), path, False, True
        opened = name not in VOID and not tag[3].endswith("/") and (aside or name not in INLINE)
        token = _step(path, signature)
        if opened:
            stack.append((name, token))
            open_now[name] += 1
            path = token
        yield "start", name, token, path, aside, opened


class Template:
    """What is known of a host: classes of tags in order, pieces of text, and the main element."""

    def __init__(self, described: str | None):
        known = json.loads(described) if described else {}
        self.place: dict[int, tuple[int, int]] = {}
        self.size: dict[int, int] = {}
        for one in known.get("classes") or ():
            members = sorted((m["first"], m["token"]) for m in one["tokens"])
            self.size[one["class"]] = len(members)
            for i, (_, token) in enumerate(members):
                self.place[token] = (one["class"], i)
        self.texts = frozenset(known.get("texts") or ())
        self.main = known.get("main")


@lru_cache(256)
def _template(described: str | None) -> Template:
    return Template(described)


def _drawn(page: str) -> tuple[int, int]:
    """Two numbers below ``MODULUS`` that stand for the page in occurrence vectors."""
    number = xxhash.xxh128_intdigest(page)
    return number % MODULUS, (number >> 64) % MODULUS


_COUNTS = "host string, kind int, token long, slot long, pages long, n long, sum1 long, sum2 long, first double"
_NAMES = ["host", "kind", "token", "slot", "pages", "n", "sum1", "sum2", "first"]
_TYPES = [pa.string(), pa.int32(), *[pa.int64()] * 6, pa.float64()]
PAGES, TAG, TEXT, BROKEN, NESTED, WORDS_IN = range(6)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(_NAMES), _TYPES)], names=_NAMES)


class _Counts:
    """Counts by (host, kind, token, slot), passed on whenever many are held."""

    def __init__(self):
        self.held: dict[tuple, list] = {}

    def add(self, host: str, kind: int, token: int, slot: int, n: int, drawn: tuple[int, int], first: float = 0.0) -> None:
        row = self.held.setdefault((host, kind, token, slot), [0, 0, 0, 0, 0.0])
        row[0] += 1
        row[1] += n
        row[2] += n * drawn[0]
        row[3] += n * drawn[1]
        row[4] += first

    def rows(self) -> pa.RecordBatch:
        rows = [(*k, v[0], v[1], v[2] % MODULUS, v[3] % MODULUS, v[4]) for k, v in self.held.items()]
        self.held = {}
        return _batch(rows)


def _host_key(host: str) -> str:
    return f"h{host}"


#: the key under which all pages are counted
ALL = "a"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First pass: vectors of tags, and pieces of text that are frequent among the pages held together."""
    counts, texts_on = _Counts(), defaultdict(int)
    together: dict[str, int] = defaultdict(int)

    def passed_on() -> pa.RecordBatch:
        for (key, token), n in texts_on.items():
            if n >= MIN_SHARE * together[key]:
                counts.add(key, TEXT, token, 0, together[key], (0, 0))
        texts_on.clear()
        together.clear()
        return counts.rows()

    for batch in batches:
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            page = page or ""
            tags: dict[int, list] = {}
            texts: set[int] = set()
            for position, (kind, _, token, *_) in enumerate(read(page)):
                if kind == "text":
                    if token:
                        texts.add(token)
                else:
                    tags.setdefault(token, [0, position])[0] += 1
            drawn = _drawn(page)
            for key in (_host_key(host), ALL):
                together[key] += 1
                counts.add(key, PAGES, 0, 0, 1, (0, 0))
                for token, (n, position) in tags.items():
                    counts.add(key, TAG, token, 0, n, drawn, position)
                for token in texts:
                    texts_on[key, token] += 1
            if len(counts.held) + len(texts_on) > HELD:
                yield passed_on()
    yield passed_on()


def _checked(pool: str):
    """Second pass: order and nesting of the classes, vectors of the pieces of text, words by element."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts()
        for batch in batches:
            for host, page, own in zip(*[batch.column(c).to_pylist() for c in ("host", "html", "template")]):
                page = page or ""
                events = list(read(page))
                drawn = _drawn(page)
                for key, described in ((_host_key(host), own), (ALL, pool)):
                    if described:
                        _check_page(key, _template(described), events, drawn, counts)
            if len(counts.held) > HELD:
                yield counts.rows()
        yield counts.rows()

    return run


def _check_page(key: str, template: Template, events: list[tuple], drawn: tuple[int, int], counts: _Counts) -> None:
    expected: dict[int, int] = {}
    broken: set[int] = set()
    inside: list[tuple[int, int]] = []
    texts: dict[int, int] = defaultdict(int)
    for kind, _, token, *_ in events:
        if kind == "text":
            if token in template.texts:
                texts[token] += 1
            continue
        place = template.place.get(token)
        if place is None:
            continue
        number, i = place
        if expected.get(number, 0) != i:
            broken.add(number)
        if i == 0:
            gap = inside[-1] if inside else (0, 0)
            counts.add(key, NESTED, number, _hash(f"{gap}"), 1, (0, 0))
            inside.append((number, 0))
        else:
            while inside and inside[-1][0] != number and any(c == number for c, _ in inside):
                broken.add(inside.pop()[0])  # a class that has not ended when the one around it goes on
            if inside and inside[-1][0] == number:
                inside[-1] = (number, i)
        if i + 1 == template.size[number]:
            expected[number] = 0
            if inside and inside[-1][0] == number:
                inside.pop()
        else:
            expected[number] = i + 1
    for number in broken:
        counts.add(key, BROKEN, number, 0, 1, (0, 0))
    for token, n in texts.items():
        counts.add(key, TEXT, token, 0, n, drawn)
    for path, (words, depth) in _words_by_element(events).items():
        counts.add(key, WORDS_IN, path, depth, words, (0, 0))


def _words_by_element(events: list[tuple]) -> dict[int, tuple[int, int]]:
    """Words outside of links and of what is beside the article, by every element they stand in, with its depth; 0 is the page."""
    found: dict[int, tuple[int, int]] = {}
    stack: list[list] = [[0, False, 0]]
    beside, links = 0, False

    def leave() -> int:
        element, aside, words = stack.pop()
        found[element] = (found.get(element, (0, 0))[0] + words, len(stack))
        if stack:
            stack[-1][2] += words
        return aside

    for kind, name, token, path, extra, opened in events:
        if kind == "text":
            if token and not beside and not links:
                stack[-1][2] += len(extra.split())
        elif name == "a" and not opened:
            links = kind == "start"
        elif opened and kind == "start":
            stack.append([path, extra, 0])
            beside += extra
        elif opened:
            beside -= leave()
    while stack:
        leave()
    return found


def main_text(page: str | None, template: Template) -> str:
    """The article's blocks, one a line."""
    events = list(read(page or ""))
    starts = {name for kind, name, _, _, aside, _ in events if kind == "start" and not aside}
    wanted = next((name for name in ("article", "main") if name in starts), None)
    main = template.main if wanted is None and any(e[0] == "start" and e[3] == template.main for e in events) else None

    def blocks(drop_template: bool) -> list[str]:
        found: list[str] = []
        block: list[str] = []
        linked, own = True, False  # all of the block so far stands in links; some of it is the page's own
        stack: list[tuple[str, bool, bool]] = []  # name, beside the article, the article or main element
        in_link, in_item, in_title, in_paragraph = "", False, False, False

        def close() -> None:
            nonlocal linked, own
            text = " ".join("".join(block).split())
            # an item of a list outside of an article that is nothing but a link belongs to a menu
            if text and (own or not drop_template) and not (linked and in_item and wanted is None):
                found.append(text)
            block.clear()
            linked, own = True, False

        beside = within = articles = 0
        for kind, name, token, path, extra, opened in events:
            if kind == "text":
                inside = within or (wanted is None and main is None) or (in_title and wanted is None)
                if beside or not inside:
                    continue
                block.append(extra)
                if token:
                    linked = linked and bool(in_link)
                    own = own or not (token in template.texts or (in_link == "template" and not in_paragraph))
                continue
            if name in BLOCKS:
                close()
                in_item = name == "li" and kind == "start"
                in_title = name == "h1" and kind == "start"
                in_paragraph = name == "p" and kind == "start"
            elif name == "br":
                block.append(" ")
            if name == "a":
                in_link = "" if kind == "end" else "template" if token in template.place else "own"
            if opened and kind == "start":
                # an article may have a header of its own
                aside = extra and not (name == "header" and articles)
                is_main = (name == wanted) if wanted else (main is not None and path == main)
                stack.append((name, bool(aside), is_main))
                beside += bool(aside)
                within += is_main
                articles += name == "article"
            elif opened and stack:
                gone, aside, is_main = stack.pop()
                beside -= aside
                within -= is_main
                articles -= gone == "article"
        close()
        return found

    # pages that all hold one and the same article have it in their template
    return "\n".join(blocks(True) or blocks(False))


def _extracted(pool: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages, templates = batch.column("html").to_pylist(), batch.column("template").to_pylist()
            texts = [main_text(page, _template(own or pool)) for page, own in zip(pages, templates)]
            counts = pa.array([len(t) for t in texts], pa.int64())
            arrays = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), counts]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text", "n_chars"])

    return run


def _totals(partial: DataFrame, label: str) -> DataFrame:
    modulo = lambda c: F.pmod(F.sum(c), F.lit(MODULUS)).alias(c)
    sums = [F.sum("pages").alias("pages"), F.sum("n").alias("n"), modulo("sum1"), modulo("sum2"), F.sum("first").alias("first")]
    return written(partial.groupBy("host", "kind", "token", "slot").agg(*sums), label)


def _described(parts: DataFrame) -> DataFrame:
    """``(host, template)`` from ``(host, classes, texts, main)``."""
    return parts.select("host", F.to_json(F.struct("classes", "texts", "main")).alias("template"))


def _pool(templates: DataFrame) -> str:
    """The template of all pages; frequent tokens are at most the tokens of an average page divided by the share."""
    row = templates.where(F.col("host") == ALL).select("template").first()
    return row["template"] if row else ""


def templates(pages: DataFrame) -> DataFrame:
    """``(host, template)`` for pages ``(host, html)``: for each host of enough pages, and under ``ALL`` for all pages."""
    first = _totals(pages.select("host", "html").mapInArrow(_counted, _COUNTS), "template-tokens")
    sizes = first.where(F.col("kind") == PAGES).select("host", F.col("pages").alias("total"))
    sizes = sizes.where((F.col("total") >= MIN_PAGES) | (F.col("host") == ALL))
    frequent = first.where(F.col("kind") == TAG).join(sizes, "host").where(F.col("pages") >= F.col("total") * MIN_SHARE)
    vector = ["host", "pages", "n", "sum1", "sum2"]
    tokens = F.collect_list(F.struct((F.col("first") / F.col("pages")).alias("first"), "token")).alias("tokens")
    classes = frequent.groupBy(*vector).agg(tokens).where(F.size("tokens") >= MIN_TAGS)
    classes = written(classes.withColumn("class", F.xxhash64(*vector)), "template-classes")
    # n: pages in the tasks that have named the piece; whether it is frequent over all pages is for the next pass to say
    named = first.where(F.col("kind") == TEXT).join(sizes, "host").where(F.col("n") >= F.col("total") * (TEXT_SHARE - MIN_SHARE) / (1 - MIN_SHARE))
    pieces = named.groupBy("host").agg(F.collect_list("token").alias("texts"))
    of_host = classes.groupBy("host").agg(F.collect_list(F.struct("class", "tokens")).alias("classes"))
    proposed = written(_described(of_host.join(pieces, "host", "left").withColumn("main", F.lit(None).cast("long"))), "template-proposed")

    second = _totals(_with_template(pages, proposed).mapInArrow(_checked(_pool(proposed)), _COUNTS), "template-checks")
    broken = second.where(F.col("kind") == BROKEN).select("host", F.col("token").alias("class"))
    gaps = second.where(F.col("kind") == NESTED).groupBy("host", F.col("token").alias("class")).agg(F.count(F.lit(1)).alias("gaps"))
    valid = classes.join(gaps.where("gaps = 1"), ["host", "class"]).join(broken, ["host", "class"], "left_anti")
    texts = second.where(F.col("kind") == TEXT).select(*vector, "token").join(valid.select(*vector), vector)
    texts = texts.join(sizes, "host").where(F.col("pages") >= F.col("total") * TEXT_SHARE)
    words = second.where(F.col("kind") == WORDS_IN).select("host", F.col("token").alias("path"), F.col("slot").alias("depth"), "n")
    whole = words.where("path = 0").select("host", F.col("n").alias("total"))
    large = words.where("path <> 0").join(whole, "host").where(F.col("n") >= F.col("total") * MAIN_SHARE)
    mains = large.groupBy("host").agg(F.max_by("path", F.struct("depth", "n", "path")).alias("main"))
    of_host = valid.groupBy("host").agg(F.collect_list(F.struct("class", "tokens")).alias("classes"))
    of_host = of_host.join(texts.groupBy("host").agg(F.collect_set("token").alias("texts")), "host", "left")
    return written(_described(of_host.join(mains, "host", "full")), "templates")


def _with_template(pages: DataFrame, described: DataFrame) -> DataFrame:
    known = described.where(F.col("host") != ALL).select(F.substr("host", F.lit(2)).alias("of"), "template")
    return pages.join(known, F.col("host") == F.col("of"), "left").drop("of")


def host_of(url: Column) -> Column:
    return url_parts(url)[0]


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)``, a row per row.

    Null html gives an empty text, and so does a page without an article. Rows that repeat each give a row; repeated pages
    count as pages of their host. Pages without a url, or without a host in it, are pages of one host without a name. Hosts
    of fewer than ``MIN_PAGES`` pages use what all pages have in common. A block that is all template goes unless nothing
    would be left of the page; pieces of the template inside of a block of the page's own stay. An empty table gives an empty result. Other columns are not looked at.
    """
    read_pages = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    with_host = read_pages.withColumn("host", host_of(F.col("url")))
    known = templates(with_host)
    kind = read_pages.schema["page_id"].dataType.simpleString()
    return _with_template(with_host, known).mapInArrow(_extracted(_pool(known)), f"page_id {kind}, url string, text string, n_chars long")
