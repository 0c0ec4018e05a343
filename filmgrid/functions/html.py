"""Tables in HTML text, read with Spark's own regular expressions."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The class that marks the chart table, and the text that marks a cell to skip.
CHART_TABLE_CLASS = "mojo-body-table"
HIDDEN = "hidden"
# Fixed value: the shape of a chart page address.
CHART_URL = r"/weekly/(\d{4})W(\d{1,2})"

_ENTITY = r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


# The names that make up nearly all entities.
_COMMON = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0"}


def _named(name: Column) -> Column:
    """Character for an entity name; the long list is searched only for a rare name."""
    rare = {n[:-1]: value for n, value in html5.items() if n.endswith(";")}
    found = F.try_element_at(F.from_json(F.lit(json.dumps(rare)), "map<string,string>"), name)
    for common, character in _COMMON.items():
        found = F.when(name == common, F.lit(character)).otherwise(found)
    return found


def _character(piece: Column) -> Column:
    """Text of one piece that followed an ampersand, with the entity at its start decoded."""
    name, part = piece["name"], piece["part"]
    digits = F.when(F.lower(name).startswith("#x"), F.ltrim(F.substr(name, F.lit(3)), F.lit("0"))).otherwise(
        F.hex(F.substr(name, F.lit(2)).try_cast("bigint"))
    )
    # numbers too long for a character are cut to what is out of range as well
    number = F.when(F.length(digits) <= 6, F.conv(F.concat(F.lit("0"), digits), 16, 10).cast("bigint"))
    valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    decoded = F.decode(F.unhex(F.lpad(F.when(valid, digits).otherwise("FFFD"), 8, "0")), "UTF-32")
    character = F.when(name == "", F.lit(None)).when(name.startswith("#"), decoded).otherwise(_named(name))
    return F.coalesce(F.concat(character, F.substr(part, F.length(name) + 2)), F.concat(F.lit("&"), part))


def decode_entities(texts: Column) -> Column:
    """Array of texts with ``&amp;``, ``&#39;`` and the like as characters; unknown ones stay as they are.

    Each ``transform`` binds a value that the next one uses several times, so that it is computed once.
    """
    named = lambda part: F.struct(part.alias("part"), F.regexp_extract(part, _ENTITY, 1).alias("name"))

    def join(parts: Column) -> Column:
        tail = F.transform(F.transform(F.slice(parts, F.lit(2), F.size(parts)), named), _character)
        return F.concat(parts[0], F.array_join(tail, ""))

    return F.transform(texts, lambda text: F.when(text.contains("&"), F.get(F.transform(F.array(F.split(text, "&")), join), F.lit(0))).otherwise(text))


def texts_of(markup: Column) -> Column:
    """Visible text of each element: comments and tags dropped, entities decoded, line feeds removed."""
    bare = F.transform(markup, lambda element: F.regexp_replace(element, r"(?s)<!--.*?-->|<[^>]*>", ""))
    return F.transform(decode_entities(bare), lambda text: F.replace(text, F.lit("\n"), F.lit("")))


# The elements that an element may repeat itself in, and those that end it where its end tag is left out.
_WITHIN = {"tr": "table", "td": "table", "th": "table", "li": "ul|ol"}
_ENDED_BY = {"tr": "thead|tbody|tfoot", "td": "th|tr", "th": "td|tr"}


def elements(markup: Column, tag: str) -> Column:
    """The outermost elements of one kind, whole, in order; those inside of another one of the kind are part of it.

    Tags are matched by their depth. A row, cell or list item may have no end tag: it ends where the next one begins, or
    the table or list around it ends. Other elements without an end are left out. Tags in comments are no tags.
    """
    within, ended_by = _WITHIN.get(tag), _ENDED_BY.get(tag)
    kinds = "|".join(filter(None, [tag, within, ended_by]))
    pattern = rf"(?is)<!--.*?-->|</?(?:{kinds})\b[^>]*>"
    # a text and the tag behind it; behind the last text there is none
    tags = F.concat(F.regexp_extract_all(markup, F.lit(pattern), F.lit(0)), F.array(F.lit("")))
    pieces = F.arrays_zip(F.split(markup, pattern).alias("text"), tags.alias("mark"))
    is_a = lambda mark, kind, slash: mark.rlike(rf"(?i)^<{slash}(?:{kind})\b") if kind else F.lit(False)

    def state(opened: Column, depth: Column, at: Column, buffer: Column, found: Column) -> Column:
        return F.struct(opened.alias("opened"), depth.alias("depth"), at.alias("at"), buffer.alias("buffer"), found.alias("found"))

    def step(so_far: Column, piece: Column) -> Column:
        opened, depth, at, buffer, found = (so_far[c] for c in ("opened", "depth", "at", "buffer", "found"))
        mark = piece["mark"]
        before, after = F.concat(buffer, piece["text"]), F.concat(buffer, piece["text"], mark)
        one_more = lambda text: F.concat(found, F.array(text))
        begins, ends = is_a(mark, tag, ""), is_a(mark, tag, "/")
        closed, none = F.lit(False), F.lit("")
        grown = state(opened, depth, at, F.when(opened, after).otherwise(none), found)
        if within is None:
            # as deep as elements of the kind are open
            begun = state(F.lit(True), depth + 1, at, F.when(opened, after).otherwise(mark), found)
            ended = F.when(depth == 1, state(closed, F.lit(0), at, none, one_more(after))).otherwise(state(opened, depth - 1, at, after, found))
            return F.when(begins, begun).when(ends & opened, ended).otherwise(grown)
        # as deep as tables or lists are open
        level = opened & (depth == at)
        inwards, outwards = is_a(mark, within, ""), is_a(mark, within, "/")
        begun = state(F.lit(True), depth, depth, mark, F.when(level, one_more(before)).otherwise(found))
        left = state(closed, depth - 1, at, none, one_more(before))
        return (
            F.when(begins & (level | ~opened), begun)
            .when(ends & level, state(closed, depth, at, none, one_more(after)))
            .when((is_a(mark, ended_by, "/?") | (mark == "")) & level, state(closed, depth, at, none, one_more(before)))
            .when(outwards & level, left)
            .when(inwards | outwards, state(opened, depth + F.when(inwards, 1).otherwise(-1), at, grown["buffer"], found))
            .otherwise(grown)
        )

    start = state(F.lit(False), F.lit(0), F.lit(0), F.lit(""), F.array().cast("array<string>"))
    return F.coalesce(F.aggregate(pieces, start, step, lambda end: end["found"]), F.array().cast("array<string>"))


def element_texts(markup: Column, tag: str) -> Column:
    return texts_of(elements(markup, tag))


def chart_table(page: Column) -> Column:
    """Markup of the first chart table of a page, with what is nested in it; empty if there is none."""
    opening = rf"<table\b[^>]*class\s*=\s*[\"'][^\"']*(?<![\w-]){CHART_TABLE_CLASS}(?![\w-])[^>]*>"
    return F.coalesce(F.try_element_at(elements(F.regexp_extract(page, rf"(?is){opening}.*", 0), "table"), F.lit(1)), F.lit(""))


def visible(cells: Column) -> Column:
    """The cells whose markup does not say hidden."""
    return F.filter(cells, lambda cell: ~cell.contains(HIDDEN))


def chart_year(url: Column) -> Column:
    return F.regexp_extract(url, CHART_URL, 1).cast("int")


def chart_week(url: Column) -> Column:
    return F.regexp_extract(url, CHART_URL, 2).cast("int")
