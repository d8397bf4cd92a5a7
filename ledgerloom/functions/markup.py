"""HTML fragments: balanced elements, link addresses, character references."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used.

    Whatever stands outside a lambda is worked out for every element otherwise.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _character(code: Column) -> Column:
    """The character of a code point; what is none becomes the replacement character."""
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    number = F.when(valid, code).otherwise(F.lit(0xFFFD))
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


def _decoded(reference: Column) -> Column:
    # One literal instead of some five hundred, which every planning step would visit.
    known = json.dumps({name: chr(code) for name, code in sorted(name2codepoint.items())})
    names = F.from_json(F.lit(known), "map<string,string>")
    body = F.substring(reference, F.lit(2), F.length(reference) - 2)
    hexadecimal = F.conv(F.substring(body, F.lit(3), F.length(body)), 16, 10).try_cast("bigint")
    decimal = F.substring(body, F.lit(2), F.length(body)).try_cast("bigint")
    return (
        F.when(body.rlike("^#[xX]"), _character(hexadecimal))
        .when(F.startswith(body, F.lit("#")), _character(decimal))
        .otherwise(F.coalesce(F.try_element_at(names, body), reference))
    )


def decode_entities(text: Column) -> Column:
    """Named and numbered character references as characters; unknown names stay."""

    def decoded(given: Column) -> Column:
        plain = F.split(given, _REFERENCE, -1)
        found = F.regexp_extract_all(given, F.lit(f"({_REFERENCE})"), F.lit(1))
        mended = F.zip_with(
            plain, found, lambda p, r: F.concat(p, F.coalesce(_decoded(r), F.lit("")))
        )
        return F.when(F.contains(given, F.lit("&")), F.array_join(mended, "")).otherwise(given)

    return bound(text, decoded)


def _tag(tag: str) -> str:
    return rf"(?is)</?{tag}(?=[\s/>])[^>]*>"


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running sums, minima, ...: ``join`` over each element and all before it.

    Doubles the reach of every element in each round, so that n elements take
    some n log n steps; a fold that appends to its state would copy it n times.
    """

    def round_of(state: Column, reach: Column) -> Column:
        head = F.slice(state, F.lit(1), reach)
        moved = F.slice(state, F.lit(1), F.size(state) - reach)
        rest = F.slice(state, reach + 1, F.size(state))
        return F.concat(head, F.zip_with(rest, moved, join))

    def rounds(given: Column) -> Column:
        reaches = F.array(*[F.lit(1 << k) for k in range(31)])
        return F.aggregate(F.filter(reaches, lambda reach: reach < F.size(given)), given, round_of)

    return bound(values, rounds)


def _spans(tags: Column) -> Column:
    """``open, close``: index of each opening tag and of the tag that closes it.

    A tag that nothing closes runs on to the end; closing tags too many are
    passed over. In order of the opening tags.

    The depth is a running sum of openings and closings, lifted where there are
    closings too many. At each depth openings and closings take turns, so sorted
    by depth and place an opening has its closing next to it.
    """
    steps = F.transform(tags, lambda t: F.when(F.startswith(t, F.lit("</")), -1).otherwise(1))
    sums = _running(steps, lambda a, b: a + b)

    def placed(sums: Column) -> Column:
        least = _running(F.transform(sums, lambda s: F.least(s, F.lit(0))), lambda a, b: F.least(a, b))
        # What the sum would have been ahead of a tag, had it never gone below 0.
        both = F.zip_with(sums, least, lambda s, low: F.struct(s.alias("sum"), low.alias("least")))
        ahead = F.concat(F.array(F.struct(F.lit(0).alias("sum"), F.lit(0).alias("least"))), both)
        return F.transform(
            F.slice(ahead, F.lit(1), F.size(sums)),
            lambda before, i: F.struct((before["sum"] - before["least"]).alias("depth"), i.alias("at")),
        )

    def sorted_tags(given: Column) -> Column:
        ends = F.transform(given["tags"], lambda t: F.startswith(t, F.lit("</")))
        marked = F.zip_with(
            given["placed"], ends,
            lambda p, end: F.struct(
                F.when(end, p["depth"] - 1).otherwise(p["depth"]).alias("depth"), p["at"].alias("at"), end.alias("ends")
            ),
        )
        return F.array_sort(F.filter(marked, lambda m: m["depth"] >= 0))

    def paired(order: Column) -> Column:
        beside = F.concat(F.slice(order, F.lit(2), F.size(order)), F.array(F.lit(None).cast("struct<depth:int,at:int,ends:boolean>")))
        pairs = F.zip_with(
            order, beside,
            lambda one, other: F.when(
                ~one["ends"],
                F.struct(
                    one["at"].alias("open"),
                    F.when(other["ends"] & (other["depth"] == one["depth"]), other["at"]).alias("close"),
                ),
            ),
        )
        return F.array_sort(F.filter(pairs, lambda p: p.isNotNull()))

    found = bound(
        F.struct(tags.alias("tags"), bound(sums, placed).alias("placed")),
        lambda given: bound(sorted_tags(given), paired),
    )
    return bound(
        F.size(tags),
        lambda end: F.transform(
            found, lambda p: F.struct(p["open"].alias("open"), F.coalesce(p["close"], end).alias("close"))
        ),
    )


def element_bodies(html: Column, tag: str) -> Column:
    """What stands between the tags of every element of a kind, in document order.

    Elements inside an element of the same kind come after it, and are part of
    its body too. NULL has none.
    """
    pieces = F.split(html, _tag(tag), -1)
    tags = F.regexp_extract_all(html, F.lit(_tag(tag).replace("(?is)", "(?is)(", 1) + ")"), F.lit(1))

    def bodies(page: Column) -> Column:
        def body(span: Column) -> Column:
            inside = F.slice(page["pieces"], span["open"] + 2, span["close"] - span["open"])
            between = F.slice(page["tags"], span["open"] + 2, span["close"] - span["open"] - 1)
            joined = F.zip_with(inside, between, lambda p, t: F.concat(p, F.coalesce(t, F.lit(""))))
            return F.array_join(joined, "")

        # Where openings and closings take turns, every second piece is a body.
        turns = F.array_join(
            F.transform(page["tags"], lambda t: F.when(F.startswith(t, F.lit("</")), ")").otherwise("(")), ""
        )
        plain = F.filter(page["pieces"], lambda piece, i: i % 2 == 1)
        return F.when(turns.rlike(r"\A(?:\(\))*+\z"), plain).otherwise(F.transform(_spans(page["tags"]), body))

    return F.when(html.isNotNull(), bound(F.struct(pieces.alias("pieces"), tags.alias("tags")), bodies))


def first_element(html: Column, tag: str) -> Column:
    """The body of the first element of a kind, NULL without one."""
    return F.get(element_bodies(html, tag), F.lit(0))


def link_addresses(html: Column) -> Column:
    """Addresses of the links with one, in order, quotes off and references decoded."""
    pattern = r"""(?is)<a(?=\s)[^>]*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
    raw = F.regexp_extract_all(html, F.lit(pattern), F.lit(1))
    return F.transform(raw, lambda a: decode_entities(F.regexp_replace(a, r"""(?s)\A(["'])(.*)\1\z""", "$2")))
