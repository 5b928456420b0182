"""Field extraction from captured pages.

Patterns are regular expressions whose first group is the wanted part; they
are parameters because every site has its own markup. Text that is absent is
``""``, as are attributes; only ``first_present`` tells absent from empty.

An element that may hold others of its name is no regular expression. Where a pattern
is asked for, an ``Element`` may be given instead: the page's tags of that name are then
read in order with a count of how deep they lie.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.functions.text import GAP, MARKUP, clean_html, decode_entities, let, norm_ws


@dataclass(frozen=True)
class Element:
    """Elements ``tag`` with all they contain, if ``opening`` is found in their opening tag.

    A tag that is never closed ends with the page. Comments, scripts and styles are no
    part of it; other tags may be left open without harm.
    """

    tag: str
    opening: str = ""

    @property
    def name(self) -> str:
        """What its tags begin with."""
        return rf"(?i)</?{self.tag}[\s/>]"


# A tag, as ``text.MARKUP`` has it; what stands before each while a page is divided.
TAG = r"""<[a-zA-Z/!?][^>=]*+(?:=\s*+(?:"[^"]*"|'[^']*')?[^>=]*+)*+>"""
MARK = "\ufffe"

# What may hold tags that are none.
HIDDEN = r"(?s)<(?:!--.*?-->|((?i:script|style|template))\b[^>]*>.*?(?:</(?i:\1)[^>]*>|\z))"

# Tags whose depths are added up at once: a longer list is added up block by block.
_BLOCK = 256


def _sums(numbers: Column) -> Column:
    """The sum of each number and all before it."""

    def within(block: Column) -> Column:
        start = F.array(F.lit(0))
        step = lambda seen, n: F.concat(seen, F.array(F.element_at(seen, -1) + n))
        return F.aggregate(block, start, step)

    def all_blocks(local: Column) -> Column:
        before = within(F.transform(local, lambda sums: F.element_at(sums, -1)))
        return F.flatten(
            F.transform(
                local,
                lambda sums, i: F.transform(
                    F.slice(sums, F.lit(2), F.lit(_BLOCK)), lambda n: n + F.get(before, i)
                ),
            )
        )

    starts = F.sequence(F.lit(1), F.greatest(F.size(numbers), F.lit(1)), F.lit(_BLOCK))
    local = F.transform(starts, lambda at: within(F.slice(numbers, at, F.lit(_BLOCK))))
    return let(local, all_blocks)


def _spans(pieces: Column, element: Element) -> Column:
    """Where matching elements begin and end among pieces that begin with a tag.

    An opening and a closing tag of one depth alternate, so in the order of depth and
    place each opening tag stands before the tag that closes it.
    """

    def kind(piece: Column) -> Column:
        head = F.substring(piece, 1, len(element.tag) + 3)
        closes = piece.startswith("</")
        return F.when(head.rlike("^" + element.name), F.when(closes, -1).otherwise(1)).otherwise(0)

    def tags(kinds: Column, depths: Column) -> Column:
        listed = F.transform(
            kinds,
            lambda kind, i: F.struct(
                F.when(kind < 0, F.get(depths, i) + 1).otherwise(F.get(depths, i)).alias("depth"),
                i.alias("at"),
                kind.alias("kind"),
            ),
        )
        return F.array_sort(F.filter(listed, lambda tag: tag.kind != 0))

    def closed(sorted_tags: Column) -> Column:
        def span(tag: Column, i: Column) -> Column:
            after = F.get(sorted_tags, i + 1)
            ends = (after.depth == tag.depth) & (after.kind < 0)
            end = F.when(ends, after["at"]).otherwise(F.size(pieces))
            return F.struct(tag["at"].alias("at"), end.alias("end"), tag.kind.alias("kind"))

        return F.transform(sorted_tags, span)

    found = let(
        F.transform(pieces, kind),
        lambda kinds: let(_sums(kinds), lambda depths: let(tags(kinds, depths), closed)),
    )

    def wanted(span: Column) -> Column:
        if not element.opening:
            return span.kind > 0
        tag = F.regexp_extract(F.get(pieces, span["at"]), "^" + TAG, 0)
        return (span.kind > 0) & tag.rlike(element.opening)

    return F.array_sort(F.filter(found, wanted))


def elements(
    html: Column, element: Element, inner: bool = False, only_first: bool = False
) -> Column:
    """Every matching element, outer ones before those they contain; ``inner`` without its tags.

    The tags of a page are read once, in time that hardly grows faster than their number.
    """
    tag = "^" + TAG

    def cut(pieces: Column) -> Column:
        def whole(span: Column) -> Column:
            body = F.array_join(F.slice(pieces, span["at"] + 1, span.end - span["at"]), "")
            if inner:
                return F.regexp_replace(body, tag, "")
            # What closes it is the beginning of the next piece.
            return F.concat(
                body, F.regexp_extract(F.coalesce(F.get(pieces, span.end), F.lit("")), tag, 0)
            )

        spans = _spans(pieces, element)
        return F.transform(F.slice(spans, 1, 1) if only_first else spans, whole)

    plain = F.regexp_replace(F.replace(html, F.lit(MARK), F.lit("")), HIDDEN, "")
    pieces = F.split(F.regexp_replace(plain, f"({TAG})", f"{MARK}$1"), MARK)
    has_one = html.rlike(element.name)
    none = F.array().cast("array<string>")
    return F.when(has_one, let(pieces, cut)).otherwise(F.when(html.isNotNull(), none))


def extract_text(html: Column, pattern: str | Element) -> Column:
    """Text of the first element that matches, ``""`` if none does."""
    if isinstance(pattern, Element):
        return F.when(html.isNotNull(), F.coalesce(if_present(html, pattern), F.lit("")))
    return clean_html(F.regexp_extract(html, pattern, 1))


def extract_attr(html: Column, tag: str, attr: str) -> Column:
    """Attribute of the first such tag, ``""`` if there is none.

    The value may be in double quotes, single quotes or none.
    """
    pattern = rf"""(?i)<{tag}\b[^>]*?\s{attr}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    value = F.regexp_extract(html, pattern, 1)
    return decode_entities(F.regexp_replace(value, "^[\"']|[\"']$", ""))


def absolute_url(base: Column, href: Column) -> Column:
    """Where a link on the page ``base`` leads, as a browser reports it.

    Characters are not percent-encoded. Null stays null.
    """
    page = F.regexp_replace(base, r"#.*$", "")
    origin = F.regexp_extract(base, r"^[^:/?#]+://[^/?#]*", 0)
    folder = F.regexp_extract(page, r"^[^:/?#]+://[^/?#]*(/(?:[^?#]*/)?)", 1)

    def resolve(link: Column) -> Column:
        path = F.when(link.startswith("/"), link).otherwise(
            F.concat(F.coalesce(F.nullif(folder, F.lit("")), F.lit("/")), link)
        )
        return (
            F.when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), link)
            .when(link == "", page)
            .when(link.startswith("//"), F.concat(F.regexp_extract(base, "^[^:]+:", 0), link))
            .when(link.startswith("#"), F.concat(page, link))
            .when(link.startswith("?"), F.concat(F.regexp_replace(page, r"\?.*$", ""), link))
            .otherwise(F.concat(origin, let(path, _without_dots)))
        )

    return let(F.regexp_replace(href, r"^\s+|\s+$", ""), resolve)


def _without_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` in the part before the query."""
    head = F.regexp_extract(path, r"^[^?#]*", 0)
    tail = F.substring(path, F.length(head) + 1, F.lit(2**31 - 1))
    steps = F.split(F.substring(head, 2, 2**31 - 1), "/")

    def step(seen: Column, name: Column) -> Column:
        above = F.slice(seen, F.lit(1), F.greatest(F.size(seen) - 1, F.lit(0)))
        return (
            F.when(name == ".", seen)
            .when(name == "..", above)
            .otherwise(F.concat(seen, F.array(name)))
        )

    kept = F.aggregate(steps, F.array().cast("array<string>"), step)
    # A path that ends in a dot step ends in a slash.
    slash = F.when(head.rlike(r"/\.\.?$") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    resolved = F.concat(F.lit("/"), F.array_join(kept, "/"), slash, tail)
    return F.when(head.rlike(r"/\.\.?(/|$)"), resolved).otherwise(path)


def extract_all(html: Column, pattern: str | Element, group: int = 1) -> Column:
    """Every match in page order, markup kept; group 0 of an ``Element`` has its own tags."""
    if isinstance(pattern, Element):
        return elements(html, pattern, inner=group > 0)
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(group))


def _clean_once(html: Column) -> Column:
    """``clean_html`` for use in lambdas, where nothing is shared unless it is bound."""
    bare = let(F.regexp_replace(html, MARKUP, GAP), decode_entities)
    return norm_ws(F.replace(bare, F.lit(GAP), F.lit("")))


def extract_texts(html: Column, pattern: str | Element) -> Column:
    """Text of every element that matches, in page order."""
    if isinstance(pattern, Element):
        return F.transform(extract_all(html, pattern), _clean_once)
    return F.transform(extract_all(html, pattern), clean_html)


def first_non_empty(*cols: Column) -> Column:
    """Go on while the value is ``""``."""
    return F.coalesce(*[F.nullif(col, F.lit("")) for col in cols], F.lit(""))


def if_present(html: Column, pattern: str | Element) -> Column:
    """Text of the element, null if absent, ``""`` if empty."""
    if isinstance(pattern, Element):
        found = elements(html, pattern, inner=True, only_first=True)
        return F.get(F.transform(found, _clean_once), F.lit(0))
    return F.when(html.rlike(pattern), extract_text(html, pattern))


def first_present(*cols: Column, default: str | None = None) -> Column:
    """Stop at the first that is there, even if it is empty."""
    return F.coalesce(*cols, F.lit(default).cast("string"))


def first_non_empty_list(*cols: Column) -> Column:
    candidates = [let(col, lambda items: F.when(F.size(items) > 0, items)) for col in cols]
    return F.coalesce(*candidates, F.array().cast("array<string>"))


def or_sentinel(col: Column, sentinel: str) -> Column:
    return F.coalesce(col, F.lit(sentinel))


def explode_elements(df: DataFrame, html: str, pattern: str | Element, keep: list[str]) -> DataFrame:
    """One row per matching element: ``keep``, ``pos`` from 0, ``element``.

    Only the kept columns travel on, so the page itself stays behind.
    """
    elements = extract_all(F.col(html), pattern, 0)
    return df.select(*keep, F.posexplode(elements).alias("pos", "element"))
