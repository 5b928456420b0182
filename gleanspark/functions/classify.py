"""Rules that sort listing snippets into salary, work mode, type and place."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanspark.functions.text import drop_blank, let, strip_bullet

# Currency signs, price pattern and work modes.
CURRENCY = "[$€£]"
PRICE = r"(?U)[$€£]\d*,?\.?\d*"
WORK_MODES = ["On-site", "Hybrid", "Remote"]
HEADER_MODES = ["Remote", "Hybrid work"]


def has_currency(col: Column) -> Column:
    return col.rlike(CURRENCY)


def _list(items: Column) -> Column:
    return F.coalesce(items, F.array().cast("array<string>"))


def _last(items: Column) -> Column:
    return F.coalesce(F.try_element_at(items, F.lit(-1)), F.lit(""))


def classify_preferences(items: Column) -> Column:
    """Struct ``salary, remote, job_type``; the last item of a class wins.

    A currency sign makes a salary, an exact work mode is the remote field and
    anything else is the type. Blank items do not count; missing is ``""``.
    """

    def split(kept: Column) -> Column:
        return F.struct(
            _last(F.filter(kept, has_currency)).alias("salary"),
            _last(F.filter(kept, lambda x: x.isin(WORK_MODES))).alias("remote"),
            _last(F.filter(kept, lambda x: ~has_currency(x) & ~x.isin(WORK_MODES))).alias(
                "job_type"
            ),
        )

    return let(drop_blank(_list(items)), split)


def split_salary_type(items: Column) -> Column:
    """Struct ``salary_text, job_type`` by the number of items.

    Two items are salary and type with no look at the currency; otherwise the
    first item alone decides.
    """

    def split(found: Column) -> Column:
        first, second = F.get(found, F.lit(0)), F.get(found, F.lit(1))
        two = F.size(found) == 2
        return F.struct(
            F.when(two | has_currency(first), first).alias("salary_text"),
            F.when(two, strip_bullet(second))
            .when(~has_currency(first), first)
            .alias("job_type"),
        )

    return let(_list(items), split)


def normalise_salary(col: Column) -> Column:
    """Two prices give ``a - b``, any other number the first, none null.

    A price takes one separator only: ``$1,234,567.89`` gives ``$1,234``.
    """
    return let(
        F.regexp_extract_all(col, F.lit(PRICE), F.lit(0)),
        lambda prices: F.when(
            F.size(prices) == 2, F.concat_ws(" - ", prices)
        ).otherwise(F.get(prices, F.lit(0))),
    )


def resolve_location(header: Column, company: Column) -> Column:
    """Struct ``location, remote`` from the header entries of a posting.

    The first entry holding the company name goes (an empty name is in every
    entry, so the first one goes); then the first ``Remote``, or failing that
    ``Hybrid work``, is the remote field; the last entry left is the location.
    """

    def without_company(entries: Column) -> Column:
        hit = F.array_position(F.transform(entries, lambda x: F.contains(x, company)), F.lit(True))
        return let(hit, lambda at: F.filter(entries, lambda x, i: i != at - 1))

    def split(entries: Column) -> Column:
        mode = F.coalesce(
            *[F.when(F.array_contains(entries, F.lit(m)), F.lit(m)) for m in HEADER_MODES]
        )
        at = F.coalesce(F.array_position(entries, mode), F.lit(0))
        rest = F.filter(entries, lambda x, i: i != at - 1)
        return F.struct(
            _last(rest).alias("location"), F.coalesce(mode, F.lit("")).alias("remote")
        )

    return let(let(_list(header), without_company), split)
