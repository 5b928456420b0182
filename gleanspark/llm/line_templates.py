"""Lines that recur across documents, by a log-template tree.

A line goes down a tree of fixed depth: its number of tokens, then its leading
tokens, where a token with a digit counts as a variable. In the leaf the other
tokens are generalised: a token is as frequent as there are lines of the leaf
with it in that place. Those tokens of a line that must be fixed if it is to have
a template, the most frequent ones, say how many lines the template has; any
other is fixed if a good part of as many lines have it, and a variable if not,
so that a field's values stay variables however often each of them is found.
Lines whose fixed tokens agree share a template; a line with too few of them, one
that is mostly variables, or a short one, stands for itself. A template found in ``min_docs`` documents
recurs: its lines stay in the first of these and are dropped from all others.

All of this is counted, not clustered one line after the other, so the result
does not depend on the order of rows, and a common line is added up before it
is shuffled. Only DataFrame functions are used.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.rows import KEYS, beside, free_names, matching, with_key
from gleanspark.workspace import settle

SPACE = r"[\x20\x09\x0B-\x0D]+"
LINE = ["leaf", "one", "two"]


@dataclass(frozen=True)
class Tree:
    """``depth`` leading tokens; lines of fewer than ``least`` tokens recur word for word only.

    Of a longer line at least ``literal_share`` of the tokens must be without a digit,
    and of these at least ``fixed_share`` fixed: found in ``min_docs`` lines, and in
    ``field_share`` as many as the last of these tokens.
    """

    depth: int = 3
    least: int = 5
    literal_share: float = 0.5
    fixed_share: float = 0.7
    field_share: float = 0.5
    min_docs: int = 3


MASK = "<*>"


def _masked(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.when(t.rlike("[0-9]"), F.lit(MASK)).otherwise(t))


def _lines(df: DataFrame, tree: Tree) -> DataFrame:
    """Each line with a token: key, ``line_no`` from 0, ``plain`` text, leaf and two hashes."""
    rows = with_key(df, "id", "text")
    rows = rows.select(*KEYS, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    rows = rows.withColumn("plain", F.trim(F.regexp_replace("line", SPACE, " ")))
    rows = rows.where(F.col("plain") != "").withColumn("tokens", F.split("plain", " "))
    leading = _masked(F.slice("tokens", 1, tree.depth))
    return rows.select(
        *KEYS,
        "line_no",
        "plain",
        F.size("tokens").alias("n"),
        F.xxhash64(F.size("tokens"), leading).alias("leaf"),
        F.xxhash64("plain").alias("one"),
        F.xxhash64(F.lit("two"), "plain").alias("two"),
    )


def _generalised(df: DataFrame, lines: DataFrame, tree: Tree) -> DataFrame:
    """``LINE`` and its template ``t_one, t_two``, for lines whose leaf holds others too."""
    crowded = (
        lines.where(F.col("n") >= tree.least)
        .groupBy("leaf")
        .agg(F.sum("docs").alias("all"), F.count(F.lit(1)).alias("lines"))
        .where((F.col("all") >= tree.min_docs) & (F.col("lines") > 1))
        .select("leaf")
    )
    # One place of each distinct line is enough to read its tokens.
    places = settle(
        lines.join(crowded, "leaf").select(*LINE, "n", "docs", "place.*"), "line-places"
    )
    held = _lines(matching(df, places.select(*KEYS).distinct(), "id", "text"), tree)
    at = places.withColumnsRenamed({k: f"of{k}" for k in [*KEYS, *LINE, "n", "line_no"]})
    there = (
        held[KEYS[0]].eqNullSafe(at[f"of{KEYS[0]}"])
        & (held[KEYS[1]] == at[f"of{KEYS[1]}"])
        & (held["line_no"] == at["ofline_no"])
    )
    # Plain lines are shuffled, as they take a fraction of their tokens' room.
    read = held.join(at, there).select(*LINE, "n", "docs", "plain").dropDuplicates(LINE)
    read = read.withColumn("tokens", _masked(F.split("plain", " ")))
    read = read.withColumn("literals", F.size(F.filter("tokens", lambda t: t != MASK)))
    # A token's spot is its leaf, place and text.
    spot = F.xxhash64("leaf", "pos", "token").alias("spot")
    tokens = settle(
        read.where(F.col("literals") >= tree.literal_share * F.col("n"))
        .select(*LINE, "literals", "docs", F.posexplode("tokens").alias("pos", "token"))
        .where(F.col("token") != MASK)
        .select(*LINE, "literals", "docs", "pos", spot),
        "line-tokens",
    )
    counted = tokens.groupBy("spot").agg(F.sum("docs").alias("all"))
    counted = settle(counted.where(F.col("all") >= tree.min_docs), "counted-tokens")
    found = F.collect_list(F.struct("all", "pos", "spot"))
    kept = tokens.join(counted, "spot").groupBy(*LINE, "literals")
    kept = kept.agg(F.sort_array(found, asc=False).alias("found"))
    # Null if the line has fewer tokens than must be fixed.
    last = F.get("found", F.ceil(tree.fixed_share * F.col("literals")).cast("int") - 1)["all"]
    fixed = F.filter("found", lambda t: t["all"] >= tree.field_share * F.col("last"))
    fixed = F.array_sort(F.transform(fixed, lambda t: F.struct(t["pos"], t["spot"])))
    return (
        kept.withColumn("last", last)
        .where(F.col("last").isNotNull())
        .select(*LINE, fixed.alias("fixed"))
        .select(
            *LINE,
            F.xxhash64(F.lit("template"), "leaf", "fixed").alias("t_one"),
            F.xxhash64(F.lit("template two"), "leaf", "fixed").alias("t_two"),
        )
    )


def recurring_lines(df: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """Key and ``line_no`` of the lines to drop; ``df`` has ``id`` and ``text``."""
    found = settle(_lines(df, tree).drop("plain"), "lines")
    # A document's id, null last, then its text; a line counts once for each.
    order = F.struct(F.col(KEYS[0]).isNull().alias("no_id"), *KEYS, "line_no")
    once = found.groupBy(*LINE, "n", *KEYS).agg(F.min("line_no").alias("line_no"))
    lines = settle(
        once.groupBy(*LINE, "n").agg(F.count(F.lit(1)).alias("docs"), F.min(order).alias("place")),
        "distinct-lines",
    )
    templates = _generalised(df, lines, tree)
    named = settle(
        lines.join(templates, LINE, "left")
        .where((F.col("docs") >= tree.min_docs) | F.col("t_one").isNotNull())
        .select(
            *LINE,
            F.coalesce("t_one", "one").alias("t_one"),
            F.coalesce("t_two", "two").alias("t_two"),
        ),
        "line-templates",
    )
    used = settle(
        found.join(named, LINE).select(*KEYS, "line_no", "t_one", "t_two"), "template-lines"
    )
    doc = F.struct(F.col(KEYS[0]).isNull().alias("no_id"), *KEYS)
    recurring = settle(
        used.groupBy("t_one", "t_two", *KEYS)
        .agg(F.lit(1).alias("seen"))
        .groupBy("t_one", "t_two")
        .agg(F.count(F.lit(1)).alias("docs"), F.min(doc).alias("first"))
        .where(F.col("docs") >= tree.min_docs)
        .select("t_one", "t_two", "first"),
        "recurring",
    )
    later = used.join(recurring, ["t_one", "t_two"]).where(~doc.eqNullSafe(F.col("first")))
    return later.select(*KEYS, "line_no")


def _without(lines: Column, drop: Column) -> Column:
    """The lines between the sorted places in ``drop``."""
    none = F.array(F.lit(-1))
    edges = F.concat(none, drop, F.array(F.size(lines)))
    between = F.transform(
        F.sequence(F.lit(0), F.size(drop)),
        lambda i: F.slice(
            lines, F.get(edges, i) + 2, F.get(edges, i + 1) - F.get(edges, i) - F.lit(1)
        ),
    )
    return F.array_join(F.flatten(between), "\n")


def counted_names(df: DataFrame) -> list[str]:
    """What ``drop_recurring`` calls its counts: ``_lines`` and ``_dropped``, unless ``df`` has them."""
    return free_names(df.columns, "_lines", "_dropped")


def drop_recurring(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tree: Tree = Tree()
) -> DataFrame:
    """All rows and columns; ``text_col`` without the lines that recur, ``_lines`` and ``_dropped``.

    Tokens are runs of anything but ASCII white space. Lines without a token are
    never dropped. A null text stays null and has no line; the empty text has
    one. Of the documents that share a template the first is that with the least
    id, null ids last, ties by text. Rows of equal id and text are one document:
    counted once, and returned alike as often as they come. Columns of ``df`` may have any names
    and stay; a count whose name is taken has one more underscore (``counted_names``).
    """
    wanted = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    drops = recurring_lines(wanted, tree)
    drops = drops.groupBy(*KEYS).agg(F.sort_array(F.collect_set("line_no")).alias("_drop"))
    # Measured, as its estimate would let the plan differ from table to table.
    rows, added = beside(df, settle(drops, "drops"), id_col, text_col, "left")
    drop, lines = F.col(added[-1]), F.split(F.col(text_col), "\n")
    rest = F.when(drop.isNull(), F.col(text_col)).otherwise(_without(lines, drop))
    n_lines, n_dropped = counted_names(df)
    n = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.size(lines)).cast("bigint")
    dropped = F.when(drop.isNull(), F.lit(0)).otherwise(F.size(drop)).cast("bigint")
    return (
        rows.withColumns({n_lines: n, n_dropped: dropped})
        .withColumn(text_col, rest)
        .drop(*added)
    )
