"""Rows of a document table, told apart by id and text."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.operators.skew import is_small

KEYS = ["_key_id", "_key_text"]


def free_names(columns: list[str], *names: str) -> list[str]:
    """Each name with as many underscores before it as it needs to be none of ``columns``."""
    taken = {c.lower() for c in columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        found.append(name)
    return found


def key(id_col: str, text_col: str, names: list[str] = KEYS) -> list[Column]:
    """The key of a document, its id and a hash of its text, as columns ``names``."""
    return [F.col(id_col).alias(names[0]), F.xxhash64(F.col(text_col)).alias(names[1])]


def with_key(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Add the key of a document; for tables without columns of these names."""
    return df.select("*", *key(id_col, text_col))


def same_key(left: DataFrame, right: DataFrame):
    """Equal keys; a null id equals a null id."""
    return left[KEYS[0]].eqNullSafe(right[KEYS[0]]) & (left[KEYS[1]] == right[KEYS[1]])


def beside(
    df: DataFrame, found: DataFrame, id_col: str, text_col: str, how: str
) -> tuple[DataFrame, list[str]]:
    """``df`` joined with ``found`` on the key, and the names of the columns that are added.

    ``found`` has the columns ``KEYS`` and others, whose names are kept, but for underscores
    before one that ``df`` has too; it is broadcast only if measured small.
    """
    columns = found.columns
    names = free_names(df.columns, *KEYS, *columns)
    own, others = names[: len(KEYS)], names[len(KEYS) :]
    if is_small(found):
        found = F.broadcast(found)
    found = found.toDF(*others)
    keyed = df.select("*", *key(id_col, text_col, own))
    of_id, of_text = (others[columns.index(k)] for k in KEYS)
    same = F.col(own[0]).eqNullSafe(F.col(of_id)) & (F.col(own[1]) == F.col(of_text))
    return keyed.join(found, same, how), names


def matching(
    df: DataFrame, keys: DataFrame, id_col: str, text_col: str, how: str = "left_semi"
) -> DataFrame:
    """The rows of ``df`` whose key is (``left_anti``: is not) in ``keys``, columns unchanged.

    ``keys`` has the columns ``KEYS``. It is broadcast only if measured small. Columns of ``df``
    may have any names.
    """
    joined, names = beside(df, keys.select(*KEYS), id_col, text_col, how)
    return joined.drop(*names[: len(KEYS)])
