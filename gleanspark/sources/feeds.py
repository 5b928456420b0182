"""Feeds: CSV files with a header, and tables of named tabs."""

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.sources import versions

# The texts a CSV reader takes as missing.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# A feed file is read by one task, so it holds no more records than this.
FILE_RECORDS = 100_000

CSV = {
    "header": True,
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def null_tokens(df: DataFrame, cols: list[str] | None = None, tokens=None) -> DataFrame:
    """Texts that stand for a missing value become null."""
    tokens = NULL_TOKENS if tokens is None else tokens
    cols = _text_columns(df) if cols is None else cols
    return df.withColumns({c: F.when(~F.col(c).isin(tokens), F.col(c)) for c in cols})


def read_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    all_string: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """Read a feed; missing-value texts come back as null.

    Give a schema where it is known: otherwise the files are read twice, and a
    column is whole numbers, numbers or booleans if all of its values are; missing
    ones do not count, days and times stay text. As a record may span lines, each file is read by one task; ``write_feed`` keeps
    files small for that. For a large file whose records never span lines, pass
    ``multi_line=False`` and it is split.
    """
    reader = spark.read.options(**CSV, multiLine=multi_line)
    path = versions.current(spark, path)
    if schema is not None:
        return null_tokens(reader.schema(schema).csv(path))
    texts = null_tokens(reader.csv(path))
    return texts if all_string else inferred(texts)


WHOLE = r"^[ \t]*[+-]?[0-9]+[ \t]*$"

# What a value of a type looks like; Spark's own casts take more.
SHAPES = {
    "int": r"^[ \t]*[+-]?[0-9]{1,9}[ \t]*$",
    "bigint": WHOLE,
    "double": r"^[ \t]*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[ \t]*$",
    "boolean": r"^(true|True|TRUE|false|False|FALSE)$",
}


def inferred(df: DataFrame) -> DataFrame:
    """Text columns as the first type of ``SHAPES`` that all their values have.

    One pass over the table. A column without values stays text, as does one of
    whole numbers of which one is beyond a bigint: as doubles, two of them could
    become one.
    """
    texts = _text_columns(df)
    fits = []
    for i, c in enumerate(texts):
        value = F.col(f"`{c}`")
        known = value.isNotNull()
        for kind, shape in SHAPES.items():
            fit = value.rlike(shape)
            if kind == "bigint":
                fit &= F.trim(value).try_cast("bigint").isNotNull()
            elif kind == "double":
                # All are numbers, not all whole.
                fits.append(F.bool_and(value.rlike(WHOLE)).alias(f"{i} whole"))
            every = F.bool_and(F.when(known, fit))
            fits.append(F.coalesce(every, F.lit(False)).alias(f"{i} {kind}"))
    if not texts:
        return df
    found = df.agg(*fits).first()
    kinds = {
        c: [
            kind
            for kind in SHAPES
            if found[f"{i} {kind}"] and not (kind == "double" and found[f"{i} whole"])
        ]
        for i, c in enumerate(texts)
    }
    typed = {c: F.trim(F.col(f"`{c}`")).cast(kind[0]) for c, kind in kinds.items() if kind}
    return df.withColumns(typed)


def write_feed(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write a feed; null and ``""`` are both an empty field.

    ``mode="overwrite"`` replaces an earlier feed: the new one is written beside it and
    takes its place in one step, so a run that fails leaves the feed as it was, and
    ``df`` may read the feed itself. Read feeds with ``read_feed``, which finds the folder.
    """
    spark = df.sparkSession

    def write(folder: str, mode: str) -> None:
        options = {**CSV, "emptyValue": "", "nullValue": "", "maxRecordsPerFile": FILE_RECORDS}
        df.write.mode(mode).options(**options).csv(folder)

    if mode == "overwrite":
        versions.replace(spark, path, lambda folder: write(folder, "errorifexists"))
    else:
        write(versions.current(spark, path), mode)


def drop_header_rows(df: DataFrame) -> DataFrame:
    """Drop rows that repeat the header: their first column holds its own name.

    Rows with a null first column stay. Read the feed as text: a header does
    not show in a column of numbers.
    """
    first = df.columns[0]
    return df.where(~F.col(first).cast("string").eqNullSafe(F.lit(first)))


def rewrite_without_headers(spark: SparkSession, path: str) -> DataFrame:
    """Replace a feed by itself without its repeated header rows, and read it.

    A run that fails at any step leaves the feed as it was.
    """
    write_feed(drop_header_rows(read_feed(spark, path, all_string=True)), path, mode="overwrite")
    return read_feed(spark, path, all_string=True)


def _blank(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def fill_blank(df: DataFrame) -> DataFrame:
    """Every column as text, null as ``""``."""
    return df.select(*[_blank(F.col(c)).alias(c) for c in df.columns])


# The characters that the names of partition folders escape.
ESCAPED = set('"#%\'*/:=?\\{[]^\x7f') | {chr(c) for c in range(1, 32)}


def _folder(name: str, value: str) -> str:
    if not value:
        raise ValueError(f"the name of a {name} may not be empty")
    return f"{name}=" + "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in value)


def tab_folder(tab: str) -> str:
    return _folder("tab", tab)


def append_tab(df: DataFrame, dest: str, tab: str, batch: str) -> None:
    """Add rows to a tab of the table at ``dest``, creating either if missing.

    Rows are text with ``""`` for null. ``batch`` names this delivery among all
    of the tab: sending the same batch again replaces it, even by no rows, so a
    repeated job adds nothing twice. Deliveries have folders of their own and
    may be written at the same time; ``compact_tab`` puts many together.
    """
    folder = f"{dest}/{_folder('tab', tab)}/{_folder('batch', batch)}"
    fill_blank(df).write.mode("overwrite").parquet(folder)


def _tab_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in [*columns, "tab", "batch"]])


def _packs(dest: str, tab: str) -> str:
    # A name that readers of the whole table pass over.
    return f"{dest}/_packs/{_folder('tab', tab)}"


def _deliveries(spark: SparkSession, dest: str, tab: str) -> dict[str, int]:
    """Deliveries of a tab that have folders of their own, and when each was last written."""
    system, folder = versions.system_of(spark, f"{dest}/{_folder('tab', tab)}")
    if not system.exists(folder):
        return {}
    found = {}
    for status in system.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("batch="):
            files = system.listStatus(status.getPath())
            found[name] = max([status.getModificationTime(), *(f.getModificationTime() for f in files)])
    return found


def _tab_rows(
    spark: SparkSession, dest: str, tab: str, columns: list[str], own: dict[str, int]
) -> DataFrame:
    """The rows of a tab with ``tab`` and ``batch``: its deliveries and its pack.

    A delivery of its own (``own``) stands for all that the pack has of its batch.
    """
    schema = _tab_schema(columns)
    rows = spark.read.schema(schema).parquet(dest).where(F.col("tab") == tab)
    pack = versions.current(spark, _packs(dest, tab))
    if pack == _packs(dest, tab):
        return rows
    packed = spark.read.schema(schema).parquet(pack)
    if own:
        names = [(unquote(name.removeprefix("batch=")),) for name in own]
        packed = packed.join(spark.createDataFrame(names, "batch string"), "batch", "left_anti")
    return rows.unionByName(packed)


def read_tab(spark: SparkSession, dest: str, tab: str, columns: list[str]) -> DataFrame:
    """The rows of one tab; other tabs are not read."""
    own = _deliveries(spark, dest, tab)
    return _tab_rows(spark, dest, tab, columns, own).select(*columns)


def compact_tab(
    spark: SparkSession, dest: str, tab: str, columns: list[str], file_bytes: int = 128 << 20
) -> None:
    """Put the deliveries of a tab together in few files; its rows stay the same.

    The pack keeps the name of each row's delivery, so sending a batch again still
    replaces it: a folder of its own counts for more than the pack, even without rows.
    The pack takes its place in one step, and only then are the folders in it
    deleted, but for those written meanwhile. A run that fails at any step
    changes nothing that is read.
    """
    own = _deliveries(spark, dest, tab)
    if not own:
        return
    path = _packs(dest, tab)
    size = versions.size_of(spark, f"{dest}/{_folder('tab', tab)}")
    before = versions.current(spark, path)
    if before != path:
        size += versions.size_of(spark, before)
    rows = _tab_rows(spark, dest, tab, columns, own)
    files = max(1, -(-size // file_bytes))
    versions.replace(spark, path, lambda folder: rows.repartition(files).write.parquet(folder))
    now = _deliveries(spark, dest, tab)
    for name, written in own.items():
        if now.get(name) == written:
            versions.delete(spark, f"{dest}/{_folder('tab', tab)}/{name}")
