"""Token sequences in training order, as files of fixed stride.

The ids of all documents, one after the other, are cut in sequences of one length. A
keyed Feistel permutation of the sequences' numbers gives each a slot; where its
power-of-two domain is larger than the number of sequences, it is walked again
until the slot is inside. A shard holds a range of slots, each at a fixed
stride, so training reads shards front to back and resumes from a slot's number.

The shards' names are in an index, a Parquet table written by Spark: a file that a
lost or repeated task left behind is not in it, and a run that finds an
index writes only the shards that are missing there. The index holds a checksum of
the whole stream, so a folder with the shards of another table is refused.
"""

import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanspark.llm.batches import runs
from gleanspark.llm.files import coalesced, opened
from gleanspark.llm.tokens import END, VOCABULARY, tokenized
from gleanspark.operators.skew import is_small
from gleanspark.workspace import settle

LENGTH = 1024
SHARD_SEQUENCES = 1 << 13
KEY = 0x5EED
ROUNDS = 6
# Documents that the ranks of ids, used to compress them, are counted in.
SAMPLE_ROWS = 1000
INDEX = (
    "shard bigint, file string, first_slot bigint, sequences bigint, crc32 bigint, made string"
)


def _mixed(values: np.ndarray, key: int) -> np.ndarray:
    out = (values + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def feistel(values: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """A permutation of ``range(n)`` applied to ``values``."""
    half = np.uint64(max(1, ((n - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = _mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64), key).tolist()

    def once(x):
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (_mixed(right, k) & mask)
        return (left << half) | right

    out = once(values.astype(np.uint64))
    while (outside := out >= n).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def _placed(tokens: DataFrame) -> DataFrame:
    """Documents with ``at``, the number of ids before them in the whole table.

    The table of tasks has a row for each, and is broadcast if it measures small.
    """
    parts = tokens.groupBy("part").agg(F.sum("n").alias("all"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = settle(
        parts.select("part", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("before")),
        "token-parts",
    )
    if is_small(before):
        before = F.broadcast(before)
    return tokens.join(before, "part").withColumn("at", F.col("before") + F.col("at"))


def _spans(at: np.ndarray, n: np.ndarray, length: int):
    """Where documents are cut: their place, start, length, sequence and offset there."""
    first, last = at // length, (at + n - 1) // length
    count = last - first + 1
    place = np.repeat(np.arange(len(at)), count)
    number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    sequence = first[place] + number
    begin = np.maximum(sequence * length, at[place])
    end = np.minimum((sequence + 1) * length, (at + n)[place])
    return place, begin - at[place], end - begin, sequence, begin - sequence * length


class Squeezer:
    """Makes pieces small on their way to the shards.

    Ids are written by rank of frequency, and high and low bytes apart, as most
    high bytes are then zero. Ranks come from a bounded sample; any do, as they
    only decide how small the pieces get.
    """

    def __init__(self, ranked: bytes):
        self.order = np.frombuffer(ranked, "<u2")
        self.rank = np.empty(1 << 16, "<u2")
        self.rank[self.order] = np.arange(1 << 16)
        self.pack, self.unpack = zstandard.ZstdCompressor(1), zstandard.ZstdDecompressor()

    def squeezed(self, ids: bytes) -> bytes:
        planes = self.rank[np.frombuffer(ids, "<u2")].view(np.uint8).reshape(-1, 2)
        low, high = (self.pack.compress(planes[:, i].tobytes()) for i in (0, 1))
        return len(low).to_bytes(4, "little") + low + high

    def ids(self, data: bytes) -> bytes:
        end = 4 + int.from_bytes(data[:4], "little")
        parts = [self.unpack.decompress(x) for x in (data[4:end], data[end:])]
        planes = np.stack([np.frombuffer(x, np.uint8) for x in parts], axis=1)
        return self.order[np.ascontiguousarray(planes).view("<u2")[:, 0]].tobytes()


def _ranked(tokens: DataFrame) -> bytes:
    """All ids, those frequent in some documents first."""
    counts = np.zeros(1 << 16, np.int64)
    for row in tokens.limit(SAMPLE_ROWS).select("ids").toLocalIterator():
        counts += np.bincount(np.frombuffer(row["ids"], "<u2"), minlength=1 << 16)
    return np.argsort(-counts, kind="stable").astype("<u2").tobytes()


def write_shards(
    df: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    per_shard: int = SHARD_SEQUENCES,
    key: int = KEY,
    vocabulary: str = VOCABULARY,
) -> tuple[DataFrame, DataFrame]:
    """Write the shards under ``path``; the index, and the place of each document's pieces.

    Pieces: ``doc_id, row, start, length, sequence, slot, offset, doc_tokens``.
    Documents come in the order of the table's rows. A null or empty text is the end id alone; the
    last sequence is padded with end ids. Repeated rows are documents of their
    own, null ids stay null, an empty table writes no shard. ``path`` is a
    folder in any file system that executors reach through Arrow.
    """
    spark = df.sparkSession
    tokens = tokenized(df, id_col, text_col, vocabulary)
    total = tokens.agg(F.sum("n")).first()[0] or 0
    n = -(-total // length)
    located = _placed(tokens)
    id_type = dict(df.dtypes)[id_col]

    def cut(with_ids):
        def work(batches):
            squeezer = Squeezer(ranked.value)
            for batch in batches:
                if not batch.num_rows:
                    continue
                counts = batch.column("n").to_numpy()
                spans = _spans(batch.column("at").to_numpy(), counts, length)
                place, start, size, sequence, offset = spans
                slot = feistel(sequence, n, key)
                if with_ids:
                    held = batch.column("ids").to_pylist()
                    cuts = zip(place.tolist(), start.tolist(), size.tolist(), strict=True)
                    ids = [squeezer.squeezed(held[p][2 * s : 2 * (s + m)]) for p, s, m in cuts]
                    out = {
                        "shard": slot // per_shard,
                        "slot": slot,
                        "offset": offset,
                        "ids": pa.array(ids, pa.binary()),
                    }
                else:
                    at = pa.array(place)
                    out = {
                        "doc_id": batch.column("id").take(at),
                        "row": batch.column("row").take(at),
                        "start": start,
                        "length": size,
                        "sequence": sequence,
                        "slot": slot,
                        "offset": offset,
                        "doc_tokens": batch.column("n").take(at),
                    }
                yield pa.RecordBatch.from_pydict(out)

        return work

    ranked = spark.sparkContext.broadcast(_ranked(tokens))
    # Every document's ids and their place in the stream: another table, or another order, differs.
    digest = located.agg(F.bit_xor(F.xxhash64("at", "ids"))).first()[0] or 0
    index_path, mark = f"{path}/index", f"{n} {length} {per_shard} {key} {digest}"
    done = _index(spark, index_path)
    if done is not None and done.where(F.col("made") != mark).limit(1).count():
        raise ValueError("the folder holds shards of another table, key or length")

    def write(batches):
        files, base = opened(f"{path}/shards")
        files.create_dir(base, recursive=True)
        squeezer = Squeezer(ranked.value)
        for rows in runs(batches, "shard"):
            shard = rows.column("shard")[0].as_py()
            name = f"{shard:08d}-{uuid.uuid4().hex[:8]}.bin"
            crc, written = 0, 0
            with files.open_output_stream(f"{base}/{name}") as out:
                offsets = rows.column("offset").to_pylist()
                held = rows.column("ids").to_pylist()
                # The table's last sequence is the only one that may be short.
                for offset, ids in zip([*offsets, 0], [*held, None], strict=True):
                    short = -written % length if offset == 0 else 0
                    block = np.full(short, END, "<u2").tobytes()
                    if ids is not None:
                        block += squeezer.ids(ids)
                    crc = zlib.crc32(block, crc)
                    out.write(block)
                    written += len(block) // 2
            first = shard * per_shard
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": [shard],
                    "file": [name],
                    "first_slot": [first],
                    "sequences": [min(per_shard, n - first)],
                    "crc32": [crc],
                    "made": [mark],
                }
            )

    pieces = located.mapInArrow(cut(True), "shard bigint, slot bigint, offset bigint, ids binary")
    if done is not None:
        pieces = pieces.join(done.select("shard"), "shard", "left_anti")
    dealt = pieces.repartition("shard").sortWithinPartitions("shard", "slot", "offset")
    dealt.mapInArrow(write, INDEX).write.mode("append").parquet(index_path)
    places = located.drop("ids").mapInArrow(
        cut(False),
        f"doc_id {id_type}, row bigint, start bigint, length bigint, sequence bigint, "
        "slot bigint, offset bigint, doc_tokens bigint",
    )
    return spark.read.schema(INDEX).parquet(index_path), places


def _index(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(INDEX).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_sequences(index: DataFrame, path: str, first: int, last: int, length: int = LENGTH) -> DataFrame:
    """``slot`` and ``ids`` of the slots from ``first`` to before ``last``; one read per shard."""

    def read(batches):
        files, base = opened(f"{path}/shards")
        for batch in batches:
            for row in batch.to_pylist():
                begin = max(first, row["first_slot"])
                end = min(last, row["first_slot"] + row["sequences"])
                with files.open_input_file(f"{base}/{row['file']}") as file:
                    held = file.read_at(2 * length * (end - begin), 2 * length * (begin - row["first_slot"]))
                ids = [held[i : i + 2 * length] for i in range(0, len(held), 2 * length)]
                yield pa.RecordBatch.from_pydict(
                    {"slot": list(range(begin, end)), "ids": pa.array(ids, pa.binary())}
                )

    held = (F.col("first_slot") < last) & (F.col("first_slot") + F.col("sequences") > first)
    return index.where(held).mapInArrow(read, "slot bigint, ids binary")


def read_pieces(
    places: DataFrame,
    index: DataFrame,
    path: str,
    length: int = LENGTH,
    per_shard: int = SHARD_SEQUENCES,
) -> DataFrame:
    """The places with ``shard``, ``shard_offset`` (bytes) and ``ids_crc32`` of the ids read there.

    The checksum is over little-endian unsigned 32-bit ids. Each shard is read
    once, front to back.
    """

    def read(batches):
        files, base = opened(f"{path}/shards")
        for rows in runs(batches, "shard"):
            at = rows.column("shard_offset").to_numpy()
            size = 2 * rows.column("length").to_numpy()
            found = []
            reads = coalesced(list(zip(at.tolist(), size.tolist(), strict=True)), 1 << 16, 1 << 23)
            with files.open_input_file(f"{base}/{rows.column('file')[0].as_py()}") as file:
                for offset, bytes_, begin, end in reads:
                    held = file.read_at(bytes_, offset)
                    for i in range(begin, end):
                        own = held[at[i] - offset : at[i] - offset + size[i]]
                        found.append(zlib.crc32(np.frombuffer(own, "<u2").astype("<u4").tobytes()))
            rows = rows.drop_columns(["file"])
            rows = rows.append_column("ids_crc32", pa.array(found, pa.int64()))
            yield from rows.combine_chunks().to_batches()

    shard = F.call_function("div", F.col("slot"), F.lit(per_shard))
    inside = 2 * (length * (F.col("slot") - shard * per_shard) + F.col("offset"))
    rows = places.withColumns({"shard": shard, "shard_offset": inside.cast("bigint")})
    rows = rows.join(index.select("shard", "file"), "shard")
    rows = rows.repartition("shard").sortWithinPartitions("shard", "shard_offset")
    rows = rows.select(*[c for c in rows.columns if c != "file"], "file")
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes if n != "file")
    return rows.mapInArrow(read, schema + ", ids_crc32 bigint")
