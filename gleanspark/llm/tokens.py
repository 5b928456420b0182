"""Token ids of documents under a public byte-level vocabulary."""

import json
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.batches import as_bytes, lots
from gleanspark.workspace import fresh_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
# The id after each document.
END = 0
# A space that begins a token whatever stands before it, and one that may not.
_CUT = re.compile(r" (?=\S)")
_UNSAFE = re.compile(r" \s")
# Characters of text that are worked on at once; more of them take a worker's memory
# and gain little time.
_LOT = 2 << 20
# Words that are encoded as one text.
_RUN = 500


class Encoder:
    """Ids as the ``tokenizers`` library gives them, special tokens as ordinary text.

    ``tiktoken`` merges by the same vocabulary several times as fast. Should it
    fail on a text, the library itself encodes it.
    """

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            tokens = json.load(file)["model"]["vocab"]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in printable}
        byte |= {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*printable}))}
        ranks = {
            bytes(map(byte.__getitem__, token)): rank
            for token, rank in tokens.items()
            if all(c in byte for c in token) and not token.startswith("<|")
        }
        self.sizes = np.zeros(1 << 16, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)
        self.fast = tiktoken.Encoding(
            "bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.slow = None

    def ids(self, text: str) -> list[int]:
        try:
            return self.fast.encode_ordinary(text)
        except BaseException as error:
            # The pattern engine panics on some very long runs; nothing else may be caught.
            if type(error).__name__ != "PanicException":
                raise
        if self.slow is None:
            self.slow = tokenizers.Tokenizer.from_file(self.path)
            self.slow.encode_special_tokens = True
        return self.slow.encode(text, add_special_tokens=False).ids


class WordEncoder:
    """The ids of many texts at once; a space and its word are encoded once and remembered.

    The vocabulary's pattern begins a token at each space before another character,
    and what is left of that space does not depend on what follows. So the ids of a
    text are those of its first word and of each space with the word after it.
    At most ``remembered`` words and ``32 * _LOT`` of their bytes are kept.
    """

    def __init__(self, path: str, remembered: int = 600_000):
        self.encoder, self.remembered = Encoder(path), remembered
        self.clear()

    def clear(self):
        self.numbers: dict[str, int] = {}
        self.size = 0
        # By word: its ids' place in ``flat`` and their number.
        self.begin, self.n = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.flat = np.zeros(0, "<u2")

    def learn(self, words: list[str], sizes: np.ndarray):
        """Remember words that are new, of ``sizes`` bytes; none is empty or begins with white space."""
        encode = self.encoder.ids
        texts = (" " + " ".join(words[i : i + _RUN]) for i in range(0, len(words), _RUN))
        ids = np.concatenate([np.array(encode(text), "<u2") for text in texts])
        ends, stops = np.cumsum(self.encoder.sizes[ids]), np.cumsum(sizes + 1)
        n = np.diff(np.searchsorted(ends, stops, "right"), prepend=0)
        self.numbers.update(zip(words, range(len(self.n), len(self.n) + len(words)), strict=True))
        begin = len(self.flat) + np.cumsum(n) - n
        self.begin = np.concatenate([self.begin, begin.astype(np.int32)])
        self.n = np.concatenate([self.n, n.astype(np.int32)])
        self.flat = np.concatenate([self.flat, ids])
        self.size += int(stops[-1])

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as unsigned 16-bit little-endian numbers."""
        out: list[list[bytes]] = [[] for _ in texts]
        lot, size = [], 0
        for i, text in enumerate(texts):
            for piece in _pieces(text):
                lot.append((i, piece))
                size += len(piece)
                if size >= _LOT:
                    self._encoded(lot, out)
                    lot, size = [], 0
        self._encoded(lot, out)
        return [b"".join(x) for x in out]

    def _encoded(self, lot: list[tuple[int, str]], out: list[list[bytes]]):
        if not lot:
            return
        if len(self.numbers) >= self.remembered or self.size >= 32 * _LOT:
            self.clear()
        # Arrow splits the texts in which every space is such a one.
        plain = [x for x in lot if not (x[1].endswith(" ") or _UNSAFE.search(x[1]))]
        other = [x for x in lot if x[1].endswith(" ") or _UNSAFE.search(x[1])]
        split = pc.split_pattern(pa.array([x for _, x in plain], pa.large_string()), " ")
        cut = [_CUT.split(x) for _, x in other]
        count = np.concatenate(
            [pc.list_value_length(split).to_numpy(), np.array(list(map(len, cut)), np.int64)]
        ).astype(np.int64)
        words = pa.concat_arrays(
            [split.flatten(), pa.array(list(chain.from_iterable(cut)), pa.large_string())]
        )
        begin = np.cumsum(count) - count
        later = np.ones(len(words), bool)
        later[begin] = False
        first = words.take(pa.array(begin)).to_numpy(zero_copy_only=False).tolist()
        coded = words.filter(pa.array(later)).dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        number = np.fromiter(
            map(self.numbers.get, distinct.tolist(), repeat(-1)), np.int64, len(distinct)
        )
        fresh = np.flatnonzero(number < 0)
        if len(fresh):
            number[fresh] = np.arange(len(self.n), len(self.n) + len(fresh))
            self.learn(distinct[fresh].tolist(), pc.binary_length(coded.dictionary).to_numpy()[fresh])
        found = number[coded.indices.to_numpy()]
        n = self.n[found]
        stops = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(stops[-1]) + np.repeat(self.begin[found] - stops[:-1], n)
        ids = self.flat[at].tobytes()
        edges = (2 * stops[np.concatenate([[0], np.cumsum(count - 1)])]).tolist()
        for (i, _), word, low, high in zip(
            plain + other, first, edges, edges[1:], strict=False
        ):
            out[i] += [np.array(self.encoder.ids(word), "<u2").tobytes(), ids[low:high]]


def _pieces(text: str, size: int = _LOT) -> Iterator[str]:
    """A long text in pieces that can be encoded one by one."""
    begin = 0
    while len(text) - begin > size:
        cut = _CUT.search(text, begin + size)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


def tokenized(df: DataFrame, id_col: str, text_col: str, path: str = VOCABULARY) -> DataFrame:
    """A written table: ``id``, a unique ``row``, ``n`` ids and the ids, ``END`` last.

    ``part`` is the task that wrote a row, and ``at`` the number of its ids before. The
    ids are unsigned 16-bit numbers, little-endian. Null text is empty, so
    its document is ``END`` alone. Written once, as nothing else here costs as much.
    """
    wanted = df.select(
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        as_bytes(text_col).alias("text"),
    )

    def work(batches):
        encoder, total = WordEncoder(path), 0
        end = np.array([END], "<u2").tobytes()
        for batch in (lot for whole in batches for lot in lots(whole, "text", _LOT)):
            texts = [(x or b"").decode("utf-8", "replace") for x in batch.column("text").to_pylist()]
            found = [x + end for x in encoder.ids(texts)]
            n = np.array([len(x) // 2 for x in found], np.int64)
            at = total + np.cumsum(n) - n
            total += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("row"),
                    pa.array(batch.column("row").to_numpy() >> 33),
                    pa.array(at),
                    pa.array(n),
                    pa.array(found, pa.binary()),
                ],
                names=["id", "row", "part", "at", "n", "ids"],
            )

    schema = (
        f"id {dict(df.dtypes)[id_col]}, row bigint, part bigint, at bigint, n bigint, ids binary"
    )
    path_out = fresh_path(df.sparkSession, "tokens")
    options = {
        "compression": "zstd",
        "parquet.compression.codec.zstd.level": "9",
        # Large pages, as ids repeat over long distances.
        "parquet.page.size": str(8 * 1024 * 1024),
        "parquet.page.row.count.limit": "1000000",
    }
    wanted.mapInArrow(work, schema).write.options(**options).parquet(path_out)
    return df.sparkSession.read.schema(schema).parquet(path_out)
