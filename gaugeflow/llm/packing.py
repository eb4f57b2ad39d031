"""Sequence packing by best-fit decreasing.

A document's ids are cut into full windows first; the pieces left are packed
longest first, each into the open window with the least room that still holds
it. Which piece of a given length goes where does not change the packing, so
the plan needs only the number of pieces of each length: at most ``capacity``
numbers reach the driver, whatever the corpus size. ``plan_windows`` walks the
lengths downwards and keeps windows of equal room as ranges of window numbers,
found through a segment tree over the remaining capacity. Each size can touch
a range once and splits it at most in three, so the plan is bounded by the
capacity, not by the number of documents. Spark numbers the pieces of a length
and each looks its window up in the plan.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.llm.common import shared_table

# The split pattern of the byte-level vocabulary.
BYTE_BPE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters on which every Unicode version agrees; other texts are encoded whole by the library.
OUTSIDE_STABLE = re.compile(r"[^\t\n\r\x20-\x7e\u00a1-\u024f]")
#: Stretches whose pairs the library merges in less time.
LONG_WORD = re.compile(r"\S{4000}|\s{4000}")
#: Pieces of one length ranked by one task.
RANK_ROWS = 100_000


def byte_characters() -> dict[int, str]:
    """Byte -> the character that stands for it in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the others for U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(other)}


def byte_ranks(tokenizer) -> dict[bytes, int]:
    """Bytes of each piece of a byte-level vocabulary -> its id; added tokens,
    which no plain word gives, left out."""
    plain = {chr_: byte for byte, chr_ in byte_characters().items()}
    added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    return {bytes(map(plain.__getitem__, piece)): i for piece, i in tokenizer.get_vocab().items() if piece not in added}


class ByteBpe:
    """Ids of whole texts under a byte-level BPE file, exactly as the
    tokenizers library gives them with ``add_special_tokens=False``, as
    little-endian unsigned 32-bit bytes.

    The file's pieces are numbered in the order of their merges, so tiktoken
    gives the same ids from the same vocabulary in a fraction of the time. A
    text with characters outside ``OUTSIDE_STABLE``, with an added token's
    string or with a very long word is handed to the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.encoder = tiktoken.Encoding("byte_bpe", pat_str=BYTE_BPE_PATTERN, mergeable_ranks=byte_ranks(self.tokenizer),
                                         special_tokens={})

    def ids(self, text: str) -> bytes:
        if OUTSIDE_STABLE.search(text) or LONG_WORD.search(text) or any(a in text for a in self.added):
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            found = self.encoder.encode_ordinary(text)
        return np.asarray(found, "<u4").tobytes()


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """One encoder for each Python worker."""
    return ByteBpe(path)


def encode_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 0,
                  key_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode each text, append ``end_id`` and cut into windows of ``capacity``
    ids, the last one shorter.

    Columns: the key, ``start``, ``length``, ``ids_crc32``, ``doc_tokens`` and,
    on request, ``ids`` (little-endian unsigned 32-bit bytes). A null or empty
    text is the end id alone; a null key stays null; repeated rows are encoded
    each; other columns are not read.
    """
    key_type = docs.schema[key_col].dataType
    schema = T.StructType([
        T.StructField(key_col, key_type), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType())] + [T.StructField("ids", T.BinaryType())] * with_ids)
    tail, step = np.asarray([end_id], "<u4").tobytes(), capacity * 4

    def run(batches):
        bpe = byte_bpe(tokenizer_path)
        for batch in batches:
            rows, keys = [], []
            for at, text in enumerate(batch.column(1).to_pylist()):
                ids = bpe.ids(text or "") + tail
                for start in range(0, len(ids), step):
                    piece = ids[start:start + step]
                    keys.append(at)
                    rows.append((start // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4)
                                + ((piece,) if with_ids else ()))
            columns = list(zip(*rows)) or [[]] * (len(schema) - 1)
            types = [pa.int64()] * 4 + [pa.binary()] * with_ids
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keys, pa.int64()))]
                + [pa.array(c, t) for c, t in zip(columns, types)], names=schema.names)

    return docs.select(key_col, text_col).mapInArrow(run, schema)


class CapacityTree:
    """Segment tree over remaining capacities 0..n, counting open ranges."""

    def __init__(self, n: int):
        self.leaves = 1 << n.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, change: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += change
            node //= 2

    def tightest(self, need: int) -> int | None:
        """The least room >= ``need`` with an open range."""
        node = need + self.leaves
        if self.count[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def plan_windows(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Best-fit decreasing over ``counts`` (pieces of each length).

    Rows of (length, first rank, number, first window, pieces in each window,
    offset of the first): ranks [first, first + number) of that length fill the
    windows from ``first window`` on. Equal pieces go one after another into
    the tightest window until it is too tight, which is what best fit does.
    """
    tree, open_ranges, plan, next_window = CapacityTree(capacity), defaultdict(list), [], 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            open_ranges[room].append((first, n))
            tree.add(room, 1)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, n = capacity, next_window, -(-left // (capacity // length))
                next_window += n
            else:
                first, n = open_ranges[room].pop()
                tree.add(room, -1)
            each = room // length
            full = min(n, left // each)
            if full:
                plan.append((length, rank, full * each, first, each, capacity - room))
                put(room - each * length, first, full)
            rank, left, first, n = rank + full * each, left - full * each, first + full, n - full
            if n and left and left < each:
                plan.append((length, rank, left, first, left, capacity - room))
                put(room - left * length, first, 1)
                rank, left, first, n = rank + left, 0, first + 1, n - 1
            put(room, first, n)
    return np.asarray(plan, np.int64).reshape(-1, 6)


def pack(pieces: DataFrame, order_cols: list[str], capacity: int = 1024, length_col: str = "length") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``capacity`` ids.

    ``pieces`` is read three times, so pass a stored table. Rows with equal
    ``order_cols`` share a length's ranks in any order; each gets a place of
    its own. An empty table gives an empty result; a piece without a positive
    length up to the capacity raises.
    """
    spark = pieces.sparkSession
    counts = {r[0]: r[1] for r in pieces.groupBy(length_col).count().collect()}  # at most `capacity` rows
    if any(k is None or not 0 < k <= capacity for k in counts):
        raise ValueError(f"pieces must have 1 to {capacity} ids")
    plan = plan_windows(counts, capacity)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    starts = plan[:, 0] * (1 << 50) + plan[:, 1]

    chunks = spark.createDataFrame([(int(k), -(-n // RANK_ROWS)) for k, n in counts.items()],
                                   f"{length_col} long, __chunks long")
    chunked = pieces.join(F.broadcast(chunks), length_col).withColumn(
        "__chunk", F.pmod(F.xxhash64(*order_cols), F.col("__chunks"))).drop("__chunks")
    before = Window.partitionBy(length_col).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (chunked.groupBy(length_col, "__chunk").count()
               .withColumn("__before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count"))
    within = Window.partitionBy(length_col, "__chunk").orderBy(*order_cols)
    ranked = (chunked.withColumn("__rank", F.row_number().over(within))
              .join(offsets, [length_col, "__chunk"])
              .withColumn("__rank", F.col("__rank") + F.col("__before") - 1))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(starts, length.to_numpy() * (1 << 50) + rank.to_numpy(), "right") - 1
        row = plan[at]
        done = rank.to_numpy() - row[:, 1]
        return pd.DataFrame({"sequence_id": row[:, 3] + done // row[:, 4],
                             "offset": row[:, 5] + done % row[:, 4] * length.to_numpy()})

    return (ranked.withColumn("__place", place(F.col(length_col).cast("long"), F.col("__rank").cast("long")))
            .select(*pieces.columns, "__place.sequence_id", "__place.offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 0,
                   key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, cut and pack whole documents; one row for each piece.

    The pieces (no ids) are stored once in the shared folder, because counting
    and placing must see the same rows and encoding is the costly part.
    """
    pieces = shared_table(encode_pieces(docs, tokenizer_path, capacity, end_id, key_col, text_col), "pieces")
    return pack(pieces, [key_col, "start"], capacity)
