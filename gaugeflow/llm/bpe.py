"""BPE encoding and decoding through a table of distinct words.

Texts are split into words inside Spark. A run of documents within one task is
a *block*: its distinct words are numbered in order of appearance and each
document becomes the list of its words' numbers. Both are stored in one table,
so later steps agree on the numbers whatever is recomputed. The words of all
blocks are brought together, each distinct word is encoded once, its ids go
back to the blocks' numbers, and a block's documents take them by position.
Decoding joins ids to the vocabulary's pieces.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.llm.common import bucketed_table

# The split pattern of the word-level vocabulary.
WORD_BPE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters on which every Unicode version agrees, already in composed form.
OUTSIDE_STABLE = re.compile(r"[^\t\n\r\x20-\x7e\u00a1-\u024f]")
#: Characters after which a block is closed; a block holds whole documents.
BLOCK_CHARS = 48_000_000
#: Encoded words that a task holds back to send those of a block together.
HELD_ROWS = 50_000


class WordSplitter:
    """A text's words as the word-level BPE file splits them: composed form,
    lower case, white space dropped. Texts with characters outside
    ``OUTSIDE_STABLE`` go through the library's own normalizer and splitter.
    Strings of added tokens are words of their own, taken before lower-casing.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.find = regex.compile(WORD_BPE_PATTERN).findall
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None

    def plain(self, text: str) -> bool:
        """Whether the text's words are those of its parts between white space."""
        return not (OUTSIDE_STABLE.search(text) or self.added is not None and self.added.search(text))

    def words(self, text: str) -> list[str]:
        if self.added is None or not self.added.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self.added.finditer(text):
            out += self._plain(text[at:m.start()]) + [m[0]]
            at = m.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[str]:
        if not OUTSIDE_STABLE.search(text):
            return self.find(text.lower())
        normal = self.tokenizer.normalizer.normalize_str(text)
        return [normal[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]


class Block:
    """A block's word numbers. ``parts`` keeps, for the text between two white
    spaces, the numbers of its words as varints."""

    def __init__(self, split: WordSplitter):
        self.split, self.slots, self.parts, self.chars = split, {}, {}, 0

    def code(self, text: str) -> bytes:
        self.chars += len(text)
        if not self.split.plain(text):
            return b"".join(map(self._number, self.split.words(text)))
        parts, out = self.parts, text.split()
        for part in set(out).difference(parts):
            parts[part] = (self._number(part.lower()) if part.isalpha() else
                           b"".join(map(self._number, self.split.words(part))))
        return b"".join(map(parts.__getitem__, out))

    def _number(self, word: str) -> bytes:
        return to_varint(self.slots.setdefault(word, len(self.slots)))


@lru_cache(maxsize=2)
def splitter(path: str) -> WordSplitter:
    return WordSplitter(path)


@lru_cache(maxsize=2)
def word_encoder(path: str):
    """The file's tokenizer without its normalizer: words are normal already,
    and added tokens' strings still give their ids."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "truncation": None, "padding": None}))


def vocabulary(spark, path: str) -> DataFrame:
    """(id, piece) of the file: bounded by the vocabulary, not by the data."""
    pieces = word_encoder(path).get_vocab(with_added_tokens=True)
    return spark.createDataFrame(pd.DataFrame({"id": list(pieces.values()), "piece": list(pieces)}),
                                 "id int, piece string")


def to_varint(n: int) -> bytes:
    """Little-endian base-128 number: small ones take one byte."""
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def from_varints(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(b < 128)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    out = np.zeros(len(last), np.int64)
    for k in range(5):
        at = first + k
        more = at <= last
        if not more.any():
            break
        out[more] |= (b[at[more]].astype(np.int64) & 127) << (7 * k)
    return out


def split_blocks(docs: DataFrame, path: str, key_col: str = "doc_id", text_col: str = "text",
                 block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Documents as numbered words. Rows with a ``word`` say that in ``block``
    the word has number ``slot``; rows with ``slots`` are documents: their
    words' numbers in order, as varints. Null texts are empty."""
    key_type = docs.schema[key_col].dataType
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("slot", T.IntegerType()),
                           T.StructField("word", T.StringType()), T.StructField(key_col, key_type),
                           T.StructField("slots", T.BinaryType())])

    def words_of(block, slots):
        n, words = len(slots), pa.array(list(slots), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([block] * n, pa.int64()), pa.array(np.arange(n), pa.int32()), words,
             pa.nulls(n, arrow_key), pa.nulls(n, pa.binary())], names=schema.names)

    def run(batches):
        number, block = TaskContext.get().partitionId() << 10, Block(splitter(path))  # under 2**31 for 2 million tasks
        for batch in batches:
            coded, at, keys = [], 0, batch.column(0)

            def documents(upto):
                n = upto - at
                return pa.RecordBatch.from_arrays(
                    [pa.array([number] * n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()),
                     keys.slice(at, n).cast(arrow_key), pa.array(coded, pa.binary())], names=schema.names)

            for i, text in enumerate(batch.column(1)):
                coded.append(block.code(text.as_py() or ""))
                if block.chars >= block_chars:
                    yield documents(i + 1)
                    yield words_of(number, block.slots)
                    number, block, coded, at = number + 1, Block(splitter(path)), [], i + 1
            yield documents(batch.num_rows)
        if block.slots:
            yield words_of(number, block.slots)

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_key = to_arrow_type(key_type)
    return docs.select(key_col, text_col).mapInArrow(run, schema)


def encode_words(used: DataFrame, path: str) -> DataFrame:
    """(``block``, ``slot``, ``word``) -> (``of``, ``coded``): rows of a block
    with entries of some of its words, as varints: the word's number in the
    block, the number of its ids, the ids.

    One shuffle brings a word's rows of all blocks together in order, so that
    the distinct word is encoded once and its ids go back to every block.
    """
    def run(batches):
        encoder, last, held, rows = word_encoder(path), {}, defaultdict(bytearray), 0

        def send():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.int64()), pa.array([bytes(c) for c in held.values()], pa.binary())],
                names=["of", "coded"])

        for batch in batches:
            words = batch.column(1).dictionary_encode()
            distinct = words.dictionary.to_pylist()
            new = [w for w in distinct if w not in last]
            found = dict(zip(new, encoder.encode_batch_fast(new, add_special_tokens=False)))
            ids = [last[w] if w in last else b"".join(map(to_varint, [len(found[w].ids), *found[w].ids])) for w in distinct]
            last = {distinct[-1]: ids[-1]} if distinct else last
            refs = batch.column(0).to_numpy()
            for block, slot, w in zip((refs >> 32).tolist(), (refs & 0xFFFFFFFF).tolist(), words.indices.to_pylist()):
                held[block] += to_varint(slot) + ids[w]
            rows += batch.num_rows
            if rows >= HELD_ROWS:
                yield send()
                held, rows = defaultdict(bytearray), 0
        if held:
            yield send()

    ref = F.shiftleft("block", 32).bitwiseOR(F.col("slot").cast("long")).alias("ref")
    together = used.select(ref, "word").repartition("word").sortWithinPartitions("word")
    return together.mapInArrow(run, "of long, coded binary")


def decode_ids(ids: DataFrame, key_cols: list[str], pieces: DataFrame) -> DataFrame:
    """Rows of (keys, ``pos``, ``id``) joined to (id, piece): the keys and the
    ``text`` of their pieces in order, separated as the file's missing decoder
    does, by one space. Ids without a piece give nothing."""
    joined = ids.join(F.broadcast(pieces), "id")  # the vocabulary has a fixed size
    return (joined.groupBy(*key_cols)
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "piece"))),
                                          lambda x: x["piece"]), " ").alias("text")))


def encode_documents(docs: DataFrame, path: str, key_col: str = "doc_id", text_col: str = "text",
                     block_chars: int = BLOCK_CHARS, digests: bool = False) -> DataFrame:
    """Encode and decode whole texts through the distinct-word table.

    Columns: the key, ``n_tokens``, and ``ids`` (array) with ``decoded``; with
    ``digests`` their SHA-256 instead, ``ids_sha256`` over the ids as
    little-endian unsigned 32-bit integers and ``decoded_sha256`` over UTF-8.
    A null text is empty: no ids, empty decoded text. Repeated rows and null
    keys give a row each; an empty table an empty result.
    """
    spark = docs.sparkSession
    blocks = bucketed_table(split_blocks(docs, path, key_col, text_col, block_chars), "block", "blocks")
    placed = encode_words(blocks.where(F.col("word").isNotNull()), path)
    texts = blocks.where(F.col("slots").isNotNull()).select("block", key_col, "slots")

    pieces = spark.sparkContext.broadcast(
        vocabulary(spark, path).toPandas().set_index("id")["piece"].to_dict())
    outputs = ([T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
               if digests else
               [T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("decoded", T.StringType())])
    schema = T.StructType([T.StructField(key_col, docs.schema[key_col].dataType),
                           T.StructField("n_tokens", T.LongType()), *outputs])

    def compose(documents: pa.Table, words: pa.Table) -> pa.Table:
        piece = pieces.value
        flat = from_varints(b"".join(words.column("coded").to_pylist()))
        entries, size, i = flat.tolist(), 0, 0
        places, spellings = {}, {}
        while i < len(entries):
            slot, n = entries[i], entries[i + 1]
            places[slot] = (i + 2, n)
            spellings[slot] = " ".join([piece[k] for k in entries[i + 2:i + 2 + n]])  # the id-to-piece join
            i, size = i + 2 + n, max(size, slot + 1)
        begins, counts = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for slot, (begin, n) in places.items():
            begins[slot], counts[slot] = begin, n
        rows = []
        for slots in documents.column("slots"):
            at = from_varints(slots.as_py())
            n = counts[at]
            total = int(n.sum())
            ids = flat[np.repeat(begins[at] - (np.cumsum(n) - n), n) + np.arange(total)]
            text = " ".join([spellings[i] for i in at[n > 0].tolist()])
            rows.append((total, hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                         hashlib.sha256(text.encode()).hexdigest()) if digests else
                        (total, ids, text))
        # keys stay in Arrow: beside a null, pandas would make doubles of them
        types = [pa.int64(), *([pa.string()] * 2 if digests else [pa.list_(pa.int64()), pa.string()])]
        return pa.table([documents.column(key_col), *[pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 3, types)]],
                        names=schema.names)

    return texts.groupBy("block").cogroup(placed.groupBy("of")).applyInArrow(compose, schema)
