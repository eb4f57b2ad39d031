"""Exact removal of long repeated strings with a logarithmic index family.

Every window of ``length`` bytes picks the least fingerprint of its grams (a
gram is a quarter of a window long); the suffixes that start at picked grams
are indexed. Equal windows pick the same gram at the same place, so every
repeat shows as two equal grams among the indexed suffixes.

The index is a family of levels, each a suffix array cut in buckets: suffixes
sorted by their first bytes, then by the fingerprint of their first gram. A
batch of documents gets a suffix array, is merge-scanned against the levels
there are, and takes place as level 0; two levels of one size merge into one
of twice the size, so every suffix is merged a logarithmic number of times.

What the scans find are candidates. They are narrowed to windows in three
rounds over *cells*, runs of windows that picked one gram: whole runs, runs of
at most 16 windows, single windows. Cells that share all their bytes are
repeated whole; a cell whose core, the bytes common to its windows, is found
nowhere else cannot repeat; what is left is cut into the cells of the next
round, one copy of each. Counts are aggregated before they are shuffled and
bytes never leave their document's block, so copies of a passage, however
many, cost one small row in a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gaugeflow.llm.common import bucketed_table, shared_table

LENGTH = 200
#: Batches of the index family, suffixes of a bucket about, and bytes of a block of documents.
BATCHES, BUCKET_ROWS, BLOCK_BYTES = 4, 500_000, 16 << 20
#: Windows of the second round's cells.
CELL = 16
#: Bytes worked on together, and windows of a long document worked on together.
STREAM, SEGMENT = 1 << 20, 1 << 22
#: Low bits of a packed number that hold a place in a stream.
PLACE = np.uint64((1 << 24) - 1)
#: Suffixes sorted together before they are sent to their buckets.
SORT_ROWS = 1 << 20
ODD, ODD2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC2B2AE3D27D4EB4F)
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
CELLS = "block long, row int, at long, back int, n int, core long, whole long"


def scramble(x: np.ndarray) -> np.ndarray:
    """64-bit mixing of numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return scramble(a * ODD + (b ^ (b >> np.uint64(31))) * ODD2)


BYTE_VALUES = scramble(np.arange(1, 257, dtype=np.uint64))


class Grams:
    """64-bit fingerprints of every substring of given sizes, by doubling."""

    def __init__(self, data: np.ndarray, sizes: list[int]):
        self.found = {}
        h, step = BYTE_VALUES[data], 1
        while step <= max(sizes):
            for size in sizes:
                if step <= size < 2 * step:
                    n = max(0, len(data) - size + 1)
                    self.found[size] = mix(h[:n], h[size - step:size - step + n])
            h = h[:-step] * ODD + h[step:]
            h ^= h >> np.uint64(29)
            step *= 2

    def __getitem__(self, size: int) -> np.ndarray:
        return self.found[size]


def gram_size(length: int) -> int:
    return length // 4 + 1


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the least value in every run of ``width``, the first of equals."""
    m = (values & ~PLACE) | np.arange(len(values), dtype=np.uint64)
    step = 1
    while 2 * step <= width:
        m = np.minimum(m[:-step], m[step:])
        step *= 2
    if width > step:
        m = np.minimum(m[:len(m) - (width - step)], m[width - step:])
    return (m & PLACE).astype(np.int64)


def pieces_of(bodies: list[tuple[int, bytes]], length: int, segment: int):
    """Streams of (row, first window, bytes): whole short documents, long ones
    in segments of ``segment`` windows."""
    stream, held = [], 0
    for row, body in bodies:
        for base in range(0, max(1, len(body) - length + 1), segment):
            piece = body[base:base + segment + length - 1] if len(body) > segment else body
            stream.append((row, base, piece))
            held += len(piece)
            if held >= STREAM:
                yield stream
                stream, held = [], 0
    if stream:
        yield stream


def laid_out(stream) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a stream and where its pieces start and end."""
    ends = np.cumsum([len(p) for *_, p in stream])
    return np.frombuffer(b"".join(p for *_, p in stream), np.uint8), np.concatenate([[0], ends[:-1]]), ends


def sample_suffixes(stream, length: int):
    """(piece, first window, windows, place of the gram, key) of every run of
    windows that pick one gram. A key has a suffix's first three bytes, then
    40 bits of its gram's fingerprint."""
    data, _, ends = laid_out(stream)
    size = gram_size(length)
    if len(data) < length:
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)]
    grams = Grams(data, [size])[size]
    places = least_places(grams, length - size + 1)
    owner = np.repeat(np.arange(len(stream)), [len(p) for *_, p in stream])[:len(places)]
    at = np.flatnonzero(np.arange(len(places)) + length <= ends[owner])
    place = places[at]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 0) | (np.diff(at) != 1)])) if len(at) else at
    n = np.diff(np.append(first, len(at)))
    begin, place = at[first], place[first]
    head = (data[place].astype(np.uint64) << np.uint64(16)) | (data[place + 1].astype(np.uint64) << np.uint64(8)) | data[place + 2]
    return [owner[begin], begin, n, place, (head << np.uint64(40)) | (grams[place] >> np.uint64(24))]


def to_blocks(docs: DataFrame, key_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """(``block``, ``row``, key, ``body``): texts as bytes, numbered within
    blocks of about ``block_bytes``; null texts are empty."""
    key_type = docs.schema[key_col].dataType
    arrow_key = to_arrow_type(key_type)
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("row", T.IntegerType()),
                           T.StructField("key", key_type), T.StructField("body", T.BinaryType())])

    def run(batches):
        block, row, held = TaskContext.get().partitionId() << 20, 0, 0
        for batch in batches:
            blocks, rows, bodies = [], [], []
            for text in batch.column(1):
                body = (text.as_py() or "").encode("utf-8", "surrogatepass")
                if row and held + len(body) > block_bytes:
                    block, row, held = block + 1, 0, 0
                blocks.append(block)
                rows.append(row)
                bodies.append(body)
                row, held = row + 1, held + len(body)
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), pa.array(rows, pa.int32()), batch.column(0).cast(arrow_key),
                 pa.array(bodies, pa.binary())], names=schema.names)

    return docs.select(F.col(f"`{key_col}`"), F.col(f"`{text_col}`").cast("string")).mapInArrow(run, schema)


def suffixes(texts: DataFrame, length: int, segment: int) -> DataFrame:
    """Sampled suffixes of all documents: (``block``, ``row``, ``at``, ``back``,
    ``n``, ``key``): ``n`` windows from ``at`` on picked the gram at ``at + back``."""
    schema = "block long, row int, at long, back int, n int, key long"

    def run(batches):
        for batch in batches:
            blocks, rows = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for stream in pieces_of([(i, b.as_py()) for i, b in enumerate(batch.column(2))], length, segment):
                piece, begin, n, place, key = sample_suffixes(stream, length)
                starts = laid_out(stream)[1]
                doc, base = (np.array([p[k] for p in stream], np.int64) for k in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks[doc[piece]]), pa.array(rows[doc[piece]]), pa.array(begin - starts[piece] + base[piece]),
                     pa.array((place - begin).astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(key.view(np.int64))],
                    names=["block", "row", "at", "back", "n", "key"])

    return texts.select("block", "row", "body").mapInArrow(run, schema)


def array_of(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of sorted parts, and those found more than once."""
    keys = np.sort(np.concatenate([np.frombuffer(p, np.uint64) for p in parts] or [np.zeros(0, np.uint64)]))
    again = np.concatenate([[False], keys[1:] == keys[:-1]]) if len(keys) else np.zeros(0, bool)
    return keys[~again], np.unique(keys[again])


class SuffixFamily:
    """Levels of suffix arrays; level i holds 2**i batches. ``add`` scans and
    files one batch in one Spark job."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.levels: dict[int, DataFrame] = {}

    def add(self, keys: DataFrame, last: bool = False) -> DataFrame:
        """Index a batch of suffixes (``key``) and return the keys that occur
        twice in it or in it and in an earlier batch. After the ``last`` batch
        nothing is filed."""
        buckets = self.buckets

        def sort(batches):
            held, rows = [], 0

            def send():
                found = np.sort(np.concatenate(held))
                again = np.concatenate([[False], found[1:] == found[:-1]])
                third = np.concatenate([[False], again[1:] & again[:-1]])
                found = found[~third]  # two copies say as much as more
                part = (found % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(part, kind="stable")
                cuts = np.flatnonzero(np.diff(part[order])) + 1
                lists = np.split(found[order], cuts)
                return pa.RecordBatch.from_arrays(
                    [pa.array(part[order][np.concatenate([[0], cuts]).astype(int)], pa.int32()),
                     pa.array([x.tobytes() for x in lists], pa.binary())], names=["bucket", "keys"])

            for batch in batches:
                if batch.num_rows:
                    held.append(batch.column(0).to_numpy().view(np.uint64))
                    rows += batch.num_rows
                if rows >= SORT_ROWS:
                    yield send()
                    held, rows = [], 0
            if held:
                yield send()

        merged = []
        while len(merged) in self.levels and not last:
            merged.append(len(merged))
        level = len(merged)

        def scan(new: pa.Table, old: pa.Table) -> pa.Table:
            parts, out = [x.as_py() for x in new.column("keys")], []
            keys, repeated = array_of(parts)
            filed = {i: np.frombuffer(k, np.uint64) for i, k in zip(*(old.column(c).to_pylist() for c in ("level", "keys")))}
            found = [repeated]
            for there in filed.values():  # both are sorted: one merge scan
                at = np.searchsorted(there, keys)
                hit = at < len(there)
                hit[hit] = there[at[hit]] == keys[hit]
                found.append(keys[hit])
            bucket = (new if len(new) else old).column("bucket")[0].as_py()
            out.append((bucket, -1, np.unique(np.concatenate(found)).tobytes()))
            if not last:
                whole, _ = array_of([keys.tobytes(), *(filed[i].tobytes() for i in merged if i in filed)])
                out.append((bucket, level, whole.tobytes()))
            return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary()))],
                            names=["bucket", "level", "keys"])

        schema = "bucket int, level int, keys binary"
        new = keys.select("key").mapInArrow(sort, "bucket int, keys binary")
        old = keys.sparkSession.createDataFrame([], schema)
        for there in self.levels.values():
            old = old.union(there)
        done = shared_table(new.groupBy("bucket").cogroup(old.groupBy("bucket")).applyInArrow(scan, schema), "level")
        for i in merged:
            del self.levels[i]
        if not last:
            self.levels[level] = done.where(F.col("level") == level)
        return done.where("level = -1").select("keys").mapInArrow(unpack, "key long")


def unpack(batches):
    for batch in batches:
        for keys in batch.column(0):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(keys.as_py(), np.int64))], names=["key"])


def cut_cells(stream, ranges: dict, size: int, length: int):
    """Cells of the given ranges of windows of a stream: whole ranges
    (``size`` 0) or runs of at most ``size`` windows. Returns the ranges' row
    numbers, the cells' first windows, ``back``, ``n``, ``core`` and ``whole``."""
    data = laid_out(stream)[0]
    core_size = gram_size(length) if not size else length - size + 1
    grams = Grams(data, sorted({core_size, length}))
    windows, cores = grams[length], grams[core_size]
    pos, back, n, which = ranges["pos"], ranges["back"], ranges["n"], np.arange(len(ranges["n"]))
    if size:
        which = np.repeat(which, n)
        step = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        part = (back[which] - step) // size  # windows as far from their gram make a cell, wherever a range begins
        first = np.flatnonzero(np.concatenate([[True], (np.diff(which) != 0) | (np.diff(part) != 0)]))
        n = np.diff(np.append(first, len(which)))
        which, part, step = which[first], part[first], step[first]
        place = pos[which] + back[which]
        pos, back = pos[which] + step, back[which] - step
        core = mix(cores[place - size * part], part.astype(np.uint64))
    else:
        core = cores[pos + back]
    whole = mix(mix(windows[pos], windows[pos + n - 1]), n.astype(np.uint64))
    return which, pos, back, n, core, whole


def cells(texts: DataFrame, ranges: DataFrame, size: int, length: int, segment: int) -> DataFrame:
    """Ranges of windows (``block``, ``row``, ``at``, ``back``, ``n``) cut into
    cells with their fingerprints, next to their texts."""
    def run(held: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if len(asked):
            row, at, back, n = (asked.column(c).to_numpy() for c in ("row", "at", "back", "n"))
            order = np.lexsort((at, row))
            row, at, back, n = (x[order].astype(np.int64) for x in (row, at, back, n))
            wanted = set(row.tolist())
            bodies = [(r, b.as_py()) for r, b in zip(held.column("row").to_pylist(), held.column("body")) if r in wanted]
            for stream in pieces_of(bodies, length, segment):
                starts = laid_out(stream)[1]
                spans = [np.searchsorted(row, [r, r + 1]) for r, *_ in stream]
                mine = [np.flatnonzero(at[a:b] // segment * segment == base) + a for (a, b), (_, base, _) in zip(spans, stream)]
                piece = np.repeat(np.arange(len(stream)), [len(m) for m in mine])
                mine = np.concatenate(mine)
                if not len(mine):
                    continue
                shift = (np.array([b for _, b, _ in stream]) - starts)[piece]  # from places in the stream to the document's
                which, pos, back_, n_, core, whole = cut_cells(
                    stream, {"pos": at[mine] - shift, "back": back[mine], "n": n[mine]}, size, length)
                out.append([row[mine][which].astype(np.int32), pos + shift[which], back_.astype(np.int32), n_.astype(np.int32),
                            core.view(np.int64), whole.view(np.int64)])
        columns = [np.concatenate(c) for c in zip(*out)] or [np.zeros(0, t) for t in ("i4", "i8", "i4", "i4", "i8", "i8")]
        block = held.column("block")[0].as_py() if len(held) else 0
        return pa.table([pa.array(np.full(len(columns[0]), block))] + [pa.array(c) for c in columns],
                        names=["block", "row", "at", "back", "n", "core", "whole"])

    return (texts.select("block", "row", "body").groupBy("block")
            .cogroup(ranges.select("block", "row", "at", "back", "n").groupBy("block")).applyInArrow(run, CELLS))


def resolve(found: DataFrame, last: bool) -> tuple[DataFrame, DataFrame | None]:
    """(ranges repeated whole, one range of each kind to cut further)."""
    one = F.min(F.struct("block", "row", "at", "back", "n")).alias("one")
    kinds = found.groupBy("core", "whole").agg(F.count("*").alias("copies"), *([] if last else [one]))
    if not last:
        kinds = shared_table(kinds, "kinds")
    more = kinds.where("copies > 1").select("core", "whole")
    more = shared_table(more, "repeated") if last else more  # as above: the join reads plain shuffles
    # merged at every size: what repeats grows with the data
    repeated = found.join(more.hint("merge"), ["core", "whole"], "left_semi").select("block", "row", "at", "n")
    if last:
        return repeated, None
    shared = shared_table(kinds.groupBy("core").count().where("count > 1").select("core"), "cores")
    return repeated, kinds.join(shared.hint("merge"), "core").select("one.*")


def merge_spans(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans; spans that touch are one."""
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.concatenate([[True], begin[1:] > reach[:-1]]))
    return begin[first], reach[np.append(first[1:] - 1, len(reach) - 1)]


def repeated_strings(docs: DataFrame, length: int = LENGTH, key_col: str = "doc_id", text_col: str = "text",
                     batches: int = BATCHES, block_bytes: int = BLOCK_BYTES, segment: int = SEGMENT) -> DataFrame:
    """One row for each document: the key, ``n_bytes`` of its UTF-8 text,
    ``spans`` (start, end) of the bytes covered by a string of ``length`` bytes
    that also starts anywhere else, and the ``kept`` bytes.

    Strings are judged on the input; they do not cross documents and may
    overlap. Null and short texts keep all they have; repeated rows, null and
    equal keys are documents of their own; an empty table gives an empty
    result; other columns are not read. ``length`` is 12 at least.
    """
    if length < 12:
        raise ValueError("strings must have 12 bytes at least")
    texts = bucketed_table(to_blocks(docs, key_col, text_col, block_bytes), "block", "texts")
    batch = F.pmod(F.xxhash64("block"), F.lit(batches))
    sampled = shared_table(suffixes(texts, length, segment).withColumn("batch", batch.cast("int")), "suffixes")
    buckets = max(1, -(-sampled.count() // BUCKET_ROWS))
    family, found = SuffixFamily(buckets), None
    for i in range(batches):
        keys = family.add(sampled.where(F.col("batch") == i), last=i == batches - 1)
        found = keys if found is None else found.union(keys)
    # stored, so that the join reads two plain shuffles and Spark can split the rows of a very common key
    candidates = sampled.join(shared_table(found.distinct(), "keys").hint("merge"), "key", "left_semi")

    marks, ranges = None, candidates
    for size in (0, min(CELL, length // 2), 1):
        cut = shared_table(cells(texts, ranges, size, length, segment), "cells")
        repeated, ranges = resolve(cut, size == 1)
        marks = repeated if marks is None else marks.union(repeated)

    def finish(held: pa.Table, marked: pa.Table) -> pa.Table:
        row, at, n = (marked.column(c).to_numpy().astype(np.int64) for c in ("row", "at", "n"))
        order = np.argsort(row, kind="stable")
        row, at, n = row[order], at[order], n[order]
        spans, kept = [], []
        for r, body in zip(held.column("row").to_pylist(), held.column("body")):
            body = body.as_py()
            a, b = np.searchsorted(row, [r, r + 1])
            begin, end = merge_spans(at[a:b], at[a:b] + n[a:b] - 1 + length) if a < b else (at[:0], at[:0])
            spans.append([{"start": s, "end": e} for s, e in zip(begin.tolist(), end.tolist())])
            cuts = [0, *np.stack([begin, end], 1).ravel().tolist(), len(body)]
            kept.append(b"".join(body[x:y] for x, y in zip(cuts[::2], cuts[1::2])))
        sizes = [len(b.as_py()) for b in held.column("body")]
        return pa.table([held.column("key"), pa.array(sizes, pa.int64()),
                         pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                         pa.array(kept, pa.binary())], names=[key_col, "n_bytes", "spans", "kept"])

    schema = T.StructType([T.StructField(key_col, docs.schema[key_col].dataType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("spans", SPANS),
                           T.StructField("kept", T.BinaryType())])
    return texts.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(finish, schema)
