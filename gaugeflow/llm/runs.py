"""Periodic runs of words by online dyadic square catching.

Words are appended to a stream. For each power of two B there is a catcher
over the last completed, aligned block of B words: every appended word
advances the comparison of the B words that end there with that block. A
block that returns q words later (B <= q < 2 B) together with the block after
it is a square of period q; new squares are reported when their second block
is complete, and squares of one period that overlap are one run, which later
words extend for as long as they repeat the word q places back. Squares within
a run of a smaller period have no period of their own and are left out.

All comparisons of one append are made at once for each block size, on hashes
of B words; every reported square is compared word by word, so results are
exact. Work is a few array steps for each block size, whatever repeats.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.llm.common import free_name

#: Least length of a run in words and in periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Words appended at a time, and words of short documents that share a stream.
CHUNK, STREAM = 1 << 18, 1 << 17
RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


def scramble(x: np.ndarray) -> np.ndarray:
    """64-bit mixing of numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SquareCatcher:
    """Runs of a stream of word numbers that grows by ``append``.

    ``longest`` bounds the length of what may repeat (the longest document of
    the stream): larger blocks need no catcher. ``runs`` holds [start, end,
    period] of every square's run found so far, of two periods or more as far
    as catchers see them and of every run of ``LEAST_PERIODS`` periods.
    """

    def __init__(self, longest: int):
        self.words = np.zeros(0, np.int64)
        self.runs: list[list[int]] = []
        self.levels = max(1, (longest // LEAST_PERIODS).bit_length())
        # by level: hashes of the last 2 B suffixes, and whether the last B met their catcher
        self.tails = [(np.zeros(2 << k, np.uint64), np.zeros(1 << k, bool)) for k in range(self.levels)]

    def append(self, new: np.ndarray) -> None:
        done, n = len(self.words), len(new)
        self.words = np.concatenate([self.words, new])
        for run in self.runs:  # open runs go on
            if run[1] == done:
                run[1] += self._forward(done, run[2])
        at = np.arange(done, done + n)
        suffix = scramble(new.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        for k in range(self.levels):
            size, (hashes, met) = 1 << k, self.tails[k]
            hashes = np.concatenate([hashes, suffix])  # hashes[i] belongs to the suffix that ends at done - 2 size + i
            first = at - size + 1  # where the last `size` words begin
            block = first // size * size - 1  # the end of the block completed before them
            here = np.flatnonzero(block >= size - 1)
            meets = np.zeros(n, bool)
            meets[here] = suffix[here] == hashes[block[here] - done + 2 * size]
            met = np.concatenate([met, meets])
            square = np.flatnonzero(met[size:] & met[:-size])
            if len(square):
                self._report(at[square], first[square], block[square], size)
            suffix = scramble(hashes[size:size + n] * np.uint64(0xD6E8FEB86659FD93) + hashes[2 * size:])
            self.tails[k] = hashes[n:], met[n:]

    def _forward(self, at: int, period: int) -> int:
        """Words from ``at`` on that repeat the word ``period`` places back."""
        return self._agree(at, period, len(self.words) - at, 1)

    def _agree(self, at: int, period: int, most: int, way: int) -> int:
        same, step = 0, 64
        while same < most:
            step = min(step, most - same)
            x = at + same if way > 0 else at - same - step + 1
            equal = self.words[x:x + step] == self.words[x - period:x - period + step]
            if not equal.all():
                return same + int(np.argmin(equal if way > 0 else equal[::-1]))
            same, step = same + step, 2 * step
        return same

    def _report(self, last: np.ndarray, first: np.ndarray, block: np.ndarray, size: int) -> None:
        """Squares whose second block's copy is ``first``..``last``."""
        period = first - (block - size + 1)
        begin, end = block - 2 * size + 1, last + 1  # both blocks and their copies
        shorter = sorted((s, e) for s, e, q in self.runs if q < size)
        if shorter:
            starts, ends = np.array([s for s, _ in shorter]), np.maximum.accumulate([e for _, e in shorter])
            i = np.searchsorted(starts, begin, "right") - 1
            own = (i < 0) | (ends[i] < end)
            period, begin, end = period[own], begin[own], end[own]
        held = {q: run for run in self.runs if size <= (q := run[2]) < 2 * size}  # the latest run of a period
        for i in np.lexsort((begin, period)).tolist():
            q, a, b = int(period[i]), int(begin[i]), int(end[i])
            run = held.get(q)
            if run and run[0] <= a and b <= run[1]:
                continue
            ahead = self._forward(a + q, q)
            if a + q + ahead < b:  # equal hashes of different words
                continue
            behind = self._agree(a + q - 1, q, a, -1)
            run = [a - behind, a + q + ahead, q]
            held[q] = run
            self.runs.append(run)


def streams(numbers: list[np.ndarray]):
    """Short documents share a stream, each longer one has its own: lists of
    the documents' places."""
    shared, held = [], 0
    for i, words in enumerate(numbers):
        if len(words) > STREAM // 4:
            yield [i]
            continue
        shared.append(i)
        held += len(words) + 1
        if held >= STREAM:
            yield shared
            shared, held = [], 0
    if shared:
        yield shared


def find_runs(texts: list[list[bytes]], least_words: int = LEAST_WORDS,
              least_periods: int = LEAST_PERIODS) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each document's words, by start, then
    period. ``least_periods`` of four or more."""
    if least_periods < LEAST_PERIODS:
        raise ValueError(f"runs of fewer than {LEAST_PERIODS} periods are not all caught")
    table: dict[bytes, int] = {}
    numbers = [np.array([table.setdefault(w, len(table)) for w in words], np.int64) for words in texts]
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for group in streams(numbers):
        catcher = SquareCatcher(max(len(numbers[i]) for i in group))
        # a number of its own ends each document, so that nothing repeats across one
        stream = np.concatenate([np.append(numbers[i], -1 - n) for n, i in enumerate(group)])
        ends = np.cumsum([len(numbers[i]) + 1 for i in group])
        for at in range(0, len(stream), CHUNK):
            catcher.append(stream[at:at + CHUNK])
        for start, end, period in sorted(catcher.runs):
            if end - start >= max(least_words, least_periods * period):
                which = int(np.searchsorted(ends, start, "right"))
                base = int(ends[which]) - len(numbers[group[which]]) - 1
                found[group[which]].append((start - base, end - start, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def periodic_runs(docs: DataFrame, text_col: str = "text", runs_col: str = "runs",
                  collapsed_col: str = "collapsed") -> DataFrame:
    """``docs`` with each text's ``runs`` (array of start, length, period, by
    start, then period) and ``collapsed`` text instead of the text.

    Words are what stands between ASCII white space. A run is a longest
    stretch with smallest period q of at least max(6, 4 q) words. Null and
    empty texts have no runs and an empty collapsed text; each row is worked on
    by itself, so repeated rows and null keys need no rule; columns named like
    the new ones are replaced; an empty table gives an empty result.
    """
    gone = {text_col.lower(), runs_col.lower(), collapsed_col.lower()}
    rest = [f for f in docs.schema.fields if f.name.lower() not in gone]
    name = free_name(docs, "text_of_row")
    schema = T.StructType(rest + [T.StructField(runs_col, RUNS),
                                  T.StructField(collapsed_col, T.StringType())])
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in batches:
            words = [(t.as_py() or "").encode("utf-8", "surrogatepass").split() for t in batch.column(0)]
            runs = find_runs(words)
            texts = [collapse(w, r).decode("utf-8", "surrogatepass") for w, r in zip(words, runs)]
            rows = [[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i + 1) for i in range(len(rest))] + [pa.array(rows, run_type), pa.array(texts, pa.string())],
                names=schema.names)

    columns = [F.col(f"`{f.name}`") for f in rest]
    return docs.select(F.col(f"`{text_col}`").alias(name), *columns).mapInArrow(run, schema)


def repeat_tail(words: Column, start: Column, period: Column) -> Column:
    """The words, each from ``start`` on replaced by that of the first
    ``period`` words there in turn."""
    return F.transform(words, lambda w, i: F.when(i < start, w).otherwise(
        F.get(words, (start + (i - start) % period).cast("int"))))
