"""Licence scan: passages close to licence templates.

Texts and templates are normalised to words and compared by the Dice
coefficient over word bigrams, repeats counted. A passage of a size so far from
a template's that no overlap could reach the threshold is never compared, and a
text without enough of a template's bigrams is not looked at further. The
templates, whole licence texts and notices, are the rows of
``license_templates.jsonl``.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
#: Words that a worker keeps.
CACHED = 500_000
NOT_WORD = re.compile(r"[\W_]+")

#: Bigrams from which a template is a licence's own text; its passages come before those of notices within them.
WHOLE = 80
#: Public licence texts and notices, by SPDX identifier (``LicenseRef-BSD``: a BSD licence, not told which).
TEMPLATES = tuple((row["license"], row["text"]) for row in map(json.loads, Path(__file__).with_name(
    "license_templates.jsonl").read_text(encoding="utf-8").splitlines()))


def normal_words(text: str) -> list[str]:
    """Lower-case words between white space, other characters than letters and
    digits removed; what is left empty is no word."""
    return [w for w in (NOT_WORD.sub("", p) for p in text.lower().split()) if w]


def dice(a: Counter, b: Counter) -> float:
    total = a.total() + b.total()
    return 2 * (a & b).total() / total if total else 0.0


class Scanner:
    """Finds the passages of a text that are close to a template."""

    def __init__(self, templates=TEMPLATES, threshold: float = THRESHOLD):
        self.threshold = threshold
        words = [normal_words(t) for _, t in templates]
        self.number = {w: n for n, w in enumerate(sorted({w for ws in words for w in ws}), 1)}
        self.base = len(self.number) + 1
        self.templates = []
        for (name, _), ws in zip(templates, words):
            ids = [self.number[w] for w in ws]
            grams = Counter(a * self.base + b for a, b in zip(ids, ids[1:]))
            self.templates.append((name, grams, grams.total()))
        self.known = np.array(sorted({g for _, grams, _ in self.templates for g in grams}), np.int64)
        # for each known bigram, one after the other, the templates that have it and how often
        held = sorted((g, n, c) for n, (_, grams, _) in enumerate(self.templates) for g, c in grams.items())
        gram, self.holder, self.holds = np.array(held, np.int64).reshape(-1, 3).T.copy()
        self.first = np.searchsorted(gram, self.known, "left")
        self.holders = np.searchsorted(gram, self.known, "right") - self.first
        self.least = np.array([self._sizes(size)[0] for _, _, size in self.templates])
        self.kept: dict[str, int] = {}

    def _numbers(self, text: str) -> np.ndarray:
        """Word numbers of the text; 0 stands for words that no template has."""
        parts, kept = text.lower().split(), self.kept
        if len(kept) > CACHED:
            kept.clear()
        for part in set(parts).difference(kept):
            word = NOT_WORD.sub("", part)
            kept[part] = self.number.get(word, 0) if word else -1
        ids = np.fromiter(map(kept.__getitem__, parts), np.int64, len(parts))
        return ids[ids >= 0]

    def _sizes(self, size: int) -> tuple[int, int]:
        """Least and greatest bigrams of a passage that can reach the threshold;
        the least is that of shared ones too."""
        t = self.threshold
        return math.ceil(t / (2 - t) * size - 1e-9), math.floor((2 - t) / t * size + 1e-9)

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(licence, score, first word, end word) of passages that reach the
        threshold, those close to whole texts first, then best first, none
        overlapping an earlier one."""
        ids = self._numbers(text or "")
        if len(ids) < 2:
            return []
        grams = np.where((ids[:-1] > 0) & (ids[1:] > 0), ids[:-1] * self.base + ids[1:], 0)
        place = np.searchsorted(self.known, grams)
        at = np.flatnonzero(self.known[np.minimum(place, len(self.known) - 1)] == grams)
        if not len(at):
            return []
        place, counts = np.unique(place[at], return_counts=True)
        many = self.holders[place]
        entry = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - self.first[place], many)
        shared = np.bincount(self.holder[entry], np.minimum(self.holds[entry], np.repeat(counts, many)), len(self.templates))
        found = []
        for n in np.flatnonzero(shared >= self.least):
            name, template, size = self.templates[n]
            found += [(size >= WHOLE, name, *x) for x in self._close(grams, at, template, size)]
        chosen: list = []
        for _, name, score, a, b in sorted(found, key=lambda x: (not x[0], -x[2], x[3] - x[4], x[3], x[1])):
            if all(b <= c or a >= d for _, _, c, d in chosen):
                chosen.append((name, score, a, b))
        return chosen

    def _close(self, grams, at, template, size):
        """Passages from one template bigram to another: for every first one the
        best last one within the size bounds."""
        least, most = self._sizes(size)
        own = np.array([i for i in at.tolist() if int(grams[i]) in template], np.int64)
        # a bigram adds to the overlap unless the template's number of it lies between it and the first one
        before, places = np.full(len(own), -1), {}
        for n, i in enumerate(own.tolist()):
            same = places.setdefault(int(grams[i]), [])
            same.append(n)
            if len(same) > template[int(grams[i])]:
                before[n] = same[-1 - template[int(grams[i])]]
        ends = np.searchsorted(own, own + most, "left")
        for n in np.flatnonzero(ends - np.arange(len(own)) >= least).tolist():
            lengths = own[n:ends[n]] - own[n] + 1
            scores = 2 * np.cumsum(before[n:ends[n]] < n) / (lengths + size)
            scores[lengths < least] = 0
            last = int(np.argmax(scores))
            if scores[last] >= self.threshold:
                yield float(scores[last]), int(own[n]), int(own[n + last]) + 2


def scan_licenses(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, key_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row for each passage of a whole text that reaches the threshold: the
    key, ``license``, ``score``, ``first_word`` and ``end_word`` (normalised
    words, end exclusive). Overlapping passages give that of a whole licence text
    before that of a notice, then the best one, ties the longer, earlier, then
    least name. Texts without any, null and empty texts
    give no row; repeated rows and null keys are scanned each."""
    scanner = Scanner(templates, threshold)

    @F.pandas_udf("array<struct<license:string,score:double,first_word:long,end_word:long>>")
    def find(texts: pd.Series) -> pd.Series:
        names = ("license", "score", "first_word", "end_word")
        return pd.Series([[dict(zip(names, x)) for x in scanner.scan(t)] for t in texts])

    return docs.select(key_col, F.explode(find(F.col(text_col))).alias("found")).select(key_col, "found.*")
