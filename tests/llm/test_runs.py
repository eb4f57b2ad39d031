import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import queries, runs

SMOKE = "/root/testdata/sf0.001"


def plain_runs(words, least_words=6, least_periods=4):
    """Every longest stretch of a period, smallest periods first."""
    n, found = len(words), []
    for q in range(1, n // least_periods + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            start = i - q
            while i < n and words[i] == words[i - q]:
                i += 1
            if i - start >= max(least_words, least_periods * q) and not any(
                    all(words[j] == words[j - p] for j in range(start + p, i)) for p in range(1, q)):
                found.append((start, i - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapse(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_text(rng):
    words = []
    while len(words) < rng.randint(0, 160):
        unit = [rng.choice("ab" if rng.random() < 0.7 else "abcdef") for _ in range(rng.randint(1, 12))]
        words += unit * rng.randint(1, 9) + unit[:rng.randint(0, len(unit))]
    return [w.encode() for w in words]


def test_runs_equal_every_period_tried():
    rng = random.Random(3)
    texts = [periodic_text(rng) for _ in range(400)] + [[], [b"a"], [b"a"] * 5, [b"a"] * 6, [b"x"] * 300]
    texts += [([b"a"] * k + [b"b"]) * 9 for k in (3, 7, 20)]
    found = runs.find_runs(texts)
    for words, got in zip(texts, found):
        want = plain_runs(words)
        assert got == want
        assert runs.collapse(words, got) == plain_collapse(words, want)
    assert sum(map(bool, found)) > 200


def test_appending_word_by_word_and_in_chunks_agree():
    rng = random.Random(5)
    for _ in range(60):
        words = periodic_text(rng) or [b"a"]
        table = {}
        numbers = runs.np.array([table.setdefault(w, len(table)) for w in words])
        seen = []
        for step in (1, 3, 17, 1000):
            catcher = runs.SquareCatcher(len(numbers))
            for at in range(0, len(numbers), step):
                catcher.append(numbers[at:at + step])
            seen.append(sorted((s, e, q) for s, e, q in map(tuple, catcher.runs) if e - s >= max(6, 4 * q)))
        assert seen[0] == seen[1] == seen[2] == seen[3]


def test_long_documents_and_streams(monkeypatch):
    monkeypatch.setattr(runs, "STREAM", 64)
    monkeypatch.setattr(runs, "CHUNK", 50)
    rng = random.Random(7)
    texts = [periodic_text(rng) for _ in range(60)] + [[b"u%d" % (i % 37) for i in range(700)]]
    assert runs.find_runs(texts) == [plain_runs(t) for t in texts]


def test_fewer_periods_are_refused():
    with pytest.raises(ValueError):
        runs.find_runs([[b"a"]], least_periods=3)


def test_periodic_runs_of_any_rows(spark, docs, empty):
    rows = docs.withColumn("RUNS", F.lit(1)).withColumn("Collapsed", F.lit("x"))
    got = runs.periodic_runs(rows)
    assert got.columns == ["doc_id", "lang", "start", "length", "word", "block", "fp", "slots", "again", "kept", "runs", "collapsed"]
    got = got.collect()
    assert sorted((str(r.doc_id) for r in got)) == sorted(str(r.doc_id) for r in docs.collect())
    long = next(r for r in got if r.doc_id == 5)
    assert [tuple(x) for x in long.runs] == [(0, 5000, 1)] and long.collapsed == "word end"
    assert all(r.runs == [] and r.collapsed == "" for r in got if r.doc_id in (3, 4))
    assert runs.periodic_runs(empty).count() == 0


def plain_query(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join("%d,%d,%d\n" % r for r in found).encode()), sha(plain_collapse(words, found)))


def test_query_equals_plain_version(spark):
    texts = {r.doc_id: r.text for r in queries.table(spark, SMOKE, "documents").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_square_runs(spark, SMOKE).collect()}
    assert got.keys() == texts.keys()
    short = {i: t for i, t in texts.items() if len((t or "").split()) < 1500}
    assert len(short) > 150 and any(got[i][0] for i in short)
    for i, text in short.items():
        assert got[i] == plain_query(i, text)
