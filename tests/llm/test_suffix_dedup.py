import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import queries, suffix_dedup

SMOKE = "/root/testdata/sf0.001"


def plain(texts, length):
    """(n_bytes, spans, kept) of each text, by counting every string."""
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        edges = [i for i in range(len(b) + 1) if (i < len(b) and gone[i]) != (i > 0 and gone[i - 1] == 1)]
        out.append((len(b), list(zip(edges[::2], edges[1::2])), bytes(x for x, g in zip(b, gone) if not g)))
    return out


def made_texts(rng, n):
    letters = "abcdefghij klm"
    word = lambda k: "".join(rng.choice(letters) for _ in range(k))
    shared = [word(rng.randint(10, 160)) for _ in range(12)] + ["ab" * 40, "x" * 90, "ü€" * 15]
    return ["".join(rng.choice(shared) if rng.random() < 0.35 else word(rng.randint(1, 70)) for _ in range(rng.randint(0, 9)))
            for _ in range(n)]


def run(spark, texts, length, **given):
    frame = spark.createDataFrame([(i, t, "b", 7) for i, t in enumerate(texts)], "doc_id long, text string, body string, block int")
    rows = sorted(suffix_dedup.repeated_strings(frame.repartition(3), length, **given).collect())
    return [(r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in rows]


@pytest.mark.parametrize("length,block", [(40, 700), (12, 1 << 20)])
def test_spans_equal_counting_every_string(spark, length, block):
    texts = made_texts(random.Random(length), 120)
    texts += [texts[0]] * 3 + [None, "", "short", "z" * 500, "y" * length, "ab" * 300]
    want = plain(texts, length)
    assert sum(bool(s) for _, s, _ in want) > 40 and any(not s and n > length for n, s, _ in want)
    assert run(spark, texts, length, block_bytes=block) == want


def test_long_documents_are_cut_in_segments(spark):
    rng = random.Random(2)
    body = "".join(rng.choice("abcdefgh") for _ in range(20_000))
    texts = [body, "q" * 30 + body[4000:4300] + "r" * 10, body[8150:8230], body[:100] + body[:100]]
    assert run(spark, texts, 60, segment=4096) == plain(texts, 60)  # an edge lies in the second text's passage


def test_least_places_and_grams():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 100, 900).astype(np.uint8)
    for size in (3, 8, 11):
        grams = suffix_dedup.Grams(data, [size, 40])[size]
        names = [data[i:i + size].tobytes() for i in range(len(data) - size + 1)]
        assert len(set(zip(names, grams.tolist()))) == len(set(names)) == len(set(grams.tolist()))
        places = suffix_dedup.least_places(grams, 30)
        top = grams & ~suffix_dedup.PLACE
        assert places.tolist() == [i + int(np.argmin(top[i:i + 30])) for i in range(len(grams) - 29)]


def test_levels_merge_geometrically(spark):
    rng = np.random.default_rng(8)
    batches = [rng.integers(0, 3000, 400) << 40 for _ in range(6)]
    family, seen, sizes = suffix_dedup.SuffixFamily(3), np.zeros(0, np.int64), []
    for keys in batches:
        found = family.add(spark.createDataFrame([(int(k),) for k in keys], "key long"))
        values, counts = np.unique(keys, return_counts=True)
        assert sorted(r.key for r in found.collect()) == sorted(
            set(values[counts > 1].tolist()) | set(np.intersect1d(values, seen).tolist()))
        seen = np.union1d(seen, keys)
        sizes.append(sorted(family.levels))
    assert sizes == [[0], [1], [0, 1], [2], [0, 2], [1, 2]]
    held = [np.frombuffer(r.keys, np.uint64) for level in family.levels.values() for r in level.collect()]
    assert all((np.diff(h.astype(float)) > 0).all() for h in held)
    assert set(np.concatenate(held).astype(np.int64).tolist()) == set(seen.tolist())


def test_null_and_equal_keys_and_empty_tables(spark, docs, empty):
    got = suffix_dedup.repeated_strings(docs, 40)
    assert got.columns == ["doc_id", "n_bytes", "spans", "kept"]
    rows = got.collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in docs.collect())
    want = {str(r.doc_id): w for r, w in zip(docs.collect(), plain([r.text for r in docs.collect()], 40))}
    assert {str(r.doc_id): (r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in rows} == want
    assert all(not r.spans and not r.kept for r in rows if r.doc_id in (3, 4))
    assert suffix_dedup.repeated_strings(empty, 40).count() == 0
    big = docs.select((F.col("doc_id") + 9007199254740992).alias("doc_id"), "text")
    assert {r.doc_id for r in suffix_dedup.repeated_strings(big, 40).collect()} == {r.doc_id for r in big.collect()}


def test_query_equals_plain_version(spark):
    rows = queries.table(spark, SMOKE, "documents").orderBy("doc_id").collect()
    want = plain([r.text for r in rows], 200)
    got = {r.doc_id: tuple(r)[1:] for r in queries.op11_suffix_family(spark, SMOKE).collect()}
    assert got == {r.doc_id: (n, sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept).hexdigest())
                   for r, (n, spans, kept) in zip(rows, want)}
