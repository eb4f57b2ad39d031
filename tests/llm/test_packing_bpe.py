import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from gaugeflow.llm import bpe, packing

BYTE, WORD = str(P.path("byte_bpe_50k.json")), str(P.path("word_bpe_49k.json"))


def naive_best_fit(counts, capacity):
    rooms = []
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            fits = [i for i, r in enumerate(rooms) if r >= size]
            if fits:
                rooms[min(fits, key=lambda i: rooms[i])] -= size
            else:
                rooms.append(capacity - size)
    return sorted(rooms)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(3)
    for _ in range(100):
        capacity = rng.choice([8, 16, 33, 64])
        sizes = rng.sample(range(1, capacity + 1), rng.randint(1, min(capacity, 12)))
        counts = {s: rng.randint(1, 20) for s in sizes}
        used, placed = {}, {}
        for size, rank, n, first, each, offset in packing.plan_windows(counts, capacity).tolist():
            placed[size] = placed.get(size, 0) + n
            for i in range(n):
                used.setdefault(first + i // each, []).append((offset + i % each * size, size))
        assert placed == counts and sorted(used) == list(range(len(used)))
        rooms = []
        for parts in used.values():
            at = 0
            for offset, size in sorted(parts):
                assert offset == at
                at += size
            rooms.append(capacity - at)
        assert sorted(rooms) == naive_best_fit(counts, capacity)


def test_tightest_room():
    tree = packing.CapacityTree(16)
    for room in (3, 9, 9, 16):
        tree.add(room, 1)
    assert [tree.tightest(n) for n in (1, 3, 4, 10, 16)] == [3, 3, 9, 16, 16]
    tree.add(16, -1)
    assert tree.tightest(10) is None


def test_fast_paths_equal_the_library():
    library, fast = Tokenizer.from_file(BYTE), packing.byte_bpe(BYTE)
    words = bpe.splitter(WORD)
    word_library, encoder = Tokenizer.from_file(WORD), bpe.word_encoder(WORD)
    stable = [chr(c) for c in [9, 10, 13, *range(0x20, 0x7f), *range(0xa1, 0x250)]]
    rng = random.Random(5)
    texts = ["".join(rng.choices(stable, k=40)) for _ in range(300)] + ["a" + c + "b" + c for c in stable]
    texts += ["a  b", " lead", "trail ", "x \n y", "\n\n", "it's 'S we'LL", "", "á İ K <|startoftext|>x",
              "Ａ１ １２ 你好     z", "<|endoftext|>"]
    for text in texts:
        want = np.asarray(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert fast.ids(text) == want, repr(text)
        got = [i for w in words.words(text) for i in encoder.encode(w, add_special_tokens=False).ids]
        assert got == word_library.encode(text, add_special_tokens=False).ids, repr(text)
        if words.plain(text):
            assert [w for part in text.split() for w in words.words(part)] == words.words(text)


def test_pack_documents(docs, empty):
    library = Tokenizer.from_file(BYTE)
    rows = packing.pack_documents(docs, BYTE, capacity=64).collect()
    whole = {}
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [0]
        whole.setdefault(r.doc_id, []).append(ids)
    ends = {}
    for r in rows:
        ids = whole[r.doc_id][0]
        piece = np.asarray(ids[r.start:r.start + r.length], "<u4").tobytes()
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(piece)
        ends.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(len(i) for v in whole.values() for i in v)
    for parts in ends.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack_documents(empty, BYTE).collect() == []


def test_encode_and_decode(docs, empty):
    library = Tokenizer.from_file(WORD)
    want = sorted((str(r.doc_id), library.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect())
    for chars in (20, 10_000_000):
        rows = bpe.encode_documents(docs, WORD, block_chars=chars).collect()
        assert sorted((str(r.doc_id if r.doc_id is None else int(r.doc_id)), r.ids) for r in rows) == want
        assert all(r.n_tokens == len(r.ids) and r.decoded == library.decode(r.ids, skip_special_tokens=False) for r in rows)
    sums = bpe.encode_documents(docs.where("doc_id = 1"), WORD, digests=True).first()
    ids = library.encode(docs.where("doc_id = 1").first().text, add_special_tokens=False).ids
    assert sums.ids_sha256 == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
    assert bpe.encode_documents(empty, WORD).collect() == []


def test_keys_beside_a_null_key_stay_exact(spark):
    keys = [9007199254740993, None, 9007199254740995, -5]
    rows = spark.createDataFrame([(k, "the cat") for k in keys], "doc_id long, text string").coalesce(1)
    got = [r.doc_id for r in bpe.encode_documents(rows, WORD).collect()]
    assert sorted(map(str, got)) == sorted(map(str, keys))
    named = rows.selectExpr("cast(doc_id as string) as doc_id", "text")
    assert sorted(str(r.doc_id) for r in bpe.encode_documents(named, WORD, digests=True).collect()) == sorted(map(str, keys))


def test_decode_join(spark):
    ids = spark.createDataFrame([(1, 0, 320), (1, 1, 2368), (2, 0, 49407)], "k int, pos int, id int")
    got = {r.k: r.text for r in bpe.decode_ids(ids, ["k"], bpe.vocabulary(spark, WORD)).collect()}
    library = Tokenizer.from_file(WORD)
    assert got == {1: library.decode([320, 2368], skip_special_tokens=False), 2: "<|endoftext|>"}


def test_varints():
    numbers = [0, 1, 127, 128, 300, 16383, 16384, 2097151, 2097152, 49407]
    assert bpe.from_varints(b"".join(map(bpe.to_varint, numbers))).tolist() == numbers
    assert bpe.from_varints(b"").tolist() == []
