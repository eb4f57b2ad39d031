import zlib

import corpus_pipeline


from gaugeflow.llm import queries

SMOKE = "/root/testdata/sf0.001"


def test_registry_shape(spark):
    import __spark_entry__ as E
    names = [n for n in E.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted({int(n[2:].split("_")[0]) for n in names if n != "pipeline"}) == list(range(1, 14)) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "simhash_near_dedup", "packing"]


def test_contract_columns(spark):
    rows = queries.op5_toxic_segments(spark, SMOKE).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5)
               for r in rows)
    rows = queries.op3_url_rules(spark, SMOKE).collect()
    assert rows and all(r.verdict in ("allow", "block") for r in rows)


def test_pipeline_stages(spark):
    docs = queries.table(spark, SMOKE, "documents")
    kept = {r.doc_id: r for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMOKE)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        rows = docs.collect()
        assert 0 < len(rows) <= len(kept) and all(kept[r.doc_id] == r for r in rows)
        kept = {r.doc_id: r for r in rows}
    pieces = corpus_pipeline.run(spark, SMOKE).collect()
    assert {r.doc_id for r in pieces} == set(kept)


def test_stages_take_any_rows(spark, docs, empty):
    """Nulls, empty and long texts, repeats, clashing names and no rows at all."""
    rows = [tuple(r) for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMOKE)
        kept = [tuple(r) for r in out.collect()]
        assert out.columns == docs.columns and all(r in rows for r in kept)
        texts = sorted(str(r[1]) for r in kept)
        if name == "language_id":
            assert kept and not any(t in ("None", "") for t in texts)
        if name == "toxicity":
            assert len(kept) == len(rows)  # nothing here is toxic
        if name == "simhash_near_dedup":
            ids = [r[0] for r in kept]
            assert 2 not in ids and 4 not in ids and ids.count(6) == 1 and {1, 3, 5, 7, 8, None} <= set(ids)
        nothing = stage(spark, empty, SMOKE)
        assert nothing.columns == docs.columns and nothing.count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMOKE).collect()
    assert {r.doc_id for r in pieces} == {r[0] for r in rows} and corpus_pipeline.STAGES[-1][1](spark, empty, SMOKE).count() == 0
