"""The pipeline against its stages applied one by one, and planted cases."""

import corpus_pipeline
import pyarrow as pa
import pyarrow.parquet as pq


def test_pipeline(spark, words, tmp_path):
    good = {i: " ".join(words(i, 90 + i % 40)) + "." for i in range(60)}
    passage = " ".join(words(999, 30))
    planted = {
        100: good[3],  # an exact copy
        101: "short text",
        102: " ".join(words(50, 6) * 30),
        103: good[4] + " " + passage,
        104: None,
        105: "1234 " * 80,
    }
    docs = good | planted
    rows = {"doc_id": list(docs), "text": list(docs.values()), "lang": ["en"] * len(docs), "source": ["s"] * len(docs), "n_chars": [len(t or "") for t in docs.values()]}
    pq.write_table(pa.table(rows), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"item_id": [1], "text": [passage]}), tmp_path / "benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == set(good)
    columns = spark.read.parquet(str(tmp_path / "documents.parquet")).columns
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path)).cache()
        assert at.columns == columns
        kept.append({r.doc_id for r in at.select("doc_id").collect()})
    assert kept[0] & {101, 102, 104} == set()
    assert 105 not in kept[1]
    assert kept[2] == set(good) | {103}
    assert kept[3] == set(good)


def _run(spark, tmp_path, rows, items, more=None):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
    table = pa.table({n: pa.array(c, k) for n, c, k in zip(names, zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)} | (more or {}))
    pq.write_table(table, tmp_path / "documents.parquet")
    pq.write_table(pa.table({"item_id": pa.array([i for i, _ in items], pa.int64()), "text": pa.array([t for _, t in items], pa.string())}), tmp_path / "benchmark.parquet")
    return corpus_pipeline.run(spark, str(tmp_path))


def test_odd_rows(spark, words, tmp_path):
    """Repeated and null keys, nulls in every column, clashing names and a very
    long text: every clean row comes through, once where rows are the same."""
    clean = [(i // 2, " ".join(words(i, 90 + i % 40)), "en", "s", 1) for i in range(60)]
    clean += [(None, " ".join(words(700 + i, 100)), None, None, None) for i in range(3)]
    clean += [(800, " ".join(words(800, 40_000, 3_000)), "en", "s", 2)]
    dirty = [clean[0], (None, None, None, None, None), (1, "short", "en", "s", 1), (None, "", "en", "s", 0), (2, " \t", None, "s", 0)]
    n = len(clean) + len(dirty)
    clash = {c: pa.array([0] * n, pa.int32()) for c in ("fp", "kept", "row", "bad_key", "bad_text", "bucket", "key", "simhash", "copies")}
    out = _run(spark, tmp_path, clean + dirty, [], clash).collect()
    pieces = {(r.doc_id, r.ids_crc32) for r in out if r.piece == 0}
    whole = [r for r in out if r.piece == 0]
    assert len(whole) == len(clean) == len(pieces)
    assert sorted((r.doc_id is None, r.doc_id) for r in whole if r.doc_id is not None) == sorted((False, c[0]) for c in clean if c[0] is not None)


def test_empty_tables(spark, tmp_path):
    assert _run(spark, tmp_path, [], []).count() == 0


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "language ID", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]
    assert corpus_pipeline.ORACLE_SQL is None
