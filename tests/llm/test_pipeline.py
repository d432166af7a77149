"""Every pipeline stage on its own input against plain Python; run() against the stages."""

import corpus_pipeline
from corvid.llm.common import stored
from corvid.llm.quality_knn import quality_scores
from tests.llm import corpus as c
from tests.llm.test_model_ops import check_packing

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_against_plain_python(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "line_dedup", "minhash_near_dedup", "benchmark_decontamination",
                            "best_fit_packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    accepted = {r.doc_id for r in quality_scores(docs, labels).collect() if r.score >= 0.3}
    kept = stored(stages["quality_classifier"](spark, docs, SF), "t")
    assert kept.columns == COLUMNS and {r.doc_id for r in kept.collect()} == accepted

    before = texts(kept)
    lines = stored(stages["line_dedup"](spark, kept, SF), "t")
    gone = c.removed(before)
    assert lines.columns == COLUMNS
    assert dict(texts(lines)) == {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(i, []))
                                  for i, t in before}
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    before = texts(lines)
    near = stored(stages["minhash_near_dedup"](spark, lines, SF), "t")
    components = c.components(before)
    assert near.columns == COLUMNS
    assert {i for i, _ in texts(near)} == {i for i, (_, first) in components.items() if i == first}

    before = texts(near)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = stored(stages["benchmark_decontamination"](spark, near, SF), "t")
    found = c.contamination(before, items)
    assert clean.columns == COLUMNS and {i for i, _ in texts(clean)} == {i for i, r in found.items() if not r[3]}

    packed = stages["best_fit_packing"](spark, clean, SF)
    check_packing(packed.collect(), texts(clean), 2048)

    whole = corpus_pipeline.run(spark, SF)
    place = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(whole.select(*place).collect()) == sorted(packed.select(*place).collect())


def test_stages_on_edge_rows(spark):
    """Null and empty texts, repeated rows, rows without id, an extra column that clashes with internal names."""
    rows = [(1, None), (2, ""), (3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (4, " ")]
    docs = c.frame(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF), "t")
        empty = stage(spark, docs.limit(0), SF)
        assert empty.count() == 0
        if name != "best_fit_packing":
            assert out.columns == docs.columns
            assert {r.doc_id for r in out.collect()} >= {1, 2, 4, None}
        docs = out if name != "best_fit_packing" else docs
    assert out.count() == docs.count()
