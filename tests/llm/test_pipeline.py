from pathlib import Path

import corpus_pipeline
from brute import components

from millrace.llm import curriculum, decontaminate, minhash, quality_rules, surrogates
from millrace.session import table, work_dir


def test_stages_one_by_one(spark, data):
    docs = table(spark, data, "documents")
    names = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    results = []
    frame = docs
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, data)
        frame = spark.createDataFrame(frame.collect(), frame.schema)
        results.append(frame)
    quality, near, clean, private, mixed = results
    assert all(r.columns == names for r in results[:-1])

    kept = {r.doc_id for r in quality_rules.verdicts(quality_rules.ledger(docs)).where("kept").collect()}
    assert {r.doc_id for r in quality.collect()} == kept

    rows = [(d, texts[d]) for d in sorted(kept)]
    classes, _ = components(rows)
    single = {d for (d, _), c in zip(rows, classes) if c == d}
    assert {r.doc_id for r in near.collect()} == single

    leaked = {r.doc_id for r in decontaminate.leaks(spark, near, table(spark, data, "benchmark")).collect()}
    assert leaked and {r.doc_id for r in clean.collect()} == single - leaked

    replaced = {r.doc_id: r.text for r in surrogates.replaced(spark, clean).collect()}
    assert {r.doc_id: r.text for r in private.collect()} == replaced

    taken = {r.doc_id: r.taken for r in curriculum.mixed(spark, private).collect() if r.taken}
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.words_taken
    assert got == taken


def test_run(spark, data):
    folder = Path(work_dir(spark, "x")).parent
    before = set(folder.iterdir()) if folder.exists() else set()
    out = corpus_pipeline.run(spark, data)
    left = {p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before}
    assert "pii_surrogates" in left and not left & {"quality_rules", "minhash_near_dedup", "benchmark_decontamination", "classes", "entities"}
    rows = out.select("doc_id", "position").collect()
    assert rows and [r.position for r in rows] == sorted(r.position for r in rows)


def test_stages_on_odd_rows(spark, corpus, odd_rows, data):
    for rows in (odd_rows, []):
        frame = corpus(rows, extra=["position_", "position", "words_taken", "_kept_id", "_odd", "_id", "kept", "row", "node"])
        names = frame.columns
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, data)
            assert set(names) <= set(out.columns), name
            assert out.count() <= max(len(rows) * 2, 0)


def test_operators_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "minhash_near_dedup", "benchmark_decontamination", "pii_surrogates", "source_mix",
    ]
    assert minhash.Near().percent == 85
