"""The pipeline: every stage against what it should do with its own input."""

import corpus_pipeline
from grantlens.llm import quality
from grantlens.llm.common import staged

from .test_decontaminate import brute as hits
from .test_jaccard import brute as groups
from .test_tokens import VOCABULARY, check_packing, packed_rows


def test_stages(spark, folder, documents):
    from tokenizers import Tokenizer

    kept = {"documents": documents}
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        docs = kept[name] = staged(stage(spark, docs, folder))
        if name != "packing":
            assert docs.schema.names == documents.columns or sorted(docs.columns) == sorted(documents.columns)
    rows = {name: {r["doc_id"]: r["text"] for r in frame.collect()} for name, frame in kept.items() if name != "packing"}
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = quality.score(documents, quality.train(documents, labels)).where("predicted = 1")
    assert set(rows["quality"]) == {r["doc_id"] for r in scored.collect()}
    assert set(rows["near_duplicates"]) == {c for _, _, c in groups(list(rows["quality"].items()))}
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = {r[0] for r in hits(list(rows["near_duplicates"].items()), bench) if not r[5]}
    assert set(rows["decontamination"]) == clean and len(clean) > 100
    assert set(rows["personal_data"]) == clean
    assert any(rows["personal_data"][d] != rows["decontamination"][d] for d in clean)
    check_packing(packed_rows(kept["packing"]), list(rows["personal_data"].items()), Tokenizer.from_file(VOCABULARY), 4096)
    want = packed_rows(kept["packing"])
    got = packed_rows(corpus_pipeline.run(spark, folder))
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert list(map(key, got)) == list(map(key, want))


def test_stages_with_odd_documents(spark, folder, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            columns, docs = docs.columns, staged(stage(spark, docs, folder))
            if name != "packing":
                assert sorted(docs.columns) == sorted(columns)
