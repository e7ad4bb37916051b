"""The pipeline's stages follow one another, and each does its operator's work."""

from conftest import SF_SMALL


def test_stages(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    doubled = docs.unionByName(docs.limit(20))
    once = p.drop_copies(spark, doubled, SF_SMALL)
    assert once.columns == docs.columns
    kept = {r["doc_id"] for r in once.collect()}
    text = {r["doc_id"]: "".join((r["text"] or "").split()) for r in docs.collect()}
    assert len({text[i] for i in kept}) == len(kept) == len(set(text.values())) == once.count()
    out = p.run(spark, SF_SMALL)
    assert {"doc_id", "n_tokens", "ids_sha256"} <= set(out.columns)
    assert {r["doc_id"] for r in out.collect()} <= set(text)
    assert [n for n, _ in p.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "byte_bpe"]
