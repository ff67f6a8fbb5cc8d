import zlib

import numpy as np
import public_tokenizers
import sentencepiece

import corpus_pipeline
from pitchline.llm import host_quality as hq
from pitchline.llm import order_minhash as om
from pitchline.llm import pfair, secrets

SF = "/root/testdata/sf0.001"


def test_stages_by_hand(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = {r["doc_id"] for r in hq.judge(spark.read.parquet(f"{SF}/documents.parquet")).collect() if r["kept"]}
    # near duplicates by all pairs; the least id of each class stays
    texts = {d: om.kmers(b" ".join(docs[d]["text"].encode().lower().split())) for d in sorted(kept)}
    up = {d: d for d in texts}

    def find(d):
        while up[d] != d:
            d = up[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if om.similar(texts[a], texts[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    kept = {d for d in kept if find(d) == d}
    redacted = {d: secrets.redacted(docs[d]["text"]) for d in kept}
    left = spark.createDataFrame([(d, docs[d]["source"]) for d in kept], "doc_id long, source string")
    order = [r["doc_id"] for r in pfair.positions(left).orderBy("position").collect()]
    original = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = corpus_pipeline.run(spark, SF).orderBy("part", "row").collect()
    assert [r["doc_id"] for r in rows] == order
    for r in rows:
        ids = original.encode(redacted[r["doc_id"]])
        assert r["ids"] == ids and r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_stages_keep_columns_and_odd_rows(spark, workdir):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    words = " ".join(f"word{i}" for i in range(80))
    rows = [(1, words, "en", "s", 1), (1, words, "en", "s", 1), (2, words + " token=abcdefghijklmnop", None, None, None),
            (3, None, None, None, None), (None, " ".join(f"other{i}" for i in range(90)), None, "s", 5)]
    for n in (rows, []):
        docs = spark.createDataFrame(n, schema)
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            path = f"{workdir}/{len(n)}-{i}"
            docs.write.parquet(path)
            docs = stage(spark, spark.read.parquet(path), SF)
            if i < 4:
                assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        # the near copy goes, the null text fails the rules
        assert sorted((r["doc_id"] for r in docs.collect()), key=repr) == ([1, None] if n else [])
