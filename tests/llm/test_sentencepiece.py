import zlib

import numpy as np
import public_tokenizers
import sentencepiece

from pitchline.llm import sentencepiece_backend as sb

PATH = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, ids string"  # the extra column clashes with a result's name
TEXTS = ["", " ", "  ", "   a   b  ", "<s> </s> <unk> <0x0A>", "\n\n x\ty", "👍🏽 漢字", "\x00a", "a" * 40, "é é", "12345 1 2",
         "x ", " x", "ÿ", "word and more " * 20_000, None]


def test_parity_and_round_trip(spark):
    original = sentencepiece.SentencePieceProcessor(model_file=PATH)
    df = spark.createDataFrame([(i or None, t, "x") for i, t in enumerate(TEXTS)] * 2, SCHEMA).repartition(3)
    encoded = sb.encode(df, PATH)
    rows = encoded.collect()
    assert len(rows) == 2 * len(TEXTS)
    for r in rows:
        ids = original.encode(TEXTS[r["doc_id"] or 0] or "")
        assert r["ids"] == ids and r["n_ids"] == len(ids) and r["parity"]
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
    for r in sb.decode(encoded, PATH).collect():
        assert r["text"] == (TEXTS[r["doc_id"] or 0] or "")
    assert sb.encode(df.limit(0), PATH).collect() == []


def test_marks_in_the_text_are_spaces():
    encoder = sb.Encoder(PATH)
    original = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text in ("a▁b ▁ c", "▁", "▁▁x ▁"):
        ids, same = encoder.texts([text.encode()])
        assert ids[0].tolist() == original.encode(text) and same == [True]
        assert encoder.decode(ids[0].tolist()) == text.replace("▁", " ")


def test_documents(spark):
    original = sentencepiece.SentencePieceProcessor(model_file=PATH)
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in df.collect()}
    rows = sb.encode(df, PATH, keep=("lang",)).collect()
    assert len(rows) == len(texts) and all(r["ids"] == original.encode(texts[r["doc_id"]]) for r in rows)


def test_colliding_chunks_and_parity_by_text():
    bits = [i.bit_count() & 1 for i in range(4096)]
    pair = ["".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)]
    encoder = sb.Encoder(PATH)
    original = sentencepiece.SentencePieceProcessor(model_file=PATH)
    ids, same = encoder.texts([t.encode() for t in pair])
    assert [i.tolist() for i in ids] == [original.encode(t) for t in pair] and same == [True, True]
    # a chunk that fails speaks for the texts that hold it as a chunk, whatever came before
    encoder.differ = {b" bad"}
    encoder.cache.known[b" bad"] = np.array([5], "<u4").tobytes()
    assert encoder.texts([b"bad", b"x bad", b"badly", b"", b"x"])[1] == [False, False, True, True, True]
    encoder.cache.known, encoder.cache.older = {}, {}
    assert encoder.texts([b"x"])[1] == [True] and not encoder.differ
    assert encoder.texts([b"x bad"])[1] == [True]


def model(kind, pieces, **spec):
    """A small model file's content; its scores are given, nothing is trained."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    m.trainer_spec.model_type = kind
    m.trainer_spec.byte_fallback = True
    for piece, score, t in [("<unk>", 0, sb.UNKNOWN), ("<s>", 0, sb.CONTROL), ("</s>", 0, sb.CONTROL)] + [
            (f"<0x{i:02X}>", 0, sb.BYTE) for i in range(256)] + [(p, s, sb.NORMAL) for p, s in pieces]:
        m.pieces.add(piece=piece, score=score, type=t)
    m.normalizer_spec.add_dummy_prefix = spec.get("prefix", True)
    m.normalizer_spec.remove_extra_whitespaces = spec.get("extra", False)
    m.normalizer_spec.escape_whitespaces = True
    return m


def test_unigram_model_and_white_space_rules(tmp_path):
    pieces = [("▁", -2.0), ("a", -3.0), ("b", -3.1), ("▁a", -3.5), ("ab", -3.2), ("▁ab", -4.0), ("ba", -5.0)]
    for extra in (False, True):
        path = str(tmp_path / f"m{extra}.model")
        with open(path, "wb") as f:
            f.write(model(sb.UNIGRAM, pieces, extra=extra).SerializeToString())
        original = sentencepiece.SentencePieceProcessor(model_file=path)
        encoder = sb.Encoder(path)
        for text in ("ab ba aab", "  ab   b ", "abba baab", "a", "aé b"):
            ids, _ = encoder.texts([text.encode()])
            assert ids[0].tolist() == original.encode(text), (extra, text)
