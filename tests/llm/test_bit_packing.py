import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pitchline.llm import bit_packing as bp

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, start string"  # the extra column clashes with a result's name
TEXTS = ["Hello, World!", None, "", "don't DON'T it's 'S x", "İK ſ \x0b\x0c\x1c á É J̌", "Σίσυφος 漢字 12345 a1b2",
         "<|endoftext|> x", "\u0085x　z", "👍🏽 ok", "a_b-c...!!", "\x00a", "Êtes ÇÀ ß ẞ ª × ÷ ÿ", "word " * 50_000]


def morse(n, a, b):
    """A word and its complement, which polynomial hashes modulo 2^64 take for one."""
    bits = [i.bit_count() & 1 for i in range(n)]
    return "".join(b if x else a for x in bits), "".join(a if x else b for x in bits)


def ids_of(text):
    t = Tokenizer.from_file(PATH)
    return t.encode(text or "", add_special_tokens=False).ids + [bp.END_ID]


def check(spark, rows):
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], SCHEMA).repartition(4)
    got = [tuple(r) for r in bp.packed(df, PATH).orderBy("start").collect()]
    want, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = ids_of(t)
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


def test_whole_texts(spark):
    check(spark, [(97 * i % 50, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (3, "tie b"), (3, "tie a"), (3, "tie a")])


def test_added_tokens_and_colliding_chunks(spark):
    pair = morse(4096, "a", "b")
    more = ["a <|endoftext|> b", "<|startoftext|>Hello<|endoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", "é<|EndOfText|> ß", *pair,
            pair[1] + " " + pair[0], "x".join(pair)]
    check(spark, list(enumerate(more)))


def test_random_texts():
    import random

    r = random.Random(9)
    letters = list("aAbBzZ059 .,!?'-_<|>\n\t") + ["é", "É", "ß", "漢", "👍", "\u0301", "İ", "<|endoftext|>", " the", "’"]
    texts = ["".join(r.choices(letters, k=r.randint(0, 30))) for _ in range(10_000)]
    plain = Tokenizer.from_file(PATH)
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    got = bp.WordEncoder(PATH).texts([t.encode() for t in texts])
    for text, ids, right in zip(texts, got, want):
        assert ids.tolist() == right, repr(text)


def test_empty_table(spark):
    assert bp.packed(spark.createDataFrame([], SCHEMA), PATH).collect() == []


@pytest.mark.parametrize("width", [1, 3, 7, 8, 11, 16, 17, 32])
def test_random_access(width):
    r = np.random.default_rng(width)
    docs = [r.integers(0, 1 << width, n, dtype=np.uint32) for n in (0, 5, 1, 700, 64, 63, 65, 0, 129)]
    out = io.BytesIO()
    writer = bp.Writer(out, 1 << width, block=64)
    assert writer.width == width
    for i, ids in enumerate(docs):
        writer.add(i if i != 2 else None, ids)
    writer.close()
    size = len(out.getvalue())
    assert size < sum(map(len, docs)) * width / 8 + 17 * 8 + 17 * len(docs) + 200
    reader = bp.Reader(io.BytesIO(out.getvalue()))
    whole = np.concatenate(docs)
    assert reader.doc_ids == [0, 1, None, 3, 4, 5, 6, 7, 8]
    for i, ids in enumerate(docs):
        assert np.array_equal(np.concatenate([np.zeros(0), *reader.parts(i)]), ids)
    for _ in range(50):
        a, b = sorted(r.integers(0, len(whole) + 1, 2))
        assert np.array_equal(reader.ids(int(a), int(b - a)), whole[a:b])


def test_cut_file_is_refused():
    out = io.BytesIO()
    writer = bp.Writer(out, 100)
    writer.add(1, np.arange(50, dtype="<u4"))
    writer.close()
    with pytest.raises(ValueError):
        bp.Reader(io.BytesIO(out.getvalue()[:-3]))
