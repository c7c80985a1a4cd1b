import hashlib
import random

import numpy as np
import pytest

from cohortkit.llm import bpe
from cohortkit.llm.registry import vocabulary

PATH = vocabulary()


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(PATH)


def test_both_libraries_agree_on_every_character_of_the_fast_path(codec):
    for cp in range(0x2060):
        ch = chr(cp)
        if bpe._BEYOND.search(ch):
            continue
        s = f"a{ch}b{ch}{ch}1 {ch}{ch}  {ch} !{ch}'s"
        assert codec.fast.encode(s, allowed_special="all") == codec.full.encode(s, add_special_tokens=False).ids


@pytest.mark.parametrize("alphabet", ["a", "ab", "abcdefghij'st! ", "é漢字ab", "0123456789", "  \n\tx", "!'s", "<|endoftext|> y"])
def test_tree_concatenation_equals_whole_encoding(codec, alphabet):
    rnd = random.Random(alphabet)
    for n, step in ((1, 1), (200, 7), (4000, 257)):
        s = "".join(rnd.choice(alphabet) for _ in range(n))
        parts = [codec.encode(s[i:i + step]) for i in range(0, n, step)]
        assert codec.tree(parts) == codec.full.encode(s, add_special_tokens=False).ids


def test_special_text_cut_anywhere(codec):
    s = "xx<|endoftext|>yy " * 30
    whole = codec.full.encode(s, add_special_tokens=False).ids
    for k in range(3, 30):
        assert codec.tree([codec.encode(s[i:i + k]) for i in range(0, len(s), k)]) == whole


def test_query_rows(spark, codec):
    texts = [None, "", "Hello  world", "Hello  world", "x" * 3000, "a bé " * 900, "漢字 ok", "<|endoftext|>!"]
    df = spark.createDataFrame([(i, t, "clash", "z") for i, t in enumerate(texts)],
                               "doc_id long, text string, ids string, decoded string")
    out = {r.doc_id: r for r in bpe.op1(df, PATH).collect()}
    assert len(out) == len(texts)
    for i, t in enumerate(texts):
        ids = codec.full.encode(t or "", add_special_tokens=False).ids
        assert out[i].n_tokens == len(ids)
        assert out[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert out[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    chunked = bpe.encode_packed(df, PATH, long=100, chunk=64).collect()
    assert {r.doc_id: bytes(r.ids) for r in chunked} == {
        i: bpe._pack(codec.full.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
    back = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert {r.doc_id: r.decoded for r in back} == {i: t or "" for i, t in enumerate(texts)}
    assert bpe.op1(df.limit(0), PATH).count() == 0


def test_decoding_defined_results(spark):
    df = spark.createDataFrame([(1, None), (2, [15496, 99999999]), (3, [-1])], "doc_id long, ids array<int>")
    assert [r.decoded for r in bpe.decode(df, PATH).orderBy("doc_id").collect()] == ["", "Hello", ""]


def test_a_worker_holds_what_its_texts_need(spark):
    """Decoding loads neither library, plain texts only one, and a batch passes in steps."""
    c = bpe.Codec(PATH)
    assert c.decode(c.ranks[b] for b in (b"a", b"b")) == "ab" and not {"fast", "full"} & set(vars(c))
    assert c.encode("plain text") and "full" not in vars(c)
    assert c.encode("漢字") and "full" in vars(c)

    def most(xs):
        return [len(xs)] * len(xs)

    df = spark.range(0, 2000, 1, 1).selectExpr("id", "'x' AS text")
    got = bpe._mapped(df, "text", "n", bpe.pa.int64(), bpe.T.LongType(), most).collect()
    assert sorted(r.id for r in got) == list(range(2000)) and max(r.n for r in got) <= bpe.STEP


def test_a_task_gives_arrow_buffers_back(spark):
    """Arrow's memory comes from the system, which a freed buffer goes back to."""
    df = spark.range(0, 20, 1, 1).selectExpr("id", "'x' AS text")
    got = bpe._mapped(df, "text", "pool", bpe.pa.string(), bpe.T.StringType(),
                      lambda xs: [bpe.pa.default_memory_pool().backend_name] * len(xs)).collect()
    assert {r.pool for r in got} == {"system"}
