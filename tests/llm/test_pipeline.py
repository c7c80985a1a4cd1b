import hashlib
import random
import re

import numpy as np

import corpus_pipeline as pipe
from cohortkit.llm import bpe, jaccard, mixing, secrets
from cohortkit.llm.registry import vocabulary

from .test_jaccard import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(n=240):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("aeioulnrst") for _ in range(rnd.randint(2, 7)))
    rows, toxic = [], []
    for i in range(n):
        w = [word() for _ in range(rnd.choice([3, 30, 90]))]
        bad = int(i % 5 == 0)
        if bad:
            w += [rnd.choice(["zwibb", "kvadd"]) + rnd.choice(["", "a", "en", "ox"]) for _ in range(3)]
        if i % 7 == 1:
            w.insert(1, "password=Hunter2xyz")
        rows.append((i, " ".join(w)))
        toxic.append((i, 1, bad))
    rows += [(n + k, rows[k][1] + (" tail" if k % 2 else "")) for k in range(1, 40) if k % 5]
    rows += [(n + 50, None), (n + 51, "")]
    return [(i, t, "en", f"s{i % 4}" if i % 9 else None, len(t or "")) for i, t in rows], toxic


def test_stages_equal_their_brute_force(spark, tmp_path):
    rows, toxic = documents()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(toxic, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    d, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in pipe.STAGES:
        stage(spark, d, str(tmp_path)).write.parquet(str(tmp_path / name))
        d = spark.read.parquet(str(tmp_path / name))
        seen[name] = d.collect()
        if name != "bpe":
            assert d.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    bad = {i for i, _, b in toxic if b}
    clean = {r.doc_id for r in seen["toxicity"]}
    assert len(bad & clean) <= 2 and len({r[0] for r in rows} - bad - clean - set(range(240, 300))) <= 2
    groups = brute([(r.doc_id, r.text) for r in seen["toxicity"]])
    assert sorted(r.doc_id for r in seen["near_duplicates"]) == sorted({c for _, _, c in groups})
    for r, before in zip(sorted(seen["secrets"], key=lambda r: r.doc_id), sorted(seen["near_duplicates"], key=lambda r: r.doc_id)):
        assert r.text == (before.text and re.sub(r"password=Hunter2xyz", "[SECRET]", before.text))
        assert r.n_chars == len(r.text or "")
    counts = {}
    for r in seen["mixing"]:
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    for r in mixing.mix_counts(spark.read.parquet(str(tmp_path / "secrets"))).collect():
        assert counts.get(r.doc_id, 0) == (int(r.taken / r["size"] + 0.5) if r["size"] else 0)
    codec, text = bpe.codec(vocabulary()), {r.doc_id: r.text for r in seen["mixing"]}
    assert len(seen["bpe"]) == len(seen["mixing"])
    for r in seen["bpe"]:
        ids = codec.full.encode(text[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text[r.doc_id] or "").encode()).hexdigest()


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert pipe.run(spark, str(tmp_path)).count() == 0


def test_kept_keeps_unlinked_rows_of_one_id(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (1, "other words"), (None, "x y"), (None, "z"), (7, ""), (7, ""), (9, "OTHER words")]
    got = sorted(((r.doc_id, r.text) for r in jaccard.kept(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(1, "a b c d e f g"), (1, "other words"), (None, "x y"), (None, "z"), (7, ""), (7, "")], key=str)


def test_the_last_stage_keeps_the_ids(spark):
    texts = ["A small text, with words.", "héllo 😀", "", None]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    codec = bpe.codec(vocabulary())
    for r in pipe.bpe_stage(spark, spark.createDataFrame(rows, SCHEMA), "").collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == codec.encode(texts[r.doc_id] or "") and len(r.ids) == 4 * r.n_tokens
        assert codec.decode(np.frombuffer(r.ids, "<u4").tolist()) == (texts[r.doc_id] or "")
