import random
import zlib

import pytest

from cohortkit.llm import toxicity


def corpus(n, seed):
    rnd = random.Random(seed)
    clean = ["".join(rnd.choice("aeioulnrst") for _ in range(rnd.randint(2, 7))) for _ in range(400)]
    tails = ["", "a", "en", "ist", "um", "ox", "elz", "irk"]
    rows = []
    for i in range(n):
        ws = [rnd.choice(clean) for _ in range(rnd.choice([3, 30, 200, 900]))]
        bad = int(i % 3 == 0)
        if bad:
            for _ in range(3):
                ws.insert(rnd.randrange(len(ws) + 1), rnd.choice(["zwibb", "kvadd"]) + rnd.choice(tails))
        rows.append((i, " ".join(ws), bad))
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus(600, 1)


def test_held_out_accuracy_and_unseen_misspelling(spark, rows):
    docs = spark.createDataFrame([(i, t, "zz", 1.0) for i, t, _ in rows] + [(9001, None, "zz", 0.0), (9002, "", "zz", 0.0)],
                                 "doc_id long, text string, toxic string, score double")
    labels = spark.createDataFrame([(i, 0, b) for i, _, b in rows] + [(None, 0, 1), (5, 0, None), (77777, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    out = {r.doc_id: r for r in toxicity.op2(docs, labels).collect()}
    assert len(out) == len(rows) + 2
    for i in out:
        assert out[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= out[i].score <= 1 and out[i].predicted == int(out[i].score >= 0.5)
    held = [(out[i].predicted, b) for i, _, b in rows if out[i].held_out]
    assert sum(p == b for p, b in held) >= 0.97 * len(held)
    f = toxicity.scorer(model)
    clean = " ".join(rows[1][1].split()[:40])
    assert f(clean + " zwibbolo kvaddim zwibbut") > 0.5 > f(clean)
    assert f(clean + " zwibbolo") > f(clean) + 0.02
    assert f(clean) == f(clean.upper())


def test_held_out_labels_are_never_used(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    schema = "doc_id long, quality int, toxic int"
    a = spark.createDataFrame([(i, 0, b) for i, _, b in rows], schema)
    b = spark.createDataFrame([(i, 0, 1 - b if zlib.crc32(str(i).encode()) % 5 == 0 else b) for i, _, b in rows], schema)
    one, two = toxicity.fit(docs, a), toxicity.fit(docs, b)
    assert (one.weight == two.weight).all() and one.bias == two.bias


def test_one_class_no_labels_empty(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    lab = spark.createDataFrame([(1, 0, 1)], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.op2(docs, lab).collect()} == {1.0}
    assert {r.score for r in toxicity.op2(docs, lab.limit(0)).collect()} == {0.0}
    assert toxicity.op2(docs.limit(0), lab.limit(0)).count() == 0
