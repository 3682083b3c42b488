import zlib

import pytest
from pyspark.sql import functions as F

from visitlens.llm import queries, toxicity
from visitlens.llm.transducer import Transducer, compose

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def plain():
    return toxicity.Reader(toxicity.Model())


@pytest.mark.parametrize(
    ("text", "toxic"),
    [
        ("You are an idiot.", True), ("IDIOT!", True), ("You are not an idiot.", False),
        ("He said she called them an idiot, wrote no one.", True), ("I will kill you", True),
        ("The pills kill germs.", False), ("You. Kill.", False), ("They never hurt you", False),
        ("", False), (None, False), ("not nice. du Arschloch", True), ("A calm sentence.", False),
    ],
)
def test_clauses(plain, text, toxic):
    assert (plain.score(text) >= toxicity.THRESHOLD) == toxic


def test_order_of_weights(plain):
    aimed, alone = plain.weigh("you idiot")[0], plain.weigh("an idiot")[0]
    denied, told = plain.weigh("no idiot")[0], plain.weigh("he said idiot")[0]
    assert aimed > alone > told > denied > 0
    assert plain.weigh("idiot. idiot")[0] == 2 * alone
    assert plain.weigh("no one there is an idiot")[0] == alone  # out of reach


def test_composition_multiplies():
    first, second = Transducer(otherwise={0: 0}), Transducer(otherwise={0: 0})
    first.arc(0, "a", "b", 2.0, 0)
    second.arc(0, "b", "c", 3.0, 0)
    both = compose(first, second, ["a", "b", "x"])
    assert both.step(0, "a") == [("c", 6.0, 0)] and both.step(0, "x") == [("x", 1.0, 0)]


def test_query_on_held_out_rows(spark):
    rows = queries.op8_toxicity(spark, SF).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [p for t, p in held if t], [p for t, p in held if not t]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.03 * len(clean)


def test_labels_of_held_out_rows_are_not_read(spark, documents):
    docs = documents(*((i, "zworp man" if i % 3 == 0 else "good man") for i in range(200)))
    labels = spark.createDataFrame(
        [(i, int(i % 3 == 0)) for i in range(200)], "doc_id long, toxic int"
    )
    held = labels.where(toxicity.is_held_out(F.col("doc_id")))
    assert toxicity.learn(docs, held) == toxicity.Model()
    model = toxicity.learn(docs, labels)
    assert "zworp" in model.lexicon and "man" not in model.lexicon
    changed = labels.withColumn(
        "toxic", F.when(toxicity.is_held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    assert toxicity.learn(docs, changed) == model


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.Reader(toxicity.learn(docs, labels))


@pytest.mark.parametrize("insult", ["idiot", "moron"])
def test_clauses_of_the_learned_model(learned, insult):
    scores = [
        learned.score(f"{start} {insult} here today.")
        for start in ("now you are an", "we saw the big", "he said it was an", "it was not an")
    ]
    assert scores == sorted(scores, reverse=True) and len(set(scores)) == 4  # aimed, plain, told, denied
    assert scores[1] >= toxicity.THRESHOLD > scores[3]
    assert learned.score("The pills kill germs.") < toxicity.THRESHOLD


@pytest.mark.parametrize("text", ["The distance is not great.", "We took the train home today"])
def test_one_word_marks_no_others_that_begin_alike(learned, text):
    assert learned.sums(text)[0] == [0.0] * len(toxicity.KINDS)


def test_stems_with_many_endings_are_learned(spark, documents):
    ends = "abcdefghijklmnop"
    docs = documents(
        *((i, f"zworp{ends[i % 16]} man don't e\u0301te\u0301" if i % 3 == 0 else "good distant man") for i in range(600)),
        *((600 + i, "discord man" if i % 3 == 0 else "good man") for i in range(600)),
    )
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(1200)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    reader = toxicity.Reader(model)
    assert reader.read("zworpzz")[0] == toxicity.INSULT
    assert reader.read("discord")[0] == toxicity.INSULT and reader.read("discover")[0] == toxicity.OTHER
    assert "e\u0301te\u0301" in model.lexicon  # learned as it is read
    assert reader.sums("e\u0301te\u0301")[0][0] > 0


def test_cases(spark, documents):
    docs = documents((None, "you idiot"), (1, None), (1, ""), (2, "idiot " * 20_000), (2, "ok"))
    docs = docs.withColumn("score", F.lit("clash"))
    rows = toxicity.score_texts(docs, toxicity.Model()).collect()
    assert len(rows) == 5 and sum(r.score >= 0.3 for r in rows) == 2
    left = toxicity.drop_toxic(docs, toxicity.Model())
    assert left.columns == docs.columns and left.count() == 3
    nothing = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.learn(docs, nothing) == toxicity.Model()
    assert toxicity.score_texts(documents(), toxicity.Model()).count() == 0
