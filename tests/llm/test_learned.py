import pytest
from pyspark.sql import functions as F

from dinerlake.llm import langid, toxicity
from dinerlake.llm.common import fold
from dinerlake.llm.queries import QUERIES

MEDIUM = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    got = QUERIES["op5_language"](spark, MEDIUM).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.count() == docs.count()
    right = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.97
    assert got.where("score < 0 or score > 1 or score is null").count() == 0


def test_toxicity_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    got = QUERIES["op7_toxicity"](spark, MEDIUM)
    rows = got.join(labels, "doc_id").where("held_out").collect()
    hits = sum(r.predicted for r in rows if r.toxic == 1)
    wrong = sum(r.predicted for r in rows if r.toxic == 0)
    assert hits >= 0.6 * sum(r.toxic for r in rows) and wrong <= 0.05 * len(rows)
    assert got.where("score < 0 or score > 1 or score is null").count() == 0
    assert got.where("predicted = 1 and score < 0.3 or predicted = 0 and score >= 0.3").count() == 0


def rows_outside_the_held_out_fold(spark, n):
    ids = spark.range(4 * n).withColumnRenamed("id", "doc_id")
    return [r.doc_id for r in ids.where(fold() != 2).limit(n).collect()]


@pytest.fixture(scope="module")
def learned(spark):
    ids = rows_outside_the_held_out_fold(spark, 120)
    docs, labels = [], []
    for n, i in enumerate(ids):
        bad = n % 3 == 0
        text = "We walk home now. The sky is blue.\nThey sing a song!" + (" You are a vileword person." if bad else "")
        docs.append((i, text, "en" if n % 2 else None))
        labels.append((i, int(bad)))
    docs += [(i + 10_000, "Wir gehen jetzt nach Hause und der Himmel ist blau", "de") for i in ids[:40]]
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_offending_sentences_are_located(spark, learned):
    model = toxicity.fit(*learned)
    text = "Good morning 𝄞 to you. They are vileword again! Bye."
    rows = [(1, text), (2, None), (3, ""), (4, "..."), (5, "vileword. " * 5_000), (5, "vileword")]
    got = spark.createDataFrame(rows, "doc_id long, text string").withColumn("t", toxicity.toxicity(model)).collect()
    sentence = got[0].t.sentences
    assert got[0].t.score > 0.5 and [text[s.start : s.end] for s in sentence] == [" They are vileword again!"]
    assert [got[i].t.score for i in (1, 2, 3)] == [0.0, 0.0, 0.0]
    assert got[4].t.score > 0.99 and len(got[4].t.sentences) == 5_000 and got[5].t.score > 0.3


def test_nothing_to_learn_from(spark, learned):
    docs, labels = learned
    for d, lab in ((docs.limit(0), labels), (docs, labels.limit(0)), (docs, labels.where("toxic = 0"))):
        model = toxicity.fit(d, lab)
        assert docs.limit(3).where(toxicity.toxicity(model)["score"] > 0.01).count() == 0
    model = langid.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r[0] for r in docs.select(langid.language(model)["lang"]).collect()} == {"und"}


def test_language_of_odd_texts(spark, learned):
    model = langid.fit(learned[0])
    rows = [(1, None), (2, ""), (3, "12 34 !"), (4, "Der Himmel ist blau und wir gehen nach Hause"),
            (5, "THE SKY is blue"), (5, "THE SKY is blue"), (6, "nach Hause gehen " * 30_000), (None, "一二三")]
    got = spark.createDataFrame(rows, "doc_id long, text string").withColumn("f", langid.language(model)).collect()
    assert [r.f["lang"] for r in got][:7] == ["und", "und", "und", "de", "en", "en", "de"]
    assert all(0 <= r.f["score"] <= 1 for r in got) and got[7].f["lang"] in ("de", "en")


def test_labels_with_gaps_and_repeats(spark, learned):
    docs, labels = learned
    odd = labels.union(spark.createDataFrame([(None, 1), (1, None), (2, 7)], "doc_id long, toxic int")).union(labels)
    assert toxicity.fit(docs, odd).weights.keys() == toxicity.fit(docs, labels).weights.keys()


def test_every_language_is_learned(spark):
    """More languages than any fixed number of them; the last ones are rare."""
    ids = iter(rows_outside_the_held_out_fold(spark, 1_000))
    rows, texts = [], {}
    for n in range(260):
        a, b, c = (chr(0x4E00 + 3 * n + k) for k in range(3))
        texts[f"l{n:03}"] = f"{a}{b}{c} {c}{a} {b}{b}{a} {a}{c}{b}"
        rows += [(next(ids), texts[f"l{n:03}"], f"l{n:03}") for _ in range(4 if n < 230 else 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model.langs == sorted(texts)
    asked = spark.createDataFrame(list(texts.items()), "lang string, text string")
    got = asked.select("lang", langid.language(model)["lang"].alias("found")).collect()
    assert all(r.lang == r.found for r in got)
    # few texts in all: still one of each
    assert langid.fit(docs, max_texts=50).langs == sorted(texts)
