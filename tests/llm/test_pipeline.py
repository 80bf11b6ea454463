"""The pipeline against plain versions of its stages, each on that stage's own input."""

import corpus_pipeline
import pytest

from dinerlake.llm import toxicity
from dinerlake.llm.common import configure, written
from tests.conftest import SMALL
from tests.llm.brute import classes, mixed, redacted
from tests.llm.test_decontaminate import brute


@pytest.fixture(scope="module")
def stages(spark):
    configure(spark)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(written(stage(spark, found[-1], SMALL), name))
    return found


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_stay_and_every_stage_decides(stages):
    assert all(s.columns == stages[0].columns for s in stages[:5])
    sizes = [s.count() for s in stages]
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4] > 0


def test_toxic_documents_go_and_others_stay(spark, stages):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    scorer = toxicity.Scorer(toxicity.fit(stages[0], labels))
    want = sorted(r.doc_id for r in stages[0].collect() if scorer.score(r.text)[0] < 0.3)
    assert ids(stages[1]) == want


def test_one_of_each_group_stays(stages):
    texts = {r.doc_id: r.text for r in stages[1].collect()}
    assert ids(stages[2]) == sorted(set(classes(texts).values()))


def test_leaked_documents_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    texts = [(r.doc_id, r.text) for r in stages[2].collect()]
    leaked = {d for d, _ in brute([t for t in texts if len(t[1] or "") < 6_000], items)}
    short = {d for d, t in texts if len(t or "") < 6_000}
    assert set(ids(stages[3])) & short == short - leaked


def test_secrets_are_masked(stages):
    before = {r.doc_id: r for r in stages[3].collect()}
    for r in stages[4].collect():
        assert r.text == redacted(before[r.doc_id].text) and r.n_chars == len(r.text)
        assert (r.lang, r.source) == (before[r.doc_id].lang, before[r.doc_id].source)


def test_mix(stages):
    rows = [(r.doc_id, r.text, r.source) for r in stages[4].collect()]
    want = sorted((d, s, t) for d, s, _, _, t in mixed(rows) if t > 0)
    assert sorted((r.doc_id, r["size"], r.taken) for r in stages[5].collect()) == want


def test_run_and_odd_rows(spark, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    rows = [(1, "one text", None, None, None, 1), (1, "one text", "en", "a", 8, 2), (None, None, None, "a", None, 3),
            (2, "", "en", "a", 0, 4), (None, "another text of some words", "en", "b", 26, 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, rid int"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert all(r.taken > 0 for r in got) and {r["size"] for r in got} <= {2, 5}
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_result_holds_the_redacted_documents(spark, stages):
    assert stages[5].columns == [*stages[4].columns, "size", "source_size", "target", "taken"]
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    got = stages[5].collect()
    assert got and all(r.text == texts[r.doc_id] for r in got)
    rows = [(None, "two words", "a"), (None, "three more words", "a"), (1, "one", "a"), (1, "other text here now", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = corpus_pipeline.STAGES[4][1](spark, docs, SMALL).collect()
    assert taken and all((r.doc_id, r.text, r.source) in rows and r["size"] == len(r.text.split()) for r in taken)


def odd_documents():
    text = "some plain words about the weather over the hills and far away from here "
    rows = [(i, f"{text} number {i} " * 3, "en", f"s{i % 3}", 10, 1, 2.0, 3, "x") for i in range(12)]
    rows += [(20, text * 3, "en", "s1", 10, 1, 2.0, 3, "b"), (20, text * 3, "en", "s0", 10, 1, 2.0, 3, "a"),
             (21, text * 3, "en", "s1", 10, 1, 2.0, 3, "c"), (None, text * 3, None, None, None, None, None, None, None),
             (22, None, "en", "s1", 0, 1, 1.0, 1, "d"), (22, None, "en", "s1", 0, 1, 1.0, 1, "d"), (23, "", "en", None, 0, 1, 1.0, 1, "")]
    rows += [(24, "token = abcdefgh12345 " + "-----BEGIN " + "AB " * 20_000 + "1.1" * 9_000, "en", "s2", 0, 1, 1.0, 1, "long")]
    return rows


def test_clashing_columns_nulls_and_repeated_rows(spark, tmp_path):
    schema = ("doc_id long, text string, lang string, source string, n_chars long, size int, target double, "
              "taken int, digest string")
    rows = odd_documents()
    folder = str(tmp_path)
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    found = corpus_pipeline.run(spark, folder)
    assert found.columns == [c.split()[0] for c in schema.split(", ")] + ["mix_size", "source_size", "mix_target", "mix_taken"]
    near = corpus_pipeline.STAGES[1][1](spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).collect()
    # Of the repeated id 20 the row that is least by its other columns; wordless rows all stay.
    assert [(r.source, r.digest) for r in near if r.doc_id == 20] == [("s0", "a")]
    assert sum(r.doc_id == 22 for r in near) == 2 and not any(r.doc_id == 21 or r.doc_id is None for r in near)


def test_empty_documents(spark, tmp_path):
    folder = str(tmp_path)
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
