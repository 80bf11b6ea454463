import hashlib
import random

import pytest
from pyspark.sql import functions as F

from dinerlake.llm.queries import QUERIES
from dinerlake.llm.substrings import remove_repeats
from tests.conftest import SMALL
from tests.llm.brute import repeats


def digest(df):
    kept = F.when(F.col("kept").isNull(), F.col("whole")).otherwise(F.sha2(F.col("kept").cast("binary"), 256))
    return sorted((r[0], r[1], r[2], r[3]) for r in df.select("doc_id", "n_words", "n_removed", kept).collect())


def test_query_against_plain_version(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((d.doc_id, *r) for d, r in zip(docs, repeats([d.text for d in docs], 35), strict=True))
    got = sorted(tuple(r) for r in QUERIES["op10_repeats"](spark, SMALL).collect())
    assert got == want


@pytest.mark.parametrize("window,run,seed", [(5, 2, 0), (5, 5, 1), (4, 1, 2), (7, 3, 3)])
def test_random_texts(spark, window, run, seed):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice("abcde") for _ in range(rng.randrange(0, 40))) for _ in range(40)]
    texts += ["a " * 50, "", None, "one", texts[3], texts[3], "é x\ty\x0bz\x1cq r " * 3, texts[3] + " é"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted((i, *r) for i, r in enumerate(repeats(texts, window)))
    assert digest(remove_repeats(df, window, run)) == want


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text, 1, b"x"), (1, "other", 2, b"y"), (1, "other", 3, b"z"), (None, None, 4, b"")]
    df = spark.createDataFrame(rows, "doc_id long, text string, copies long, digest binary")
    got = remove_repeats(df).collect()
    assert sorted(r.n_removed for r in got) == [0, 0, 0, 0]
    twice = remove_repeats(df.union(df)).where("n_words = 60").collect()
    assert [(r.n_removed, r.kept) for r in twice] == [(60, ""), (60, "")]
    assert remove_repeats(df.limit(0)).count() == 0


def test_long_text(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    tail = " ".join(f"w{i}" for i in range(199_900, 200_000))
    df = spark.createDataFrame([(1, long), (2, tail)], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.kept) for r in remove_repeats(df).collect()}
    assert got[1][0] == got[2][0] == 100 and got[2][1] == ""
    kept = " ".join(f"w{i}" for i in range(199_900))
    assert hashlib.sha256(got[1][1].encode()).digest() == hashlib.sha256(kept.encode()).digest()
