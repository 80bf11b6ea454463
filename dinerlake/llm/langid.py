"""Language identification by string kernels.

Two texts are compared by the n-grams (1 to 3 letters, blended) present in both:
k(x, z) = |G(x) & G(z)| / sqrt(|G(x)| |G(z)|).  Landmark texts give Nystroem features K_xm K_mm^-1/2, on
which one ridge regression per language is fitted against the rest.  The kernel is linear in presence, so
landmarks and regressions fold into one matrix (n-gram x language); a batch of texts is scored by
one product of its presence matrix with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dinerlake.llm.common import fold

GRAM_BITS, BATCH = 20, 64
# Bounds of the fit: landmarks, training texts and n-grams.  Every language has one landmark and text at least.
MAX_LANDMARKS, MAX_TEXTS, MAX_GRAMS = 400, 8_000, 16_384
RIDGE = 1e-3
SPACE = 32


@dataclass(frozen=True)
class Model:
    langs: list[str]
    grams: np.ndarray  # hashes of the n-grams that count
    table: np.ndarray  # n-gram x language
    bias: np.ndarray


@cache
def letters() -> np.ndarray:
    """Code point -> its lower-case letter, or a space for everything that is no letter."""
    table = np.full(0x110000, SPACE, dtype=np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            table[point] = ord(char.lower()[0])
    return table


def gram_hashes(text: str) -> np.ndarray | None:
    """Hashes of all 1- to 3-grams of letters and single spaces; None if there is no letter."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = letters()[points]
    codes = codes[(codes != SPACE) | np.concatenate([[True], codes[:-1] != SPACE])]
    if not (codes != SPACE).any():
        return None
    codes = np.concatenate([[SPACE], codes, [SPACE]]).astype(np.uint32)
    one = codes * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + codes[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(0xC2B2AE35) + codes[2:]
    mixed = np.concatenate([one, two * np.uint32(0x27D4EB2F), three * np.uint32(0x165667B1)])
    return mixed >> np.uint32(32 - GRAM_BITS)


def gram_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = [gram_hashes(t) for t in batch["text"]]
        found = [i for i, s in enumerate(sets) if s is not None]
        yield pd.DataFrame({
            "lang": batch["lang"].iloc[found].to_numpy(),
            "order": batch["order"].iloc[found].to_numpy(),
            "grams": [np.unique(sets[i]).astype(np.int32).tolist() for i in found],
        })


class Presence:
    """Presence of the counted n-grams, a row per text."""

    def __init__(self, grams: np.ndarray) -> None:
        self.slot = np.full(1 << GRAM_BITS, -1, dtype=np.int32)
        self.slot[grams] = np.arange(len(grams), dtype=np.int32)
        self.n = len(grams)

    def rows(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Presence scaled by 1/sqrt of the set size, and which texts have a letter."""
        out = np.zeros((len(texts), self.n), dtype=np.float32)
        known = np.zeros(len(texts), dtype=bool)
        for i, text in enumerate(texts):
            hashes = gram_hashes(text) if text else None
            if hashes is not None:
                places = self.slot[hashes]
                out[i, places[places >= 0]] = 1.0
                known[i] = True
        sizes = out.sum(axis=1, keepdims=True)
        return out / np.sqrt(np.maximum(sizes, 1.0)), known


def fit(docs: DataFrame, max_texts: int = MAX_TEXTS, max_landmarks: int = MAX_LANDMARKS,
        max_grams: int = MAX_GRAMS) -> Model:
    """Learn every language from about ``max_texts`` labelled texts outside the held-out fold, equally many for each
    language, chosen by hash of the id.  Rows with NULL id, text or lang are not learned from.
    Without any, the model knows no language."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold() != 2))
    order = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(2**31))
    labelled = labelled.select("doc_id", "lang", "text", order.alias("order"))
    lettered = F.when(F.col("text").rlike(r"\p{L}"), F.col("order"))
    sizes = (
        labelled.groupBy("lang").agg(F.count("*").alias("count"), F.min(lettered).alias("first"))
        .where("first is not null").orderBy("lang").collect()
    )
    if not sizes:
        return Model([], np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros(0))
    spark = docs.sparkSession
    each = max(1, max_texts // len(sizes))
    cuts = spark.createDataFrame(
        [(r["lang"], max(r["first"] + 1, int(2**31 * min(1.0, each / r["count"])))) for r in sizes], "lang string, cut long"
    )
    # Many rows may share an id: at most twice the share of a language are taken, those with letters first.
    within = Window.partitionBy("lang").orderBy(F.desc(F.col("text").rlike(r"\p{L}")), "order", F.xxhash64("text"))
    sample = (
        labelled.join(F.broadcast(cuts), "lang").where(F.col("order") < F.col("cut"))
        .withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= 2 * each + 1)
        .select("lang", "text", "order")
    )
    rows = sample.mapInPandas(gram_sets, "lang string, order long, grams array<int>").collect()
    return solve(sorted(rows, key=lambda r: (r["lang"], r["order"], r["grams"])), max_landmarks,
                 max_grams)


def solve(rows: list, max_landmarks: int, max_grams: int) -> Model:
    langs = sorted({r["lang"] for r in rows})
    if not langs:
        return Model([], np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros(0))
    per_lang = max(1, max_landmarks // len(langs))
    taken: dict[str, int] = {}
    landmarks = []
    for row in rows:
        if taken.setdefault(row["lang"], 0) < per_lang:
            taken[row["lang"]] += 1
            landmarks.append(row["grams"])
    grams, counts = np.unique(np.concatenate(landmarks), return_counts=True)
    keep = np.sort(np.lexsort((grams, -counts))[:max_grams])
    grams = grams[keep].astype(np.int64)

    def scaled(sets: list) -> np.ndarray:
        out = np.zeros((len(sets), len(grams)), dtype=np.float32)
        for i, own in enumerate(sets):
            places = np.searchsorted(grams, own)
            places[places == len(grams)] = 0
            out[i, places[grams[places] == own]] = 1.0
        return out / np.sqrt(np.maximum(out.sum(axis=1, keepdims=True), 1.0))

    marks = scaled(landmarks)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    side = np.array([langs.index(r["lang"]) for r in rows])
    nystroem = np.concatenate([
        scaled([r["grams"] for r in rows[i : i + 500]]) @ marks.T @ root
        for i in range(0, len(rows), 500)
    ])
    wanted = np.where(side[:, None] == np.arange(len(langs)), 1.0, -1.0)
    centre, level = nystroem.mean(axis=0), wanted.mean(axis=0)
    phi = nystroem - centre
    gram = phi.T @ phi + RIDGE * len(rows) * np.eye(phi.shape[1])
    beta = np.linalg.solve(gram, phi.T @ (wanted - level))
    table = (marks.T @ root @ beta).astype(np.float32)
    return Model(langs, grams, table, level - centre @ beta)


def language(model: Model, text: str = "text") -> Column:
    """Struct of ``lang`` and ``score`` (0 to 1) from the text alone; ``und`` with score 0 for NULL,
    for a text without a letter, or if no language was learned.  Ties go to the first language."""
    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        presence = Presence(model.grams) if model.langs else None
        for texts in batches:
            langs, scores = ["und"] * len(texts), np.zeros(len(texts))
            for begin in range(0, len(texts) if presence else 0, BATCH):
                rows, known = presence.rows(texts.iloc[begin : begin + BATCH].tolist())
                values = rows @ model.table + model.bias
                choice = values.argmax(axis=1)
                for i in np.flatnonzero(known):
                    langs[begin + i] = model.langs[choice[i]]
                    scores[begin + i] = min(1.0, max(0.0, (values[i, choice[i]] + 1) / 2))
            yield pd.DataFrame({"lang": langs, "score": scores})

    return run(F.col(text))
