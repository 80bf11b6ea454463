"""Secret scanning with a trigram inverted index, in DataFrame operations only.

Each rule is a regular expression.  Its Boolean trigram query is derived from the expression, the postings
(trigram, text) of the trigrams that any query names are written as a table, and intersecting them
per text gives the rules for which the text is a candidate.  Only candidates are matched by the
expression; a rule without mandatory trigrams is matched against every text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dinerlake.llm.common import written
from dinerlake.llm.trigrams import ANY, holds, trigram_query, trigrams_of


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0  # whose length decides
    least: int = 1
    base: bool = False


# The fixed rules, in their order, then those that this scanner adds.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 8, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, base=True),
    Rule("hex", r"[0-9a-f]+", 0, 32, base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abeprs]-[A-Za-z0-9-]+", 0, 20),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)


def digest() -> Column:
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """Rows (trigram, digest): the inverted index over the trigrams that the queries name."""
    low = texts.select("digest", F.lower("text").alias("low"))
    present = F.array_compact(F.array(*[
        F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams
    ]))
    return low.select("digest", F.explode(present).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, tuple | str]) -> DataFrame:
    """Rows (digest, kinds): the intersected postings of each rule."""
    found = index.groupBy("digest").agg(F.collect_set("trigram").alias("trigrams"))
    kinds = F.array_compact(F.array(*[
        F.when(holds(query, F.col("trigrams")), F.lit(kind)) for kind, query in queries.items()
    ]))
    return found.select("digest", kinds.alias("kinds")).where(F.size("kinds") > 0)


def full_match(rule: Rule) -> str:
    """An expression for matches that pass the length rule where it finds just those.

    A run of one class that is taken from its start passes or fails as a whole, so the least length
    may stand in the expression; it stays outside where a failing match takes text from others.
    """
    if rule.group == 0 and rule.pattern.startswith("[") and rule.pattern.endswith("]+"):
        return f"{rule.pattern[:-1]}{{{rule.least},}}"
    return rule.pattern


def matches(rule: Rule, wanted: Column) -> Column:
    """Matches of a rule as an array of (gap before it, its length, whether it counts)."""
    pattern = F.lit(full_match(rule))
    lengths = F.transform(F.regexp_extract_all("text", pattern, F.lit(0)), F.length)
    decisive = F.transform(F.regexp_extract_all("text", pattern, F.lit(rule.group)), F.length)
    gaps = F.transform(F.split("text", full_match(rule), -1), F.length)
    rows = F.zip_with(
        F.arrays_zip(lengths.alias("length"), decisive.alias("decisive")),
        F.slice(gaps, F.lit(1), F.size(lengths)),
        lambda m, gap: F.struct(
            gap.alias("gap"), m["length"].alias("length"), (m["decisive"] >= rule.least).alias("counts")),
    )
    return F.when(wanted & F.col("text").rlike(full_match(rule)), rows)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per text that holds a secret: digest, and ``spans``, an array of (start, place of the
    kind, end, kind) in order; code points, end exclusive.

    Equal texts are one row.  NULL and empty texts hold none.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {kind: query for kind, query in queries.items() if query != ANY}
    names = sorted(set().union(set(), *map(trigrams_of, indexed.values())))
    texts = docs.where(F.length("text") > 0).select(digest().alias("digest"), "text")
    if names:
        index = written(postings(texts, names), "postings")
        wanted = written(candidates(index, indexed), "candidates")
        texts = texts.join(wanted, "digest", "left")
    else:
        texts = texts.withColumn("kinds", F.lit(None).cast("array<string>"))

    def chosen(rule: Rule) -> Column:
        if rule.kind not in indexed:
            return F.lit(True)
        return F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))

    found = texts.select("digest", *[matches(r, chosen(r)).alias(r.kind) for r in rules])
    some = reduce(lambda a, b: a | b, [F.col(r.kind).isNotNull() for r in rules])
    once = written(
        found.where(some).groupBy("digest").agg(*[F.any_value(r.kind).alias(r.kind) for r in rules]),
        "matches",
    )
    by_kind = once.select("digest", F.explode(F.array(*[
        F.struct(F.lit(i).alias("place"), F.lit(r.kind).alias("kind"), F.col(r.kind).alias("found"))
        for i, r in enumerate(rules)
    ])).alias("rule")).select("digest", "rule.place", "rule.kind", F.posexplode("rule.found"))
    before = (
        Window.partitionBy("digest", "place").orderBy("pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    end = F.sum(F.col("col.gap") + F.col("col.length")).over(before).cast("int")
    spans = by_kind.select(
        "digest", "place", "kind", (end - F.col("col.length")).alias("start"), end.alias("end"),
        F.col("col.counts").alias("counts"),
    ).where("counts")
    return written(
        spans.groupBy("digest").agg(F.array_sort(F.collect_list(
            F.struct("start", "place", "end", "kind"))).alias("spans")),
        "secrets",
    )


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    ), ",")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: doc_id, n_<kind> per base rule, base_sha256, and ``spans`` of all rules.

    Repeated rows each get their result; NULL texts count as empty; an empty table gives no rows;
    other columns are ignored.
    """
    found = find_secrets(docs.select("text"), rules)
    rows = docs.select("doc_id", digest().alias("digest")).join(found, "digest", "left")
    spans = F.coalesce("spans", F.array().cast(found.schema["spans"].dataType))
    base = [r.kind for r in rules if r.base]
    rows = rows.select("doc_id", spans.alias("all"),
                       F.filter(spans, lambda s: s["kind"].isin(base)).alias("base"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id", *[count(kind) for kind in base],
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("all")).alias("spans"),
    )


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every secret replaced by ``[kind]``; overlapping secrets become one.

    All rows and columns stay; ``n_chars``, where present, follows the new text.
    """
    found = find_secrets(docs.select("text"), rules)
    flat = found.select("digest", F.explode("spans").alias("s")).select("digest", "s.*")
    order = Window.partitionBy("digest").orderBy("start", "place")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int")
    run = F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    merged = (
        flat.withColumn("opens", opens).withColumn("run", run).groupBy("digest", "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"),
             F.min_by("kind", F.struct("start", "place")).alias("kind"))
        .groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("cuts"))
    )
    cuts = written(merged, "cuts")
    rows = docs.select(F.struct("*").alias("row"), digest().alias("digest")).join(cuts, "digest", "left")
    text, last = F.col("row.text"), F.size("cuts")
    parts = F.transform("cuts", lambda cut, i: F.concat(
        F.substring(
            text, F.when(i > 0, F.get("cuts", i - 1)["end"]).otherwise(0) + 1,
            cut["start"] - F.when(i > 0, F.get("cuts", i - 1)["end"]).otherwise(0)),
        F.lit("["), cut["kind"], F.lit("]"),
    ))
    tail = F.substring(text, F.element_at("cuts", -1)["end"] + 1, F.length(text))
    new = F.when(last > 0, F.concat(F.array_join(parts, ""), tail)).otherwise(text)
    names = docs.columns
    out = rows.select(*[
        (new if name == "text" else F.col("row")[name]).alias(name) for name in names
    ])
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
