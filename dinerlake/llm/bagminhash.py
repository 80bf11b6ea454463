"""Near copies by BagMinHash.

A text is the bag of its five-word shingles (lower-case words between ASCII white space), and two texts are
near copies if the weighted Jaccard similarity of their bags, sum of minima over sum of maxima, is 0.8 or more.

Signature.  A shingle with weight w owns the Poisson processes of the weight intervals (0, 1], (1, 2], (2, 4],
(4, 8] ...; a process of an interval of length L has rate L, every point of it falls on one of the signature's
components and, halving the interval again and again, on one unit of weight.  Points beyond w are left out.  Each
component keeps its earliest point; two bags agree in a component with probability equal to their
similarity.  Only points before the time at which all components are filled are ever made.

Search.  Signatures are cut into bands; texts that share a band are candidates.  In every band bucket all
members are checked exactly against one centre.  What the centre leaves undecided is checked too: chance
meetings in a bucket join components, then prefix filtering (see ``crossing``) finds every link that is left
between components of a bucket.  So no pair of a bucket is lost, and groups of copies need no all-pairs work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dinerlake.llm.common import marked, numbered, scratch, thinned, written
from dinerlake.llm.components import components
from dinerlake.llm.substrings import lists, rolling
from dinerlake.llm.words import U, chunks, mixed, split

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 28, 4
COMPONENTS = BANDS * ROWS
PART = 32  # size of a chance meeting
DOC_BITS = 12
SHINGLE_MASK = U((1 << (64 - DOC_BITS)) - 1)
ODD = U(0x9E3779B97F4A7C15)


def nth(number: int) -> np.uint64:
    """A multiple of an odd constant, modulo 2^64."""
    return U(number * int(ODD) & (1 << 64) - 1)


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, each one's text, and each text's number of words.

    A text of one to four words is one shingle.
    """
    words = split(texts, lower=True)
    counts = np.diff(words.first)
    doc = np.repeat(np.arange(len(texts)), counts)
    hashes, owner = np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64)
    if len(words.hashes) >= SHINGLE:
        runs = rolling(words.hashes, SHINGLE)
        whole = doc[: len(runs)] == doc[SHINGLE - 1 :]
        hashes, owner = mixed(runs[whole]), doc[: len(runs)][whole]
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    few = [
        mixed(rolling(words.hashes[words.of(i)], int(counts[i])) + U(counts[i])) for i in short
    ]
    return np.concatenate([hashes, *few]), np.concatenate([owner, short]), counts


def bags(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with their weight: text, shingle (52 bits), weight; in order."""
    keys = np.sort((owner.astype(U) << U(64 - DOC_BITS)) | (hashes >> U(DOC_BITS)))
    new = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    weight = np.diff(np.append(new, len(keys)))
    keys = keys[new]
    return (keys >> U(64 - DOC_BITS)).astype(np.int64), keys & SHINGLE_MASK, weight


def processes(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray):
    """One process per weight interval that the weight reaches: text, seed, interval start, length."""
    docs, seeds, starts, lengths, tops = [doc], [shingle], [np.zeros(len(doc))], [np.ones(len(doc))], [weight]
    start, more = 1, np.flatnonzero(weight > 1)
    level = 1
    while len(more):
        docs.append(doc[more])
        seeds.append(shingle[more] ^ nth(level))
        starts.append(np.full(len(more), float(start)))
        lengths.append(np.full(len(more), float(start)))
        tops.append(weight[more])
        start, level = 2 * start, level + 1
        more = more[weight[more] > start]
    return tuple(np.concatenate(x) for x in (docs, seeds, starts, lengths, tops))


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int,
               size: int = COMPONENTS) -> np.ndarray:
    """Earliest point per text and component (infinite for a text without shingles)."""
    total = np.bincount(doc, weight, minlength=n)
    horizon = size * (np.log(size) + 5) / np.maximum(total, 1)
    out = np.full((n, size), np.inf)
    open_ = total > 0
    while open_.any():
        some = open_[doc]
        part = np.full(n * size, np.inf)
        own, seed, start, length, top = processes(doc[some], shingle[some], weight[some])
        time, number = np.zeros(len(own)), 0
        while len(own):
            number += 1
            bits = mixed(seed + nth(number))
            time = time - np.log(((bits >> U(20)).astype(float) + 0.5) * 2.0**-44) / length
            live = time <= horizon[own]
            own, seed, start, length, top, time, bits = (
                x[live] for x in (own, seed, start, length, top, time, bits))
            component = (((bits & U(0xFFFFF)) * U(size)) >> U(20)).astype(np.int64)
            place = start + length * ((mixed(bits) >> U(11)).astype(float) * 2.0**-53)
            inside = (start == 0) | (place < top)
            np.minimum.at(part, own[inside] * size + component[inside], time[inside])
        part = part.reshape(n, size)
        done = open_ & (part.max(axis=1) <= horizon)
        out[done] = part[done]
        open_ &= ~done
        horizon = np.where(open_, 2 * horizon, horizon)
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """One hash per band, different for different bands."""
    bits = signature.view(U).reshape(len(signature), BANDS, ROWS)
    out = np.tile(mixed(np.arange(1, BANDS + 1, dtype=U)), (len(signature), 1))
    for row in range(ROWS):
        out = mixed(out * ODD + bits[:, :, row])
    return out.view(np.int64)


def bag_digests(hashes: np.ndarray, owner: np.ndarray, n: int) -> list[bytes]:
    """128 bits per text that do not depend on the order of the shingles."""
    sums = np.zeros((n, 2), dtype=U)
    order = np.argsort(owner, kind="stable")
    own, begin = np.unique(owner[order], return_index=True)
    for lane, salt in enumerate((U(0x5851F42D4C957F2D), U(0x14057B7EF767814F))):
        if len(own):
            sums[own, lane] = np.add.reduceat(mixed(hashes ^ salt)[order], begin)
    return [row.tobytes() for row in sums]


PROFILE = pa.schema([("id", pa.int64()), ("digest", pa.binary()), ("bag", pa.binary()),
                     ("bands", pa.list_(pa.int64()))])
BAG = pa.schema([("bag", pa.int64()), ("centres", pa.list_(pa.int64())), ("elements", pa.list_(pa.int64()))])


def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, some in chunks(batch.column("text").to_pylist()):
            hashes, owner, counts = shingles(some)
            found = bands(signatures(*bags(hashes, owner), len(some)))
            digests = bag_digests(hashes, owner, len(some))
            full = counts > 0
            own = batch.slice(begin, len(some))
            yield pa.RecordBatch.from_arrays([
                own.column("id"), own.column("digest"),
                pa.array([d if f else None for d, f in zip(digests, full, strict=True)], pa.binary()),
                lists([row if f else row[:0] for row, f in zip(found, full, strict=True)], pa.int64()),
            ], schema=PROFILE)


def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bag as a set: each shingle once per unit of its weight."""
    for batch in batches:
        for begin, some in chunks(batch.column("text").to_pylist()):
            doc, shingle, weight = bags(*shingles(some)[:2])
            unit = np.arange(int(weight.sum())) - np.repeat(np.cumsum(weight) - weight, weight)
            each = mixed(np.repeat(shingle, weight) + unit.astype(U) * ODD).view(np.int64)
            bounds = np.searchsorted(np.repeat(doc, weight), np.arange(len(some) + 1))
            own = batch.slice(begin, len(some))
            yield pa.RecordBatch.from_arrays([
                own.column("bag"), own.column("centres"),
                lists([each[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.int64()),
            ], schema=BAG)


def similarity(left: str, right: str) -> Column:
    """Exact weighted Jaccard similarity of two element sets."""
    shared = F.size(F.array_intersect(left, right))
    return shared / (F.size(left) + F.size(right) - shared)


def checked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b and others) with their exact similarity."""
    pairs = written(pairs, "pairs")
    right = thinned(sets.select(F.col("bag").alias("b"), F.col("elements").alias("b_set")), "b", pairs)
    return compared(pairs.join(right, "b"), sets, pairs)


def compared(halves: DataFrame, sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """Pairs that have the set of b already, with their exact similarity.  ``wanted``: a written table of all a."""
    left = thinned(sets.select(F.col("bag").alias("a"), F.col("elements").alias("a_set")), "a", wanted)
    others = [c for c in halves.columns if c != "b_set"]
    return halves.join(left, "a").select(*others, similarity("a_set", "b_set").alias("similarity"))


def shareable(sets: DataFrame) -> DataFrame:
    """Per bag its size, and how many of its elements (``common``) occur in another bag as well.

    More bags than needed can only raise ``common``, which stays a bound.
    """
    each = sets.select("bag", F.explode("elements").alias("element"))
    alone = each.groupBy("element").agg(F.count("*").alias("n"), F.any_value("bag").alias("bag")).where("n = 1")
    single = alone.groupBy("bag").agg(F.count("*").alias("single"))
    return sets.select("bag", F.size("elements").alias("size")).join(single, "bag", "left").select(
        "bag", "size", (F.col("size") - F.coalesce("single", F.lit(0))).alias("common"))


def links(slots: DataFrame, sets_of, least: float) -> DataFrame:
    """All links (a, b) between bags that share a band slot and are similar enough, up to
    links inside a component that other links already make.  ``slots``: slot, bag."""
    shared = written(slots.groupBy("slot").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    crowd = written(thinned(slots, "slot", shared).join(shared, "slot"), "crowd")
    # The member that meets most others over all its slots is the centre: in a group of edited
    # copies that is the text they come from, or the copy nearest to it.
    weight = written(crowd.groupBy("bag").agg(F.sum("n").alias("weight")), "weight")
    centres = written(
        crowd.select("slot", "bag").join(weight, "bag").groupBy("slot")
        .agg(F.max_by("bag", F.struct("weight", "bag")).alias("centre")),
        "centres",
    )
    members = written(crowd.select("slot", "bag").join(centres, "slot"), "members")
    # A set is made with the list of its centres (one per band at most), so it is sent to them without a
    # join that would first bring sets and pairs together.
    sets = sets_of(members.groupBy("bag").agg(
        F.collect_set(F.when(F.col("bag") != F.col("centre"), F.col("centre"))).alias("centres")))
    spokes = sets.select(F.explode("centres").alias("a"), F.col("bag").alias("b"), F.col("elements").alias("b_set"))
    first = written(compared(spokes, sets, centres.select(F.col("centre").alias("a"))), "spokes")
    strong = first.where(F.col("similarity") >= least).select("a", "b")
    roots = components(strong)

    placed = (
        members.where("bag <> centre")
        .join(roots.withColumnRenamed("node", "bag"), "bag", "left")
        .join(first.select(F.col("a").alias("centre"), F.col("b").alias("bag"), "similarity"),
              ["centre", "bag"])
        .select("slot", "bag", F.coalesce("root", "bag").alias("root"),
                (1 - F.col("similarity")).alias("distance"))
    )
    rest = written(undecided(written(placed, "placed")), "open")
    sizes = written(shareable(thinned(sets, "bag", rest)), "sizes")
    # Nothing else can come near a bag that keeps too little after its own elements.
    rest = written(rest.join(sizes, "bag").where(F.col("common") >= least * F.col("size") - 1e-9), "rest")

    # Chance meetings join what is plainly one group before the rest is searched.
    tried = written(checked(met(rest, least), sets), "tried")
    edges = tried.where(F.col("similarity") >= least).select(
        F.col("a_root").alias("a"), F.col("b_root").alias("b"))
    joined = components(edges).select(F.col("node").alias("root"), F.col("root").alias("new"))
    rest = rest.join(joined, "root", "left").select("slot", "bag", F.coalesce("new", "root").alias("root"))

    last = checked(crossing(rest, sets, least), sets).where(F.col("similarity") >= least)
    direct = roots.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))
    return written(direct.union(edges).union(last.select("a", "b")), "links", keep=True)


def crossing(rest: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of bags that may be links between components which still share a slot.

    ``rest``: slot, bag, root.  The elements of these bags are ordered by the number of bags that hold them,
    rarest first.  Bags of sizes m and n that are similar enough share t >= least / (1 + least) * (m + n)
    elements, so the first one they share stands among the first m - t + 1 and n - t + 1 of either; only
    such pairs meet, and of those only pairs with a member outside the largest component of a slot.  What a
    group of edited copies has in common is common, so it brings no pairs.
    """
    sides = rest.groupBy("slot", "root").agg(F.count("*").alias("n"))
    main = sides.groupBy("slot").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots")).where("roots > 1")
    bags = written(rest.join(main, "slot").groupBy("bag").agg(
        F.any_value("root").alias("root"), F.bool_or(F.col("root") != F.col("main")).alias("outside")), "outside")
    chosen = written(thinned(sets.select("bag", "elements"), "bag", bags).join(bags, "bag").withColumn(
        "size", F.size("elements")), "chosen")
    each = chosen.select("bag", F.explode("elements").alias("element"))
    counts = each.groupBy("element").agg(F.count("*").alias("n")).where("n > 1")
    shared = each.join(counts, "element").groupBy("bag").agg(
        F.array_sort(F.collect_list(F.struct("n", "element"))).alias("shared"))
    # A bag's own elements come first; they meet nothing but take their places.
    size, own = F.col("size"), F.col("size") - F.size("shared")
    length = F.greatest(F.lit(0), size - F.ceil(least * size - 1e-9) + 1 - own).cast("int")
    prefixes = written(chosen.join(shared, "bag").select(
        "bag", "root", "outside", "size", own.alias("own"),
        F.posexplode(F.slice("shared", F.lit(1), length)).alias("place", "entry")
    ).select("bag", "root", "outside", "size", (F.col("own") + F.col("place")).alias("place"),
             F.col("entry.element").alias("element")), "prefixes")
    a, b = prefixes.where("outside").alias("a"), prefixes.alias("b")
    needed = least / (1 + least) * (F.col("a.size") + F.col("b.size")) - 1e-9
    left = F.least(F.col("a.size") - F.col("a.place"), F.col("b.size") - F.col("b.place"))
    return a.join(b, F.col("a.element") == F.col("b.element")).where(
        (F.col("a.root") != F.col("b.root")) & (left >= needed)
        & (~F.col("b.outside") | (F.col("a.bag") < F.col("b.bag")))
    ).select(F.col("a.bag").alias("a"), F.col("b.bag").alias("b")).distinct()


def undecided(rows: DataFrame) -> DataFrame:
    """The rows of the slots whose members are still in several components."""
    several = rows.groupBy("slot").agg(F.min("root").alias("low"), F.max("root").alias("high")).where(
        "low < high").select("slot")
    return rows.join(written(several, "open"), "slot", "left_semi")


def sided(rows: DataFrame, side: str) -> DataFrame:
    """Every column but the slot under the name of its side of a pair."""
    return rows.select("slot", *[
        F.col(c).alias(side if c == "bag" else f"{side}_{c}") for c in rows.columns if c != "slot"])


def possible(least: float) -> Column:
    """Pairs of different components that no bound rules out: the triangle inequality through the
    slot's centre, and the elements that both can share."""
    near = F.abs(F.col("a_distance") - F.col("b_distance")) <= 1 - least + 1e-9
    overlap = least / (1 + least) * (F.col("a_size") + F.col("b_size")) - 1e-9
    return (F.col("a_root") != F.col("b_root")) & near & (F.least("a_common", "b_common") >= overlap)


def met(rows: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b and their roots): the members of a slot are dealt into parts of about ``PART``,
    and all of a part meet one of them."""
    counts = rows.groupBy("slot").agg(F.count("*").alias("n"))
    dealt = rows.join(counts, "slot").withColumn(
        "part", F.pmod(F.xxhash64("bag"), F.ceil(F.col("n") / PART))).drop("n")
    dealt = written(dealt, "dealt")
    one = dealt.groupBy("slot", "part").agg(F.max_by(
        F.struct("bag", "root", "distance", "size", "common"), F.xxhash64("bag", F.lit("one"))
    ).alias("one")).select("slot", "part", "one.*")
    a = sided(written(one, "one"), "a").withColumnRenamed("a_part", "part")
    b = sided(dealt, "b").withColumnRenamed("b_part", "part")
    pairs = b.join(a, ["slot", "part"]).where(possible(least))
    return pairs.select("a", "b", "a_root", "b_root").distinct()


def classified(docs: DataFrame, id_column: str, least: float) -> DataFrame:
    """Per document: ``id``, ``digest`` of its text, ``bag`` (NULL without a word), and of its class
    ``class_id``, ``class_size`` and ``first``, its least (no_id, id, digest)."""
    with scratch(docs.sparkSession):
        digest = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
        source = docs.select(F.col(id_column).cast("long").alias("id"), "text", digest.alias("digest"))
        every = written(
            source.mapInArrow(profile, "id long, digest binary, bag binary, bands array<long>"), "bags",
            keep=True)
        # One row per bag, under a number of its own: shorter to send than the digest.
        distinct = numbered(
            every.where(F.col("bag").isNotNull()).groupBy("bag").agg(
                F.min("id").alias("least_id"), F.count("*").alias("copies"),
                F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "digest")).alias("keeper"), F.any_value("bands").alias("bands")),
            "distinct",
        ).withColumnRenamed("bag", "bag_digest").withColumnRenamed("rid", "bag")
        slots = distinct.select(F.explode("bands").alias("slot"), "bag")

        def sets_of(wanted: DataFrame) -> DataFrame:
            # One key for id (it may be NULL) and digest: the join and the removal of repeated rows then share
            # a layout, and the texts move once.
            keepers = written(
                distinct.join(wanted, "bag").select("bag", "centres", F.struct("keeper.id", "keeper.digest").alias("key")),
                "keepers",
            )
            texts = thinned(source.select(F.struct("id", "digest").alias("key"), "text"), "key", keepers).join(
                keepers, "key").dropDuplicates(["key"])
            found = texts.select("bag", "centres", "text").mapInArrow(
                elements, "bag long, centres array<long>, elements array<long>")
            return written(found, "sets")

        roots = components(links(slots, sets_of, least))
        rooted = distinct.select("bag", "bag_digest", "least_id", "copies", "keeper").join(
            roots.withColumnRenamed("node", "bag"), "bag", "left"
        ).select("bag_digest", "least_id", "copies", "keeper", F.coalesce("root", "bag").alias("root"))
        rooted = written(rooted, "rooted")
        classes = written(
            rooted.groupBy("root").agg(F.min("least_id").alias("class_id"), F.sum("copies").alias("class_size"),
                                       F.min("keeper").alias("first"))
            .join(rooted.select("root", F.col("bag_digest").alias("bag")), "root")
            .select("bag", "class_id", "class_size", "first"),
            "classes", keep=True,
        )
    return every.select("id", "digest", "bag").join(classes, "bag", "left")


def near_copies(docs: DataFrame, id_column: str = "doc_id", least: float = SIMILARITY) -> DataFrame:
    """One row per document: the id, ``class_id`` (the least id of its class) and ``class_size``.

    A class is a connected component of near copies.  Texts without a word (NULL, empty, white space)
    are near copies of nothing: each is a class of its own.  Repeated rows and copies are one class.  A
    class whose ids are all NULL has a NULL class_id.  An empty table gives no rows; other columns are
    ignored.  A pair at similarity 0.8 shares no band with probability (1 - 0.8^4)^28 < 1e-6.
    """
    return classified(docs, id_column, least).select(
        F.col("id").alias(id_column),
        F.when(F.col("bag").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
    )


def one_of_each(docs: DataFrame, id_column: str = "doc_id", least: float = SIMILARITY) -> DataFrame:
    """The document with the least id of each class of near copies (NULL ids last), with all its columns.

    Of rows that repeat id and text one stays, the least by the other columns.  Documents without a word
    stay.  Only rows that may have to go are moved; all others are passed on where they are.
    """
    with scratch(docs.sparkSession):
        several = classified(docs, id_column, least).where("class_size > 1")
        verdicts = written(several.groupBy("id", "digest").agg(
            F.count("*").alias("rows"), F.any_value("first").alias("first")).select(
            F.col("id").alias("_id"), F.col("digest").alias("_digest"), "rows",
            (F.col("first.id").eqNullSafe(F.col("id")) & (F.col("first.digest") == F.col("digest"))).alias("stays")),
            "verdicts", keep=True)
    digest = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    flagged = marked(docs.withColumn("_digest", digest), "_digest",
                     verdicts.where("not stays or rows > 1"), "_may")
    others = [c for c in docs.columns if c not in (id_column, "text")]
    repeats = Window.partitionBy(id_column, "_digest").orderBy(F.to_json(F.struct(F.lit(0).alias("_"), *others)))
    judged = flagged.where("_may").join(
        verdicts.withColumnRenamed("_digest", "_of"),
        (F.col("_digest") == F.col("_of")) & F.col(id_column).cast("long").eqNullSafe(F.col("_id")), "left")
    kept = (
        judged.where(F.coalesce("stays", F.lit(True)))
        .withColumn("_row", F.when(F.col("rows") > 1, F.row_number().over(repeats)).otherwise(1)).where("_row = 1")
    )
    return flagged.where("not _may").select(*docs.columns).unionByName(kept.select(*docs.columns))
