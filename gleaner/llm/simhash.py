"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints within ``distance`` bits of each other have a common variant within
half that radius of both.  Equal fingerprints are one row first.  Every distinct
fingerprint emits its ball's variants (itself and each one-bit change for
distance 2); a shuffle on the variant brings colliding fingerprints together, at
most the size of the ball in a group, so no group is large.  The least one of a
group is paired with the others (a star joins the group as all pairs would),
pairs are made distinct and verified by counting bits, and components are united.

Bits come from word shingles: a bit is 1 if it is set in over half of the shingle
hashes, repeats included.  Texts of fewer words than a shingle are one shingle;
texts without words (and nulls) have fingerprint 0 and are linked like any other.
Repeated doc_ids give repeated rows with one component.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import cut, let_go, release, stash
from gleaner.llm.components import components
from gleaner.session import ship

BITS = 64
SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """The fingerprint as a signed 64-bit integer."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: A-Z only, and white space is space and 9 to 13
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    one = xxhash.xxh64_intdigest
    hashes = np.fromiter((one(g, SEED) for g in grams), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(key, fp long) of every row."""
    kind = dict(docs.dtypes)[key]

    def run(batches):
        let_go()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], pa.int64())], [key, "fp"])

    ship(docs.sparkSession)
    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, fp long")


def ball(radius: int, bits: int = BITS) -> list[int]:
    """Masks of up to radius of the lowest bits, as signed 64-bit integers."""
    masks = [sum(1 << i for i in some) for n in range(radius + 1) for some in combinations(range(bits), n)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def links(fps: DataFrame, distance: int = 2, bits: int = BITS) -> DataFrame:
    """(a, b): distinct pairs of fingerprints within distance (even); every group of the table's fp is joined by them."""
    masks = F.array(*[F.lit(m).cast("long") for m in ball(distance // 2, bits)])
    variants = fps.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("variant"))
    # a group is a subset of the variant's own ball: its size is bounded, and the aggregates carry numbers only
    groups = variants.groupBy("variant").agg(F.min("fp").alias("a"), F.max("fp").alias("z"), F.count("*").alias("n")).filter("a < z")
    pairs = groups.filter("n = 2").select("a", F.col("z").alias("b"))
    more = groups.filter("n > 2").select("variant", "a")
    # the members of larger groups are found from the variant itself: its ball, met with the fingerprints
    members = more.select("a", F.explode(F.transform(masks, lambda m: F.col("variant").bitwiseXOR(m))).alias("fp")).filter("a <> fp").distinct()
    pairs = pairs.unionAll(members.join(fps.select("fp"), "fp", "left_semi").select("a", F.col("fp").alias("b"))).distinct()
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """(key, fp, component) of every row: component is the smallest key that links reach."""
    table = cut(fingerprints(docs, key, text, shingle))
    return classes(table, key, distance)


def classes(table: DataFrame, key: str = "doc_id", distance: int = 2) -> DataFrame:
    fps = cut(table.groupBy("fp").agg(F.min(key).alias("_least")))
    joined = components(links(fps, distance))
    by_fp = fps.join(joined.select(F.col("node").alias("fp"), F.col("component").alias("_root")), "fp", "left").withColumn("_root", F.coalesce("_root", "fp"))
    least = by_fp.groupBy("_root").agg(F.min("_least").alias("component"))
    found = by_fp.join(least, "_root").select("fp", "component")
    return table.join(found, "fp").select(key, "fp", "component")


def to_hex(column):
    return F.lpad(F.lower(F.hex(column)), 16, "0")


#: For similarity of sets of shingles: keys of a text, and least hashes in each. A pair at 0.8 has none in common with probability
#: (1 - 0.8**5)**48 = 5e-9, whatever the number of texts.
BANDS, BAND_ROWS = 48, 5
#: Fingerprints of near-duplicates: words in a shingle and bits that may differ, as in op3_simhash.
PRINT_WORDS, DISTANCE = 3, 2
#: Where rounds of comparing a key's least member with the others begin and end.
ROUNDS = (0, 1, 4, 16, BANDS)
_MASKS = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS * BAND_ROWS), np.uint64, endpoint=False)


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Distinct hashes of a text's shingles, sorted; empty for a text without words."""
    import xxhash

    words = (text or "").encode().lower().split()
    grams = [b" ".join(words)] if 0 < len(words) <= shingle else map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    one = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((one(g, SEED) for g in grams), np.uint64))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key of each band: a 64-bit hash of BAND_ROWS least hashes of the set; sets without members have equal keys."""
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), 1024):
            part = (hashes[None, at : at + 1024] ^ _MASKS[0][:, None]) * (_MASKS[1][:, None] | np.uint64(1))
            np.minimum(least, part.min(1), out=least)
        keys = np.arange(BANDS, dtype=np.uint64)
        for column in least.reshape(BANDS, BAND_ROWS).T:
            keys = (keys ^ column) * np.uint64(0xFF51AFD7ED558CCD)
            keys ^= keys >> np.uint64(33)
    return keys.view(np.int64)


def first_pairs(members: DataFrame, similarity: float) -> DataFrame:
    """(a, b): the first member of each key with its others; members: (key, id, n, own, hub), hub the least (own, id, n) of the key."""
    like = F.least(F.expr("n - own"), F.expr("hub.n - hub.own")) * (1 + similarity) >= similarity * F.expr("n + hub.n") * (1 - 1e-9)
    return members.filter((F.col("id") != F.col("hub.id")) & like).select(F.least("hub.id", "id").alias("a"), F.greatest("hub.id", "id").alias("b")).distinct()


def apart(pairs: DataFrame, found: DataFrame | None) -> DataFrame:
    """pairs (a, b) that ``found`` (node, component) has not joined yet."""
    if found is None:
        return pairs
    group = lambda x: found.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    return pairs.join(group("a"), "a", "left").join(group("b"), "b", "left").filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def other_pairs(members: DataFrame, found: DataFrame, shingles: DataFrame, similarity: float) -> DataFrame:
    """(a, b): pairs that may be alike of members whose keys lie in several groups of ``found`` (node, component), the two in different ones.

    shingles: (id, s). Members meet by their rarest shingles. A shingle that is number i of n in one and number j of m in the other, rarest
    first and the first that they share, leaves at most the lesser of n - i and m - j in common: a hot shingle late in either brings no pair.
    """
    marked = members.join(found.withColumnRenamed("node", "id"), "id", "left").select("key", "id", "n", F.coalesce("component", "id").alias("c"))
    mixed = marked.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y")).filter("x < y").select("key")
    rest = cut(marked.join(mixed, "key", "left_semi").select("id", "n", "c").distinct())
    of_rest = shingles.join(rest.select("id"), "id", "left_semi")
    times = of_rest.groupBy("s").agg(F.count("*").alias("times")).filter("times > 1")
    by_id = Window.partitionBy("id")
    ranked = of_rest.join(times, "s").withColumn("at", F.row_number().over(by_id.orderBy("times", "s")) - 1).withColumn("shared", F.count("*").over(by_id)).join(rest, "id")
    room = F.col("shared") - F.col("at")  # those found nowhere else come first
    heads = cut(ranked.select("s", "id", "n", "c", room.alias("room")).filter(F.col("room") >= similarity * F.col("n") * (1 - 1e-9)))
    a, b = (heads.select(F.col("s").alias(f"s{x}"), F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("c").alias(f"c{x}"), F.col("room").alias(f"r{x}")) for x in "ab")
    like = F.least("ra", "rb") * (1 + similarity) >= similarity * (F.col("na") + F.col("nb")) * (1 - 1e-9)
    return a.join(b, (F.col("sa") == F.col("sb")) & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & like).select("a", "b").distinct()


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8, distance: int | None = None) -> DataFrame:
    """(h1, h2, key, component, keeper) of every text under every key, for texts that are like another's.

    Alike: equal, or with a Jaccard similarity of the shingle sets of at least ``similarity``; with a ``distance`` also those whose
    SimHash fingerprints (of PRINT_WORDS-word shingles) are within so many bits.  Fingerprints come first: what they have joined is not
    compared again.  h1, h2: hashes of a text; component: the least (key, h1) of its group; keeper: whether the row is that one.  Equal texts are one row
    first, known by h1.  Texts meet by keys of least hashes: unlike texts share none by chance, however many there
    are.  All pairs of a key are compared on their shingles, save those already in one group: first the member with the
    fewest shingles of its own (found in no other text that shares a key) with the others, as it is likest to them,
    then the pairs of members that this has left in different groups and that share a shingle rare enough for both
    (``other_pairs``).  Neither step leaves out a pair that can reach the similarity.  Texts without words are like
    equal ones only; null texts, and texts without a key, are like nothing.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = dict(docs.dtypes)[key]
    body = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("t")).filter("t is not null and key is not null").select("key", *text_hashes("t"), "t")

    def run(batches):
        let_go()
        for b in batches:
            sets = [shingle_set(t.as_py(), shingle) for t in b.column(3)]
            prints = [fingerprint(t.as_py(), PRINT_WORDS) if distance is not None and len(x) else None for t, x in zip(b.column(3), sets)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([len(x) for x in sets], pa.int64()), pa.array([band_keys(x) for x in sets], pa.list_(pa.int64())), pa.array(prints, pa.int64())], ["key", "h1", "h2", "n", "keys", "fp"])

    # texts are read where they lie, for their keys and for the shingles of those that meet: only the second time do they move
    read = stash(body.mapInArrow(run, f"key {kind}, h1 long, h2 long, n long, keys array<long>, fp long"))
    same = read.select("key", "h1", "h2")
    first = stash(read.groupBy("h1", "h2").agg(F.min("key").alias("first"), F.max("key").alias("last"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("fp").alias("fp")))
    release(spark)
    near = None
    if distance is not None:
        printed = classes(first.filter("fp is not null").select(F.col("h1").alias("id"), "fp"), "id", distance)
        near = cut(printed.filter("id <> component").select(F.col("component").alias("a"), F.col("id").alias("b")))
        release(spark)
    members = first.filter("n > 0").select(F.col("h1").alias("id"), "n", F.posexplode("keys").alias("band", "key"))
    shared = members.groupBy("key").agg(F.count("*").alias("times")).filter("times > 1").select("key")
    members = stash(members.join(shared, "key"))
    release(spark)

    # the shingles of the texts that share a key
    wanted = members.select("id").distinct().join(first.select(F.col("h1").alias("id"), F.col("first").alias("key")), "id")

    def shingles(batches):
        let_go()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_set(t.as_py(), shingle).tobytes() for t in b.column(1)], pa.binary())], ["id", "s"])

    texts = body.select("key", F.col("h1").alias("id"), "t").join(wanted, ["key", "id"], "left_semi").select("id", "t")
    sets = stash(texts.mapInArrow(shingles, "id long, s binary").dropDuplicates(["id"]))
    release(spark)

    def members_of(batches):
        let_go()
        for b in batches:
            for i, s in zip(b.column(0), b.column(1)):
                one = np.frombuffer(s.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(one), i.as_py())), pa.array(one)], ["id", "s"])

    # how many of a text's shingles no other text has
    spread = sets.mapInArrow(members_of, "id long, s long")
    single = spread.groupBy("s").agg(F.min("id").alias("id"), F.count("*").alias("times")).filter("times = 1")
    own = single.groupBy("id").agg(F.count("*").alias("own"))
    members = members.join(own, "id", "left").withColumn("own", F.coalesce("own", F.lit(0))).filter(F.col("n") - F.col("own") >= similarity * F.col("n") * (1 - 1e-9))
    members = cut(members)
    hubs = members.groupBy("key").agg(F.min(F.struct("own", "id", "n")).alias("hub"), F.count("*").alias("times")).filter("times > 1").drop("times")
    members = stash(members.join(hubs, "key"))
    release(spark)

    def verify(batches):
        let_go()
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common >= similarity * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(keep, pa.bool_())), b.column(1).filter(pa.array(keep, pa.bool_()))], ["a", "b"])

    side = lambda name: sets.select(F.col("id").alias(name), F.col("s").alias(f"s{name}"))
    checked = lambda pairs: cut(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb").mapInArrow(verify, "a long, b long"))
    # the first keys join most of a large group, so that the others have little to compare
    found = None if near is None else cut(components(near))
    # groups of earlier rounds go on as a star each
    joined = lambda pairs: components(pairs if found is None else found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(pairs))
    for low, high in zip(ROUNDS, ROUNDS[1:]):
        found = cut(joined(checked(apart(first_pairs(members.filter(F.col("band").between(low, high - 1)), similarity), found))))
        release(spark)
    roots = joined(checked(other_pairs(members, found, spread, similarity))).withColumnRenamed("node", "h1")
    known = first.join(roots, "h1", "left").select("h1", "h2", F.expr("if(first = last, 1, 2)").alias("size"), F.coalesce("component", "h1").alias("root"), F.struct(F.col("first").alias("key"), "h1").alias("own"))
    groups = known.groupBy("root").agg(F.min("own").alias("least"), F.sum("size").alias("size")).filter("size > 1").drop("size")
    known = known.join(groups, "root").select("h1", "h2", "least")
    return same.distinct().join(known, ["h1", "h2"]).select("h1", "h2", F.col("key").alias(key), F.col("least.key").alias("component"), F.expr("h1 = least.h1 and key = least.key").alias("keeper"))


def text_hashes(text: str):
    """Two 64-bit hashes of a text."""
    return F.xxhash64(F.col(text)).alias("h1"), F.xxhash64(F.lit(1), F.col(text)).alias("h2")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8, distance: int | None = DISTANCE) -> DataFrame:
    """docs without those that are like a document of smaller key in their group (``similar_groups``); all columns are kept, whatever their names.

    Rows that repeat a document (its key and its text) stay or go with it; other texts under its key are documents of
    their own.  Null texts and rows without a key stay, and so does one of several empty texts.
    """
    body = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.xxhash64(body).alias("h1"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), body.isNull().alias("none"))
    gone = similar_groups(docs, key, text, shingle, similarity, distance).filter("not keeper").select(F.col(key).alias("of"), F.col("h1").alias("h")).distinct()
    same = (F.col("key") == F.col("of")) & (F.col("h1") == F.col("h")) & ~F.col("none")
    return rows.join(gone, same, "left_anti").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
