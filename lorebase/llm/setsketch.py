"""MinHash near-dedup over SetSketch registers: bands of registers, joint likelihood estimates, exact checks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from lorebase.llm.common import drop_stored, stored
from lorebase.llm.components import components
from lorebase.llm.simhash import shingle_hashes

SEED = 42
# Registers of a sketch come in BANDS bands of DEPTH. Sets of similarity s agree in no band with probability
# (1 - s^DEPTH)^BANDS: 2.6e-7 at 0.85, less above.
BANDS, DEPTH = 32, 6
REGISTERS = BANDS * DEPTH
# A register holds the truncated logarithm to BASE of the least exponential of rate RATE: 16 bits, sets of up to 1e18.
BASE, RATE, TOP = 1.001, 20.0, 2**16 - 1
# Pairs whose estimate lies this many standard deviations under the bound are not read in full.
DEVIATIONS = 5.5
# Bands of up to this many sets are paired as they are.
SMALL_BAND = 8
# A shingle is rare in a crowd if at most so many of its sets hold it.
RARE = 24
# So many candidates of a set are read in full before those that are left are cut to different components.
FIRST_TRIES = 3

BLOCK = 1 << 8
_RANDOM = np.random.default_rng(SEED)
FLIPS = _RANDOM.integers(0, 2**64, (REGISTERS, 1), np.uint64)
FACTORS = _RANDOM.integers(0, 2**64, (REGISTERS, 1), np.uint64) | np.uint64(1)


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Distinct shingles of a text as sorted 64-bit hashes; none for a text without words."""
    found = [np.array(x, np.uint64) for x in shingle_hashes(text.encode() if text else b"", shingle, SEED)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a set: per register floor(1 - log_BASE(x)) of the least of its exponential values x.

    Each element has a uniform value per register; the exponential value grows with it, so the least uniform value
    is taken first and turned into one logarithm per register. The sketch of a union is the maximum of the sketches.
    """
    least = np.full(REGISTERS, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), BLOCK):
        least = np.minimum(least, ((hashes[at : at + BLOCK] ^ FLIPS) * FACTORS).min(axis=1))
    value = -np.log1p(-(least + 0.5) / (2.0**64 + 2.0**12)) / RATE
    return np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, TOP).astype(np.uint16)


def _less(x: np.ndarray) -> np.ndarray:
    """Probability that a register of one set lies under that of the other, for a share `x` of elements of the other only."""
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def estimate(over: np.ndarray, under: np.ndarray, a_size: np.ndarray, b_size: np.ndarray) -> np.ndarray:
    """Similarity of largest likelihood, given how many registers of `a` lie over and under those of `b`, and the sizes."""
    a, b = a_size / (a_size + b_size), b_size / (a_size + b_size)
    equal = REGISTERS - over - under
    tiny = 1e-300

    def likelihood(j: np.ndarray) -> np.ndarray:
        p, q = _less(a - b * j), _less(b - a * j)
        return over * np.log(p + tiny) + under * np.log(q + tiny) + equal * np.log(np.clip(1 - p - q, tiny, 1))

    low, high = np.zeros(len(a)), np.minimum(a / b, b / a)
    for _ in range(40):
        left, right = low + (high - low) / 3, high - (high - low) / 3
        better = likelihood(left) < likelihood(right)
        low, high = np.where(better, left, low), np.where(better, high, right)
    return (low + high) / 2


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, version, node, n_shingles, sketch) per row of `docs`: `node` is one number per set, null for the empty one."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, held = [], [], []
            for text in batch.column("text"):
                hashes = shingle_set(text.as_py(), shingle)
                nodes.append(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes())).astype(np.int64) if len(hashes) else None)
                sizes.append(len(hashes))
                held.append(registers(hashes).tobytes() if len(hashes) else None)
            columns = [batch.column("doc_id"), batch.column("version"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(held, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "version", "node", "n_shingles", "sketch"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("version"), "text")
    return rows.mapInArrow(per_batch, f"doc_id {id_type}, version long, node long, n_shingles long, sketch binary")


def _band_members(sets: DataFrame) -> DataFrame:
    """(band, n, node, size) of the sets that share a band with others; n counts the sets of the band."""
    width = 2 * DEPTH
    bands = F.array(*[F.xxhash64(F.substring("sketch", width * i + 1, width), F.lit(i)) for i in range(BANDS)])
    entered = sets.select("node", "size", F.explode(bands).alias("band"))
    shared = entered.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return entered.join(stored(shared, "shared-bands"), "band")


def _whole_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles) of `wanted` (node, version), each version read once."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in enumerate(batch.column("text")):
                hashes = pa.array(shingle_set(text.as_py(), shingle).view(np.int64))
                one = pa.ListArray.from_arrays(pa.array([0, len(hashes)], pa.int32()), hashes)
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(row, 1), one], names=["node", "shingles"])

    # Each task drops its copies before the shuffle, so a text with very many copies fills no task.
    texts = docs.select(F.xxhash64("text").alias("version"), "text").dropDuplicates(["version"]).join(wanted, "version")
    return texts.select("node", "text").mapInArrow(per_batch, "node long, shingles array<long>")


def _rare_shingles(sets: DataFrame) -> DataFrame:
    """(hash, nodes): shingles that at most `RARE` of `sets` hold, and these. Tasks gather and count before they shuffle."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, nodes = batch.column("shingles"), batch.column("node").to_numpy()
            values, owners = lists.flatten().to_numpy(), np.repeat(nodes, np.diff(lists.offsets.to_numpy()))
            order = np.argsort(values, kind="stable")
            found, first, n = np.unique(values[order], return_index=True, return_counts=True)
            few = n <= RARE
            ends = np.concatenate([[0], np.cumsum(np.where(few, n, 0))]).astype(np.int32)
            held = pa.ListArray.from_arrays(pa.array(ends), pa.array(owners[order][np.repeat(few, n)]))
            yield pa.RecordBatch.from_arrays([pa.array(found), held, pa.array(n)], names=["hash", "nodes", "n"])

    counted = sets.select("node", "shingles").mapInArrow(per_batch, "hash long, nodes array<long>, n long")
    rare = counted.groupBy("hash").agg(F.sum("n").alias("n"), F.flatten(F.collect_list("nodes")).alias("nodes"))  # RARE of a batch at most
    return rare.filter(F.col("n") <= RARE).select("hash", "nodes")


def _likely(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """`pairs` (a, b, ...) whose estimate from the sketches does not rule out `percent`; adds `similarity`, the estimate."""
    bound = percent / 100
    bound -= DEVIATIONS * (bound * (1 - bound) / REGISTERS) ** 0.5
    names = pairs.columns

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            read = lambda name: np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint16).reshape(-1, REGISTERS)
            x, y = read("x"), read("y")
            found = estimate((x > y).sum(axis=1), (x < y).sum(axis=1), batch.column("x_size").to_numpy(), batch.column("y_size").to_numpy())
            kept = pa.array(found >= bound)
            rows = pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(found)], names=[*names, "similarity"])
            yield rows.filter(kept)

    left = sets.select(F.col("node").alias("a"), F.col("sketch").alias("x"), F.col("size").alias("x_size"))
    right = sets.select(F.col("node").alias("b"), F.col("sketch").alias("y"), F.col("size").alias("y_size"))
    met = pairs.join(left, "a").join(right, "b").select(*names, "x", "y", "x_size", "y_size")
    return met.mapInArrow(per_batch, ", ".join([f"{c} long" for c in names] + ["similarity double"]))


def _confirmed(pairs: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union, by their whole sets."""
    left = whole.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = whole.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    met = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", both.alias("both"), (F.size("x") + F.size("y")).alias("all"))
    return met.filter(100 * F.col("both") >= percent * (F.col("all") - F.col("both"))).select("a", "b")


def _fits(size: str, other: str, percent: int):
    """Sets of these sizes can be as similar as that."""
    return 100 * F.least(size, other) >= percent * F.greatest(size, other)


def _possible(percent: int, rare=0):
    """Two sets of a crowd share `rare` shingles that are rare there, and of the others at most what either has."""
    shared = F.least("common", "b_common") + rare
    return 100 * shared >= percent * (F.col("size") + F.col("b_size") - shared)


def _with_roots(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    return nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def near_links(docs: DataFrame, sets: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) between `sets` (node, version, size, sketch) whose components are those of all links.

    Sets that agree in a band are candidates. Bands of up to `SMALL_BAND` sets are paired. The sets of larger bands are the
    crowd: shingles that at most `RARE` of them hold are rare, and sets that share a rare one are paired. Two sets
    that share none have at most their other shingles in common, which for most texts with some changes of their own is
    too little: no such pair is made. Else every set of a large band is paired with the most central one, which meets the
    most others, and at last the sets outside its component are held against the other sets of the band.
    Candidates pass the sizes and the likelihood estimate, then the whole sets decide: first
    for the best three candidates of each set (in a crowd the most central ones), which joins most of a group, then for candidates
    between different components only. So of a group of copies about as many pairs as copies are read, and none that links
    different components is left out.
    """
    members = stored(_band_members(sets), "band-members")
    small = members.filter(F.col("n") <= SMALL_BAND).select("band", "node", "size")
    other = small.toDF("band", "b", "b_size")
    pairs = small.join(other, "band").filter((F.col("node") < F.col("b")) & _fits("size", "b_size", percent))
    pairs = pairs.select(F.col("node").alias("a"), "b")

    wanted = sets.select("node", "version").join(members.select("node").distinct(), "node")
    whole = stored(_whole_sets(docs, wanted.select("node", "version"), shingle), "whole-sets")

    crowd = members.filter(F.col("n") > SMALL_BAND).groupBy("node", "size").agg(F.sum("n").alias("fit"))
    rare = stored(_rare_shingles(whole.join(crowd.select("node"), "node", "left_semi")), "rare-shingles")
    per_node = rare.select(F.explode("nodes").alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("rare"))
    crowd = crowd.join(per_node, "node", "left").select("node", "size", (F.col("size") - F.coalesce("rare", F.lit(0))).alias("common"), "fit")
    crowd = stored(crowd, "crowd")
    crowded = members.filter(F.col("n") > SMALL_BAND).select("band", "node").join(crowd, "node")
    crowded = crowded.filter(100 * F.col("common") >= percent * F.col("size")).select("band", "node", "size", "common", "fit")
    crowded = stored(crowded, "crowded-members")
    central = crowded.groupBy("band").agg(F.max_by("node", F.struct("fit", "node")).alias("center"))
    central = stored(central, "centers")
    stars = crowded.join(central, "band").filter("node <> center")
    stars = stars.select(F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b"))
    sharing = rare.select(F.explode("nodes").alias("a"), "nodes").select("a", F.explode(F.filter("nodes", lambda b: b > F.col("a"))).alias("b"))
    sharing = sharing.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
    none = F.lit(0).cast("long").alias("shared")
    pairs = pairs.select("a", "b", none).union(stars.select("a", "b", none)).union(sharing).groupBy("a", "b").agg(F.max("shared").alias("shared"))
    pairs = pairs.join(crowd.toDF("a", "size", "common", "a_fit"), "a", "left").join(crowd.toDF("b", "b_size", "b_common", "b_fit"), "b", "left")
    pairs = pairs.filter(F.col("common").isNull() | F.col("b_common").isNull() | _possible(percent, F.col("shared")))
    likely = stored(_likely(pairs.select("a", "b", "a_fit", "b_fit"), sets, percent), "likely-pairs")
    both_ways = likely.select(F.col("a").alias("node"), F.struct("b_fit", "similarity", "a", "b").alias("way")).union(
        likely.select(F.col("b").alias("node"), F.struct("a_fit", "similarity", "a", "b").alias("way"))
    )
    order = W.partitionBy("node").orderBy(F.desc("way"))
    best = both_ways.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= FIRST_TRIES).select("way.a", "way.b").distinct()
    links = stored(_confirmed(best, whole, percent), "links")
    roots = stored(components(links), "roots")

    a_root, b_root = roots.toDF("a", "a_root"), roots.toDF("b", "b_root")
    open_pairs = likely.select("a", "b").join(a_root, "a", "left").join(b_root, "b", "left")
    open_pairs = open_pairs.filter(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")

    placed = _with_roots(crowded, roots)
    center_roots = _with_roots(central.select("band", F.col("center").alias("node")), roots).select("band", F.col("root").alias("center_root"))
    placed = stored(placed.join(center_roots, "band"), "placed-members")
    outside = placed.filter("root <> center_root").select("band", "node", "size", "common", "root")
    others = placed.select("band", F.col("node").alias("b"), F.col("size").alias("b_size"), F.col("common").alias("b_common"), F.col("root").alias("b_root"), "center_root")
    once = (F.col("b_root") == F.col("center_root")) | (F.col("node") < F.col("b"))
    rest = outside.join(others, "band").filter((F.col("root") != F.col("b_root")) & once & _fits("size", "b_size", percent) & _possible(percent))
    rest = rest.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
    rest = rest.join(likely, ["a", "b"], "left_anti")

    more = _confirmed(open_pairs.union(_likely(rest, sets, percent).select("a", "b")).distinct(), whole, percent)
    out = stored(links.union(more), "all-links")
    for used in (members, whole, rare, crowd, crowded, central, likely, roots, placed):
        drop_stored(used)
    return out


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of `docs` (doc_id, text, ...).

    A-Z are lower-cased; words are runs without white space (blank, code points 9 to 13); a text's set are its
    distinct `shingle`-word shingles, or all words as one if there are fewer. Texts link where
    100 * intersection >= percent * union of their sets; component_id is the smallest doc_id that can be reached, `kept` marks
    the rows that have it. Equal sets count once, so copies cost a row each; candidates come from bands of SetSketch
    registers and are confirmed on the whole sets (see `near_links`). BANDS and DEPTH are made for 80 percent or more.

    Null, empty and wordless texts have the empty set, which links with nothing. A null doc_id is never a component_id
    unless a component has no other; a row whose component_id is null is kept. Repeated rows come back each, and link.
    Long texts are hashed in pieces of 4 MB. No rows: no rows. Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    sketched = stored(sketches(docs, shingle), "sketches")
    held = sketched.filter("node is not null")
    sets = held.groupBy("node").agg(
        F.min("doc_id").alias("first"), F.min("version").alias("version"), F.max("n_shingles").alias("size"), F.any_value("sketch").alias("sketch")
    )
    sets = stored(sets, "distinct-sets")
    roots = components(near_links(docs, sets, shingle, percent))
    rooted = stored(_with_roots(sets.select("node", "first"), roots), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("first").alias("lowest"))
    ids = stored(rooted.join(lowest, "root").select("node", F.col("lowest").alias("component_id")), "component-ids")
    found = sketched.select("doc_id", "node", "n_shingles").join(ids, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    found = found.select("doc_id", "n_shingles", component.alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
