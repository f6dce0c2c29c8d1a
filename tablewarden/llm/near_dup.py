"""Near-duplicate texts: an exact Jaccard join on word shingles, size-aware.

Small sets enumerate the subsets that a similar set must share, one key for each; large sets scan
inverted lists over their lowest hashes. The boundary between the two is where the summed costs are
least. Equal sets are one set throughout.

Lists of ordinary length give pairs with counts of shared entries. Long lists, of passages that many
texts hold or of large groups of copies, give no pairs: sets that consist of such entries to the
degree that similarity demands are clustered over them. Candidate pairs and clusters are verified
exactly, cluster by cluster, large clusters block by block and only between sets of similar size.
"""
from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    components, documents, hash64, key_filter, keep_rows, lookup, may_hold, root, slices, staged,
    text_bytes, union, with_row,
)
from .words import shingles

#: Two sets are similar if 100 * intersection >= PERCENT * union.
PERCENT = 80
SHINGLE = 5
#: Sets up to this size may be enumerated; the costs decide up to which size they are.
SMALL_MOST = 24
#: Cost of one inverted-list entry, in subset keys.
_ENTRY_COST = 8
#: Lists of so many sets are long.
LONG = 32
#: At most 2 ** HOT_BITS entries are known as long before their lists are gathered.
HOT_BITS = 20
#: Entries that one task gathers, sets that one task compares, sets in a block of a large cluster.
TASK_ENTRIES, TASK_SETS, BLOCK = 1_000_000, 4_000, 512
#: A similar pair is missed by the count filter with less than this probability, as by a collision.
_MISS = 1e-15


def required(a: int, b: int) -> int:
    """Least intersection of similar sets of these sizes."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def least_kept(n: np.ndarray) -> np.ndarray:
    """Entries that a set of size n shares at least with any similar set."""
    return -(-PERCENT * n // 100)


def partner_sizes(n: int) -> range:
    return range(-(-PERCENT * n // 100), 100 * n // PERCENT + 1)


def slack(n: np.ndarray) -> np.ndarray:
    return 1 + n // 16


def listed(n: np.ndarray) -> np.ndarray:
    """How many of its lowest hashes a set of size n enters into lists.

    Similar sets share ``slack`` of them at least: a set misses n - least_kept(n) at most.
    """
    return np.minimum(n, n - least_kept(n) + slack(n))


def needed(n: np.ndarray) -> np.ndarray:
    """Listed entries that a set of size n shares with any similar set: certainly ``slack``, and but
    for a probability of _MISS the Chernoff bound for a sample without replacement."""
    entries = np.maximum(listed(n), 1).astype(float)
    p, low, high = PERCENT / 100, np.zeros(len(n)), np.full(len(n), PERCENT / 100)
    for _ in range(50):
        q = (low + high) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            gap = np.where(q > 0, q * np.log(q / p), 0) + (1 - q) * np.log((1 - q) / (1 - p))
        rare = gap * entries >= -math.log(_MISS)
        low, high = np.where(rare, q, low), np.where(rare, high, q)
    return np.maximum(np.minimum(slack(n), n), np.floor(low * entries).astype(np.int64))


def subset_count(n: int) -> int:
    return sum(math.comb(n, required(n, m)) for m in partner_sizes(n))


def boundary(sizes: dict[int, int]) -> int:
    """The size up to which sets are enumerated, from the numbers of sets of each small size."""
    def cost(limit: int) -> int:
        total = 0
        for n, count in sizes.items():
            if n <= limit:
                total += count * subset_count(n)
            if 100 * n // PERCENT > limit:
                total += count * _ENTRY_COST * int(listed(np.array([n]))[0])
        return total

    return min(range(SMALL_MOST + 1), key=lambda limit: (cost(limit), limit))


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text_key, n, need, print, head): one row per document, texts left behind.

    ``print`` names the set and is null for an empty one; ``head`` holds its lowest hashes, all of
    them where the set is small.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = shingles(*text_bytes(part.column("text")), SHINGLE)
                n = np.array([len(s) for s in sets], np.int64)
                long = np.where(n <= SMALL_MOST, n, listed(n)).tolist()
                prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                          for s in sets]
                heads = [s[:k].tobytes() for s, k in zip(sets, long, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), part.column("text_key"),
                     pa.array(n), pa.array(needed(n)), pa.array(prints, pa.binary()),
                     pa.array(heads, pa.binary())], _SET_NAMES)

    return with_row(docs).mapInArrow(
        run, "row long, doc_id long, text_key long, n long, need long, print binary, head binary")


_SET_NAMES = ["row", "doc_id", "text_key", "n", "need", "print", "head"]


def small_links(sets: DataFrame, limit: int) -> DataFrame:
    """(a, b): links between sets of at most ``limit`` entries, by subset keys.

    Sets of sizes n and m share a key for n, m if and only if they share as many entries as they
    must, so every set of the one size links with every set of the other: two stars say it all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys, sizes, lows, highs = [], [], [], [], []
            for row, n, head in zip(*(batch.column(c).to_pylist() for c in ("row", "n", "head")),
                                    strict=True):
                entries = [head[i:i + 8] for i in range(0, 8 * n, 8)]
                for m in partner_sizes(n):
                    if not 1 <= m <= limit:
                        continue
                    low, high = min(n, m), max(n, m)
                    for subset in combinations(entries, required(n, m)):
                        key = b"%d,%d:" % (low, high) + b"".join(subset)
                        rows.append(row)
                        keys.append(hashlib.blake2b(key, digest_size=16).digest())
                        sizes.append(n)
                        lows.append(low)
                        highs.append(high)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(sizes, pa.int64()), pa.array(lows, pa.int64()),
                 pa.array(highs, pa.int64())], ["row", "key", "n", "low", "high"])

    keyed = staged(
        sets.filter(F.col("n").between(1, limit)).select("row", "n", "head").mapInArrow(
            run, "row long, key binary, n long, low long, high long"), "subsets")
    centres = keyed.groupBy("key").agg(
        F.min(F.when(F.col("n") == F.col("low"), F.col("row"))).alias("of_low"),
        F.min(F.when(F.col("n") == F.col("high"), F.col("row"))).alias("of_high"),
        F.count("*").alias("held")).filter("held > 1")
    met = keyed.join(centres, "key")
    centre = F.when(F.col("n") == F.col("low"), F.col("of_high")).otherwise(F.col("of_low"))
    return met.select(F.col("row").alias("a"), centre.alias("b")).filter(
        "b is not null and a != b")


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set number, size, hash) of the listed entries of a batch of heads."""
    data, offsets = text_bytes(batch.column("head"))
    hashes = np.frombuffer(data.tobytes(), "<u8")
    n = batch.column("n").to_numpy()
    held = np.diff(offsets) // 8
    number = np.repeat(np.arange(batch.num_rows), held)
    place = np.arange(len(hashes)) - np.repeat(offsets[:-1] // 8, held)
    use = place < np.repeat(listed(n), held)
    return number[use], n, hashes[use]


def hot_entries(large: DataFrame, entries: int) -> np.ndarray:
    """Sorted hashes that very many sets list, known before lists are gathered; 2 ** HOT_BITS at most.

    Each task counts its own entries; those it meets once stay behind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "head", 8 * SLICE_ENTRIES):
                hashes, counts = np.unique(_entries(part)[2], return_counts=True)
                more = counts > 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[more].view(np.int64)), pa.array(counts[more])], ["hash", "n"])

    least = max(8 * LONG, math.ceil(entries / (1 << HOT_BITS)))
    counted = large.select("n", "head").mapInArrow(run, "hash long, n long")
    hot = counted.groupBy("hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    found = np.array([r[0] for r in hot.select("hash").collect()], np.int64).view(np.uint64)
    return np.sort(found)


SLICE_ENTRIES = 500_000
_SETS = np.dtype([("row", "<i8"), ("n", "<i4"), ("held", "<i4")])


def _in_sorted(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if len(known) == 0:
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def shared_entries(large: DataFrame, entries: int, hot, parts: int) -> DataFrame:
    """(a, b, shared, need): with b a row, sets a and b share that many entries of ordinary lists; with
    ``shared`` null, set a lists the long entry b.

    Entries travel packed, by ranges of their hash, and a task joins a range with sorting alone.
    """
    buckets = max(parts, math.ceil(entries / TASK_ENTRIES))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "head", 8 * SLICE_ENTRIES):
                number, n, hashes = _entries(part)
                ordinary = ~_in_sorted(hashes, hot.value)
                number, hashes = number[ordinary], hashes[ordinary]
                bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(
                    np.int64)
                order = np.lexsort((number, bucket))
                number, hashes, bucket = number[order], hashes[order], bucket[order]
                rows = part.column("row").to_numpy()
                found, start = np.unique(bucket, return_index=True)
                ends = np.append(start[1:], len(bucket))
                sets, packed = [], []
                for a, b in zip(start.tolist(), ends.tolist(), strict=True):
                    who, held = np.unique(number[a:b], return_counts=True)
                    own = np.empty(len(who), _SETS)
                    own["row"], own["n"], own["held"] = rows[who], n[who], held
                    sets.append(own.tobytes())
                    packed.append(hashes[a:b].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.int64()), pa.array(sets, pa.binary()),
                     pa.array(packed, pa.binary())], ["bucket", "sets", "hashes"])

    def join(table: pa.Table) -> pa.Table:
        sets = np.frombuffer(b"".join(table.column("sets").to_pylist()), _SETS)
        hashes = np.frombuffer(b"".join(table.column("hashes").to_pylist()), "<u8")
        rows, place = np.unique(sets["row"], return_inverse=True)
        n = np.zeros(len(rows), np.int64)
        n[place] = sets["n"]
        who = np.repeat(place, sets["held"])
        a, b, shared, long_who, long_hash = count_shared(who, n, hashes)
        need = needed(n)
        return pa.table({
            "a": pa.array(np.concatenate([rows[a], rows[long_who]])),
            "b": pa.array(np.concatenate([rows[b], long_hash.view(np.int64)])),
            "shared": pa.array(np.concatenate([shared, np.zeros(len(long_who), np.int64)]),
                               mask=np.arange(len(a) + len(long_who)) >= len(a)),
            "need": pa.array(np.concatenate([np.minimum(need[a], need[b]), need[long_who]]))})

    packed = large.select("row", "n", "head").mapInArrow(
        spread, "bucket long, sets binary, hashes binary")
    return packed.groupBy("bucket").applyInArrow(join, "a long, b long, shared long, need long")


def count_shared(who: np.ndarray, n: np.ndarray, hashes: np.ndarray):
    """Pairs (a < b) of sets on lists of ordinary length, with their counts, and long entries.

    Pairs of sizes that cannot be similar are left out.
    """
    order = np.lexsort((who, hashes))
    who, hashes = who[order], hashes[order]
    start = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else (
        np.empty(0, np.int64))
    held = np.diff(np.append(start, len(hashes)))
    long = np.repeat(held >= LONG, held)
    keys = [np.empty(0, np.int64)]
    for size in np.unique(held[(held > 1) & (held < LONG)]).tolist():
        lists = who[start[held == size][:, None] + np.arange(size)]
        left, right = np.triu_indices(size, 1)
        for at in range(0, len(lists), max(1, 2_000_000 // len(left))):
            some = lists[at:at + max(1, 2_000_000 // len(left))]
            a, b = some[:, left].ravel(), some[:, right].ravel()
            near = 100 * np.minimum(n[a], n[b]) >= PERCENT * np.maximum(n[a], n[b])
            keys.append(a[near] * len(n) + b[near])
    pairs, shared = np.unique(np.concatenate(keys), return_counts=True)
    return (pairs // max(1, len(n)), pairs % max(1, len(n)), shared.astype(np.int64),
            who[long], hashes[long])


def hot_places(large: DataFrame, hot) -> DataFrame:
    """(a, b, need): set a lists the hot entry b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "head", 8 * SLICE_ENTRIES):
                number, _, hashes = _entries(part)
                found = _in_sorted(hashes, hot.value)
                rows, need = part.column("row").to_numpy(), part.column("need").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[number[found]]), pa.array(hashes[found].view(np.int64)),
                     pa.array(need[number[found]])], ["a", "b", "need"])

    return large.select("row", "n", "need", "head").mapInArrow(run, "a long, b long, need long")


def candidates(large: DataFrame, parts: int) -> DataFrame:
    """(a, b): edges such that similar large sets are in one component."""
    spark = large.sparkSession
    entries = large.agg(F.sum(F.length("head") / 8).cast("long")).first()[0] or 0
    hot = spark.sparkContext.broadcast(hot_entries(large, entries))
    met = staged(shared_entries(large, entries, hot, parts), "shared")
    long = met.filter("shared is null").select("a", "b", "need")
    if len(hot.value):
        long = long.unionByName(hot_places(large, hot))
    long = staged(long, "long")
    held = long.groupBy("a").agg(F.count("*").alias("held"), F.first("need").alias("need"))
    pairs = met.filter("shared is not null").groupBy("a", "b").agg(
        F.sum("shared").alias("shared"), F.first("need").alias("need"))
    pairs = staged(pairs, "pairs")
    sure = pairs.filter("shared >= need").select("a", "b")
    # A pair that is short of its need can only make it up with long entries of both sets.
    by_a = held.select("a", F.col("held").alias("held_a"))
    by_b = held.select(F.col("a").alias("b"), F.col("held").alias("held_b"))
    made_up = pairs.filter("shared < need").join(by_a, "a").join(by_b, "b").filter(
        F.col("shared") + F.least("held_a", "held_b") >= F.col("need")).select("a", "b")
    rich = held.filter("held >= need").select("a")
    rich_places = staged(long.select("a", "b").join(rich, "a"), "rich")
    centres = rich_places.groupBy("b").agg(F.min("a").alias("centre"))
    stars = lookup(rich_places, centres, "b")
    return sure.union(made_up).union(
        stars.select("a", F.col("centre").alias("b")).filter("a != b"))


def _unit_links(rows, sizes, sets, left, right) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of similar sets, ``left`` against ``right``; exact intersections."""
    use = left if left is right else np.concatenate([left, right])
    who = np.repeat(np.arange(len(use)), [len(sets[x]) for x in use])
    _, column, count = np.unique(
        np.concatenate([sets[x] for x in use]), return_inverse=True, return_counts=True)
    common = count > 1
    number = np.cumsum(common) - 1
    keep = common[column]
    who, column = who[keep], number[column[keep]]
    a = len(left)
    shared = np.zeros((a, len(use) if left is right else len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    who, column = who[order], column[order]
    width = max(64, min(8192, 8_000_000 // max(1, len(use))))
    total = int(common.sum())
    for at in range(0, total, width):
        lo, hi = np.searchsorted(column, [at, at + width])
        marks = np.zeros((len(use), min(width, total - at)), np.float32)
        marks[who[lo:hi], column[lo:hi] - at] = 1
        shared += marks[:a] @ (marks if left is right else marks[a:]).T
    both = sizes[left][:, None] + sizes[right][None, :]
    i, j = np.nonzero((100 + PERCENT) * shared.astype(np.int64) >= PERCENT * both)
    i, j = left[i], right[j]
    once = rows[i] < rows[j] if left is right else rows[i] != rows[j]
    return i[once], j[once]


def planned(member: DataFrame, parts: int) -> DataFrame:
    """Units of work, planned without the sets: doc_id, text_key, row, n, unit, side, bucket.

    A bucket holds about TASK_SETS rows, whatever the size of the clusters.
    """
    # Sizes of similar sets are in one band or in neighbouring ones.
    band = F.floor(F.log("n") / F.log(F.lit(100 / PERCENT)) + 1e-9).cast("int")
    whole = member.groupBy("cluster").agg(F.count("*").alias("held"))
    fields = ["doc_id", "text_key", "row", "n", "unit", "side"]
    sized = staged(member.withColumn("band", band).join(whole, "cluster"), "sized")
    small = sized.filter(F.col("held") <= BLOCK).select(
        "doc_id", "text_key", "row", "n", hash64("cluster", F.lit(-1)).alias("unit"),
        F.lit(0).alias("side"))
    large = sized.filter(F.col("held") > BLOCK)
    by_band = staged(large.groupBy("cluster", "band").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("rows")),
        "bands")
    near = by_band.select(
        "cluster", F.col("band").alias("other_band"), F.col("blocks").alias("other_blocks"))
    # A set of a large cluster goes to as many units as there are blocks in its band and beside it.
    sides = by_band.select("cluster", "rows", F.explode(
        F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("other_band"))
    copies = sides.join(near, ["cluster", "other_band"]).agg(
        F.sum(F.col("rows") * F.col("other_blocks"))).first()[0] or 0
    large = large.join(by_band.drop("rows"), ["cluster", "band"])
    large = large.withColumn("block", F.pmod(hash64("row"), "blocks").cast("int"))
    large = large.withColumn(
        "other_band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    large = large.join(near, ["cluster", "other_band"])
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("other_blocks") - 1)))
    own = F.struct(F.col("band").alias("band"), F.col("block").alias("block"))
    other = F.struct(F.col("other_band").alias("band"), F.col("other").alias("block"))
    large = large.withColumns({
        "unit": hash64("cluster", F.least(own, other), F.greatest(own, other)),
        "side": F.when(own == other, 0).when(own < other, 1).otherwise(2)})
    buckets = max(parts, math.ceil((small.count() + copies) / TASK_SETS))
    return small.unionByName(large.select(*fields)).withColumn(
        "bucket", F.pmod("unit", F.lit(buckets)))


def verified(docs: DataFrame, sets: DataFrame, clusters: DataFrame, parts: int) -> DataFrame:
    """(a, b): a spanning forest of the links between sets of one cluster (node, component).

    Texts of clustered sets are read again, found by a filter of bounded size; no other text moves.
    """
    spark = docs.sparkSession
    place = hash64("doc_id", "text_key")
    member = staged(
        clusters.select(F.col("node").alias("row"), F.col("component").alias("cluster"))
        .join(sets.select("row", "doc_id", "text_key", "n", place.alias("place")), "row"),
        "members")
    wanted = spark.sparkContext.broadcast(key_filter(member, "place"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("place").to_numpy()
            hit = may_hold(wanted.value, places)
            first = np.zeros(len(places), bool)
            first[np.unique(places, return_index=True)[1]] = True
            some = pa.RecordBatch.from_arrays(
                [c.filter(pa.array(hit & first)) for c in batch.columns], batch.schema.names)
            for part in slices(some):
                found = shingles(*text_bytes(part.column("text")), SHINGLE)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"),
                     pa.array([s.tobytes() for s in found], pa.binary())],
                    ["doc_id", "text_key", "hashes"])

    again = docs.withColumn("place", place).mapInArrow(
        read, "doc_id long, text_key long, hashes binary")

    units = planned(member, parts)
    same = [again[c].eqNullSafe(units[c]) for c in ("doc_id", "text_key")]
    work = units.join(again, same).select(
        units["bucket"], units["unit"], units["side"], units["row"], units["n"], again["hashes"])

    def compare(table: pa.Table) -> pa.Table:
        rows = table.column("row").to_numpy()
        sizes = table.column("n").to_numpy().astype(np.int64)
        side = table.column("side").to_numpy()
        groups: dict[int, list[int]] = {}
        seen = set()  # rows that repeat an id and a text bring their set more than once
        for at, unit in enumerate(zip(table.column("unit").to_pylist(), rows.tolist(),
                                      strict=True)):
            if unit not in seen:
                seen.add(unit)
                groups.setdefault(unit[0], []).append(at)
        parent: dict[int, int] = {}
        column = table.column("hashes")
        for members in groups.values():
            at = np.array(members)
            raw = column.take(pa.array(at)).to_pylist()
            sets = [np.frombuffer(x, "<u8") for x in raw]
            here = np.arange(len(at))
            left = here[side[at] < 2]
            right = left if not side[at].any() else here[side[at] == 2]
            if side[at].any():
                left = here[side[at] == 1]
            if len(left) and len(right) and len(at) > 1:
                i, j = _unit_links(rows[at], sizes[at], sets, left, right)
                for x, y in zip(rows[at][i].tolist(), rows[at][j].tolist(), strict=True):
                    union(parent, x, y)
        nodes = [x for x in parent if root(parent, x) != x]
        return pa.table({"a": pa.array(nodes, pa.int64()),
                         "b": pa.array([root(parent, x) for x in nodes], pa.int64())})

    return work.groupBy("bucket").applyInArrow(compare, "a long, b long")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, text_key.

    A text's set are its different shingles of five words (A-Z lower-cased, words end at ASCII white
    space), with fewer words the whole sequence, without words or text nothing. Documents link when
    100 * intersection >= 80 * union; empty sets link with nothing. ``component_id`` is the smallest
    doc_id reachable. One row of each component is kept: that with the smallest doc_id, a null id
    last, one of rows that repeat an id. An empty table gives no rows.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = documents(df, id_col, text_col)
    rows = staged(shingle_sets(docs), "sets")
    some = rows.filter(F.col("print").isNotNull())
    firsts = some.groupBy("print").agg(F.min("row").alias("row"))
    sets = staged(some.join(firsts.select("row"), "row", "left_semi"), "distinct")
    counts = sets.filter(F.col("n") <= SMALL_MOST).groupBy("n").count().collect()
    limit = boundary({r["n"]: r["count"] for r in counts})
    large = sets.filter(F.floor(F.col("n") * 100 / PERCENT) > limit)
    clusters = components(candidates(large, parts), "candidates")
    links = verified(docs, sets, clusters, parts)
    tops = components(links.union(small_links(sets, limit)), "links")
    by_print = sets.select("print", "row").join(
        tops.select(F.col("node").alias("row"), "component"), "row", "left").select(
        "print", F.coalesce("component", "row").alias("top"))
    members = staged(
        lookup(some.select("row", "doc_id", "text_key", "n", "print"), by_print, "print")
        .drop("print"), "grouped")
    lowest = members.groupBy("top").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("keep"))
    joined = lookup(members, lowest, "top")
    linked = joined.select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("keep.doc_id").alias("component_id"),
        (F.col("row") == F.col("keep.row")).alias("kept"), "text_key")
    alone = rows.filter(F.col("print").isNull()).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
        F.lit(True).alias("kept"), "text_key")
    return linked.unionByName(alone)


def drop_near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``df`` with one document of each group of near-duplicates, all its columns as they are."""
    return keep_rows(df, near_duplicates(df, id_col, text_col), id_col, text_col)
