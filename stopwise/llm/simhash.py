"""SimHash near-dedup: fingerprints, pigeonhole blocks, verified links, components."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.llm.common import fresh, remove, require, shared_root, with_workers, written

SEED = 42
BITS = 64
#: Shingles hashed at a time; bounds the memory that a very long text needs.
STEP = 1 << 16
#: Fingerprints of a bucket that one task compares with each other. Larger buckets take the way over Hamming balls.
BUCKET = 1 << 14


def fingerprint(text: str | None, words: int) -> int:
    """SimHash of the text's word shingles; zero without words."""
    split = (text or "").encode().lower().split()  # on bytes both touch ASCII only
    if not split:
        return 0
    n = max(1, len(split) - words + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, STEP):
        part = split[at : min(at + STEP, n) + words - 1]
        grams = zip(*(part[i:] for i in range(words)), strict=False) if len(split) >= words else [split]
        values = np.fromiter((xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in grams), np.uint64)
        ones += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(text: Column, words: int = 3) -> Column:
    """A signed 64-bit SimHash for every text."""

    @F.arrow_udf(T.LongType())
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array((fingerprint(t.as_py(), words) for t in texts), pa.int64())

    return simhash(text)


def _masks(max_bits: int, shared: int) -> list[int]:
    """Masks of the unions of ``shared`` blocks out of ``max_bits + shared``: two fingerprints within ``max_bits`` agree on one."""
    blocks = max_bits + shared
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    whole = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(chosen) for chosen in combinations(whole, shared)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _forest(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the fingerprints within ``max_bits`` of each other, never all pairs."""
    edges = []
    rest = np.sort(values)
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            here, front = front[0], front[1:]
            near = np.bitwise_count(rest ^ here) <= max_bits
            edges += [(int(here), int(x)) for x in rest[near]]
            front, rest = np.concatenate([front, rest[near]]), rest[~near]
    return edges


_EDGES = T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))


def _bucket_links(members: Column, max_bits: int) -> Column:
    kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))

    @F.arrow_udf(_EDGES)
    def links(lists: pa.Array) -> pa.Array:
        out = []
        for one in lists:
            pairs = _forest(one.values.to_numpy(zero_copy_only=False), max_bits)
            out.append([{"a": a, "b": b} for a, b in pairs])
        return pa.array(out, kind)

    return links(members)


def _balls(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links among fingerprints of overfull buckets, linear in their number.

    Two fingerprints are within ``r`` bits iff a value lies within ``r // 2`` of one and ``r - r // 2`` of the other.
    Every such value joins all fingerprints around it, provided that one of them is at the shorter distance.
    """
    short, far = max_bits // 2, max_bits - max_bits // 2
    flips = [(0, True)]
    for size in range(1, far + 1):
        for bits in combinations(range(BITS), size):
            flip = sum(1 << b for b in bits)
            flips.append((flip - (1 << BITS) if flip >> (BITS - 1) else flip, size <= short))
    ways = F.array(*[F.struct(F.lit(flip).alias("flip"), F.lit(close).alias("close")) for flip, close in flips])
    around = prints.select("fp", F.explode(ways).alias("way")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("way.flip")).alias("value"), F.col("way.close").alias("close")
    )
    hubs = around.groupBy("value").agg(
        F.min(F.when(F.col("close"), F.col("fp"))).alias("hub"), F.count(F.lit(1)).alias("n")
    ).where(F.col("hub").isNotNull() & (F.col("n") > 1))
    return around.join(hubs, "value").where("fp <> hub").select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct()


def links(prints: DataFrame, max_bits: int = 3, shared: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly the distinct fingerprints ``prints(fp)`` linked at ``max_bits`` or fewer.

    With ``max_bits + shared`` blocks two close fingerprints agree on ``shared`` of them, so they meet in the bucket of
    that choice of blocks. A bucket of two is verified as it is counted; larger ones are compared in one task up to
    ``bucket`` members, and fingerprints of still larger ones go through Hamming balls.
    """
    masks = F.array(*[F.struct(F.lit(i).alias("m"), F.lit(m).alias("mask")) for i, m in enumerate(_masks(max_bits, shared))])
    blocks = prints.select("fp", F.explode(masks).alias("x")).select(
        "fp", F.col("x.m").alias("m"), F.col("fp").bitwiseAND(F.col("x.mask")).alias("block")
    )
    sizes = blocks.groupBy("m", "block").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = sizes.where((F.col("n") == 2) & close).select("a", "b")
    some = sizes.where((F.col("n") > 2) & (F.col("n") <= bucket)).select("m", "block")
    lists = blocks.join(some, ["m", "block"]).groupBy("m", "block").agg(F.collect_list("fp").alias("fps"))
    trees = lists.select(F.explode(_bucket_links(F.col("fps"), max_bits)).alias("e")).select("e.a", "e.b")
    overfull = sizes.where(F.col("n") > bucket).select("m", "block")
    crowded = blocks.join(overfull, ["m", "block"], "left_semi").select("fp").distinct()
    return pairs.unionByName(trees).unionByName(_balls(crowded, max_bits)).distinct()


def components(edges: DataFrame, folder: str) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the least node reachable.

    Alternating large and small stars (Kiveris et al. 2014): each step hooks neighbours to the least one, on shuffles
    of edges only. Every step is a table in the shared folder.
    """
    step, seen = 0, None
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b"), folder, "edges-0")
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(mark) == seen or not mark[0]:
            break
        seen = tuple(mark)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hooked = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = hooked.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        step += 1
        edges = written(small, folder, f"edges-{step}")
        remove(edges.sparkSession, f"{folder}/edges-{step - 1}")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _labelled(docs: DataFrame, words: int, max_bits: int, shared: int, bucket: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """``prints(row, doc_id, fp)`` of all rows, and ``named(fp, root, component_id)`` of all fingerprints."""
    require(docs, "doc_id", "text")
    with_workers(docs)
    prints = docs.select(_row(), "doc_id", fingerprints(F.col("text"), words).alias("fp"))
    prints = written(prints, folder, "prints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), folder, "classes")
    edges = written(links(classes.select("fp"), max_bits, shared, bucket), folder, "links")
    roots = components(edges, folder)
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # Only fingerprints with a link need the smallest id of others.
    linked = roots.select(F.col("root").alias("fp")).union(roots.select("node")).distinct()
    least = rooted.join(linked, "fp", "left_semi").groupBy("root").agg(F.min("least").alias("id"))
    named = rooted.join(least, "root", "left").select("fp", "root", F.coalesce("id", "least").alias("component_id"))
    return prints, written(named, folder, "named")


def _row() -> Column:
    """Tells rows apart by id and text."""
    return F.xxhash64("doc_id", "text").alias("row")


def near_duplicates(
    docs: DataFrame, words: int = 3, max_bits: int = 3, shared: int = 3, bucket: int = BUCKET, folder: str | None = None
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``: one row for each row of ``docs``.

    A component is what links of ``max_bits`` or fewer differing bits reach; its id is the smallest ``doc_id`` in it
    (rows with a null id take part, null only if all of them are null). Null, empty and blank texts have fingerprint
    zero and are linked like any other. Repeated rows stay repeated. Other columns are ignored, whatever their names.
    """
    prints, named = _labelled(docs, words, max_bits, shared, bucket, folder or shared_root(docs.sparkSession))
    return prints.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(
    docs: DataFrame, words: int = 3, max_bits: int = 3, shared: int = 3, bucket: int = BUCKET, folder: str | None = None
) -> DataFrame:
    """One row of each component of ``docs``, that with the smallest ``doc_id``, with all its columns.

    Rows without id stay only in components without any, and there one does. Rows that repeat an id with other texts are
    told apart; of rows equal in id and text one stays.
    """
    folder = folder or shared_root(docs.sparkSession)
    prints, named = _labelled(docs, words, max_bits, shared, bucket, folder)
    rows = prints.join(named.select("fp", "root"), "fp").select("row", "doc_id", "root")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    several = rows.groupBy("root").agg(F.min_by("row", order).alias("stays"), F.count(F.lit(1)).alias("n")).where("n > 1")
    several = written(several.drop("n"), folder, "several")
    grouped = rows.join(several, "root")
    gone = written(grouped.where("row <> stays").select("row").distinct(), folder, "gone")
    repeated = grouped.groupBy("row").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count() > 0
    mark = fresh(docs, "__row")
    kept = docs.withColumn(mark, _row())
    kept = kept.join(gone.withColumnRenamed("row", mark), mark, "left_anti")
    if repeated:
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        first = kept.groupBy(mark).agg(F.first(whole).alias("__whole"))
        return first.select(*[F.col("__whole").getField(c).alias(c) for c in docs.columns])
    return kept.drop(mark)
