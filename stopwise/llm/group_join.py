"""Exact Jaccard join of documents' word n-grams by grouped prefixes.

Documents with equal sets are one class. A class's prefix are the shingles that come first in an order of all shingles,
as many as two sets of enough similarity can't both miss. Classes with the same prefix and size form a group. Groups meet
in the inverted lists of their prefix shingles and are held against each other by size and by parity bitmaps, whose
differences never exceed those of the sets. Groups that pass are expanded into their members, which are verified on their
whole sets. Links are only followed until they connect: a spanning forest of all links, not all pairs.

The order puts shingles that are frequent by a count sketch of fixed size last. Any order gives the same links; this one
keeps the lists of common passages out of the prefixes, at every size of the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm.common import claim, remove, require, shared_root, with_workers, written
from stopwise.llm.simhash import components

#: Counters of the sketch that orders shingles.
SLOTS = 1 << 21
#: Words whose hashes a worker keeps.
CACHE = 300_000
#: Rows of candidates that are broadcast (32 bytes each) to keep the texts from being shuffled; beyond, texts are joined by a merge.
SENT = 1 << 20
#: Groups of an inverted list, and shingles of candidates, that one task compares; more are dealt into blocks.
LIST, SHINGLES = 1 << 12, 1 << 21
#: Classes with more than this share of all rows are joined in as many parts; there are at most ``SHARES`` of them.
SHARES, LEAST_SHARE = 1024, 1000
_P1 = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class JaccardConfig:
    """Sets link when ``100 * intersection >= percent * union``; shingles have ``words`` words."""

    words: int = 3
    percent: int = 90

    def prefix(self, n: int) -> int:
        """Shingles of a set of ``n`` of which a linked set shares one at least: all but its least overlap, and one."""
        return n - (n * self.percent + 99) // 100 + 1

    def most_apart(self, sizes: np.ndarray) -> np.ndarray:
        """The most shingles that only one of two linked sets has, by the sum of their sizes."""
        return sizes * (100 - self.percent) // (100 + self.percent)


# ---- sets


class WordHashes(dict):
    """Words to 64-bit hashes, a bounded number of them; one per worker process."""

    _open: dict[str, WordHashes] = {}

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < CACHE:
            self[word] = value
        return value

    @classmethod
    def get(cls) -> WordHashes:
        mine = claim(cls)
        if "words" not in mine:
            mine["words"] = cls()
        return mine["words"]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int, hashes: WordHashes) -> np.ndarray:
    """The ascending hashes of a text's distinct shingles."""
    return np.unique(all_shingles(text, words, hashes))


def all_shingles(text: str | None, words: int, hashes: WordHashes) -> np.ndarray:
    """The hashes of a text's shingles, repeats included; of fewer words than one has, the whole sequence is one."""
    split = (text or "").encode().lower().split()  # on bytes both touch ASCII only
    if not split:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, split), np.uint64, len(split))
    size = min(words, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        out = out * _P1 + h[k : len(h) - size + 1 + k]
    return mixed(out)


def digest(hashes: np.ndarray) -> tuple[int, int]:
    whole = xxhash.xxh3_128_intdigest(hashes.tobytes())
    return tuple(int(x) for x in np.array([whole >> 64, whole & (1 << 64) - 1], np.uint64).view(np.int64))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Iterator[str | None]]]:
    for batch in batches:
        yield batch, (t.as_py() for t in batch.column("text"))


def sketch(docs: DataFrame, cfg: JaccardConfig) -> np.ndarray:
    """Counts of all documents' shingles in ``SLOTS`` slots, over the whole corpus; every task sends its own once.

    The sums are taken in two steps, so that no task reads more than a bounded number of shards.
    """
    block = 1 << 15

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, hashes = np.zeros(SLOTS, np.uint32), WordHashes.get()
        for _, texts in _texts(batches):
            for text in texts:
                at = (all_shingles(text, cfg.words, hashes) >> np.uint64(20)) % np.uint64(SLOTS)
                np.add.at(table, at.astype(np.int64), 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLOTS // block), pa.int32()), pa.array([table[i : i + block].tobytes() for i in range(0, SLOTS, block)], pa.binary())],
            ["block", "counts"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, own in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                more = np.frombuffer(own.as_buffer(), np.uint32)
                sums[at] = sums[at] + more if at in sums else more
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["block", "counts"])

    kind = "block int, counts binary"
    parts = docs.select("text").mapInArrow(count, kind)
    for salts in (32, 1):
        parts = parts.withColumn("salt", F.floor(F.rand(5) * salts)).repartition("block", "salt").select("block", "counts").mapInArrow(add, kind)
    table = np.zeros((SLOTS // block, block), np.uint32)
    for row in parts.toLocalIterator():  # the table: SLOTS counters
        table[row.block] += np.frombuffer(row.counts, np.uint32)
    return table.ravel()


#: Bits of the parity bitmap of a set of at most so many shingles.
WIDTHS = ((2_000, 512), (16_000, 4_096), (1 << 62, 65_536))


def width(n: int) -> int:
    return next(bits for most, bits in WIDTHS if n <= most)


def parity(hashes: np.ndarray) -> bytes:
    """A bitmap in which every shingle turns one bit over."""
    bits = np.bincount((hashes % np.uint64(width(len(hashes)))).astype(np.int64), minlength=width(len(hashes))) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def folded(bitmap: bytes, bits: int) -> np.ndarray:
    """The bitmap of the same set with fewer bits, as 64-bit words."""
    words = np.frombuffer(bitmap, np.uint64)
    return np.bitwise_xor.reduce(words.reshape(-1, bits // 64), axis=0)


def signatures(docs: DataFrame, cfg: JaccardConfig, order: Broadcast) -> DataFrame:
    """``row``, ``doc_id``, ``n``, ``d1``, ``d2`` (the set's digest), ``prefix`` and ``bitmap`` of every row of ``docs``."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = WordHashes.get(), order.value
        for batch, texts in _texts(batches):
            sizes, d1, d2, prefixes, bitmaps = [], [], [], [], []
            for text in texts:
                own = shingles(text, cfg.words, hashes)
                sizes.append(len(own))
                a, b = digest(own)
                d1.append(a), d2.append(b)
                usual = counts[((own >> np.uint64(20)) % np.uint64(SLOTS)).astype(np.int64)]
                first = np.lexsort((own, usual))[: cfg.prefix(len(own))] if len(own) else []
                prefixes.append(own[first].view(np.int64))
                bitmaps.append(parity(own))
            lists = pa.ListArray.from_arrays(
                np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32), np.concatenate([*prefixes, np.empty(0, np.int64)])
            )
            columns = [pa.array(sizes, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), lists, pa.array(bitmaps, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *columns], ["row", "doc_id", "n", "d1", "d2", "prefix", "bitmap"])

    kind = f"row long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, d1 long, d2 long, prefix array<long>, bitmap binary"
    return _rows(docs).mapInArrow(sign, kind)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")


# ---- forests of links


def forest(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, int]]:
    """Edges that connect what ``near(one, others)`` (a mask) links, each item asked once at most."""
    rest = np.arange(n)
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            one = int(front.pop())
            hit = near(one, rest)
            if hit.any():
                found = rest[hit]
                yield from ((one, int(x)) for x in found)
                front.extend(found.tolist())
                rest = rest[~hit]


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[list]]:
    """The rows of each run of equal first ``keys`` columns, of sorted batches, without those columns."""
    last, rows = None, []
    for batch in batches:
        for key, row in zip(
            zip(*(c.to_pylist() for c in batch.columns[:keys]), strict=True), zip(*(c.to_pylist() for c in batch.columns[keys:]), strict=True), strict=True
        ):
            if key != last:
                if len(rows) > 1:
                    yield rows
                last, rows = key, []
            if not rows or row[0] != rows[-1][0]:  # repeated rows once
                rows.append(row)
    if len(rows) > 1:
        yield rows


def _edges(pairs: Iterator[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    while some := list(islice(pairs, 1 << 16)):
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*some, strict=True)], ["a", "b"])


def in_blocks(rows: DataFrame, key: str, weight: str, most: int, item: str) -> DataFrame:
    """``rows`` with blocks ``i <= j``: any two rows of a key meet in one, and a block has some ``2 * most`` in weight.

    A key of at most ``most`` is the block (0, 0). ``weight`` is the column with the key's whole weight.
    """
    n = F.greatest(F.lit(1), F.ceil(F.col(weight) / most)).cast("int")
    dealt = rows.withColumn("__n", n).withColumn("__own", F.pmod(F.xxhash64(item), F.col("__n")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("__n") - 1))
    dealt = dealt.withColumn("__with", other).where((F.col("__n") == 1) | (F.col("__with") != F.col("__own")))
    return dealt.withColumns({"i": F.least("__own", "__with"), "j": F.greatest("__own", "__with")}).drop("__n", "__own", "__with")


def group_edges(groups: DataFrame, cfg: JaccardConfig) -> DataFrame:
    """``a``, ``b``: a forest of the groups that may hold linked members, of ``groups(gid, n, members, prefix, bitmap)``."""
    entries = groups.where("n > 0").select(F.explode("prefix").alias("token"), "gid", "n")
    lists = entries.groupBy("token").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    entries = in_blocks(entries.join(lists, "token"), "token", "held", LIST, "gid")
    # A group of several sets has no bitmap of its own and passes by its size.
    bitmaps = groups.select("gid", F.when(F.col("members") == 1, F.col("bitmap")).alias("bitmap"))
    listed = entries.join(bitmaps, "gid").select("token", "i", "j", "gid", "n", "bitmap")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int]]:
        for rows in _runs(batches, 3):
            gids, sizes = [r[0] for r in rows], np.array([r[1] for r in rows], np.int64)
            widths = np.array([width(int(x)) for x in sizes])
            maps, blind = [r[2] for r in rows], np.array([r[2] is None for r in rows])
            # A pair is compared at the lesser width of its two: folded further, long sets would all look alike.
            tables = {
                int(w): np.array([np.zeros(w // 64, np.uint64) if m is None or own < w else folded(m, int(w)) for m, own in zip(maps, widths, strict=True)])
                for w in np.unique(widths)
            }

            def near(one: int, others: np.ndarray, sizes=sizes, blind=blind, widths=widths, tables=tables) -> np.ndarray:
                n, m = sizes[one], sizes[others]
                fits = 100 * np.minimum(n, m) >= cfg.percent * np.maximum(n, m)
                at = np.minimum(widths[others], widths[one])
                for w, table in tables.items():
                    some = np.flatnonzero(fits & (at == w))
                    apart = np.bitwise_count(table[others[some]] ^ table[one]).sum(1)
                    fits[some] = blind[one] | blind[others[some]] | (apart <= cfg.most_apart(n + m[some]))
                return fits

            yield from ((gids[a], gids[b]) for a, b in forest(len(rows), near))

    listed = listed.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "gid")
    return listed.mapInArrow(lambda batches: _edges(pairs(batches)), "a long, b long").distinct()


def linked(sets: list[np.ndarray], cfg: JaccardConfig) -> Iterator[tuple[int, int]]:
    """A forest of the links among sets, each verified on the whole sets."""
    sizes = np.array([len(s) for s in sets], np.int64)
    if len(sets) == 2:
        common = len(np.intersect1d(*sets, assume_unique=True))
        if 100 * common >= cfg.percent * (sizes.sum() - common):
            yield 0, 1
        return
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, local = np.unique(flat, return_inverse=True)
    order = np.argsort(local, kind="stable")
    holders, first = owner[order], np.concatenate([[0], np.cumsum(np.bincount(local))])
    starts = np.concatenate([[0], np.cumsum(sizes)])

    def near(one: int, others: np.ndarray) -> np.ndarray:
        own = local[starts[one] : starts[one + 1]]
        n = first[own + 1] - first[own]
        at = np.repeat(first[own] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        common = np.bincount(holders[at], minlength=len(sizes))[others]
        return 100 * common >= cfg.percent * (sizes[one] + sizes[others] - common)

    yield from forest(len(sets), near)


def member_edges(docs: DataFrame, members: DataFrame, cfg: JaccardConfig) -> DataFrame:
    """``a``, ``b``: a forest of the links among ``members(cid, row, root, n)``, verified within each root."""
    wanted = members.select("row", "cid", "root", "n")
    weights = members.groupBy("root").agg(F.sum("n").alias("weight"))
    wanted = F.broadcast(wanted) if wanted.count() <= SENT else wanted.hint("merge")
    texts = _rows(docs).join(wanted, "row").select("cid", "root", "text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes.get()
        for batch, some in _texts(batches):
            own = [shingles(t, cfg.words, hashes).tobytes() for t in some]
            yield pa.RecordBatch.from_arrays([batch.column("cid"), batch.column("root"), pa.array(own, pa.binary())], ["cid", "root", "shingles"])

    sets = texts.mapInArrow(build, "cid long, root long, shingles binary")
    dealt = in_blocks(sets.join(weights, "root"), "root", "weight", SHINGLES, "cid").select("root", "i", "j", "cid", "shingles")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int]]:
        for rows in _runs(batches, 3):
            cids = [r[0] for r in rows]
            yield from ((cids[a], cids[b]) for a, b in linked([np.frombuffer(r[1], np.uint64) for r in rows], cfg))

    dealt = dealt.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "cid")
    return dealt.mapInArrow(lambda batches: _edges(pairs(batches)), "a long, b long").distinct()


# ---- the operator


def similar_documents(docs: DataFrame, cfg: JaccardConfig | None = None, folder: str | None = None) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``class_id``: one row for each row of ``docs``.

    A document's set: the distinct shingles of its words (A-Z as a-z); with fewer words than a shingle has, the whole
    sequence. ``component_id`` is the smallest ``doc_id`` reachable by links, its own included; ``class_id`` numbers
    equal sets, which are linked without being paired. Texts that are null, empty or blank have an empty set and are
    linked with nothing: null class, their own id. Rows without id take part (their component's id is null only if it
    has no id at all). Repeated rows stay repeated. Very long texts are taken whole, one at a time. Other columns are
    ignored, whatever their names; an empty table gives no rows.
    """
    require(docs, "doc_id", "text")
    with_workers(docs)
    spark = docs.sparkSession
    cfg, folder = cfg or JaccardConfig(), folder or shared_root(spark)
    order = spark.sparkContext.broadcast(sketch(docs, cfg))
    signed = written(signatures(docs, cfg, order), folder, "signed")
    order.unpersist()

    classes = signed.where("n > 0").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("least"), F.min("row").alias("row"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"),
        F.first("prefix").alias("prefix"), F.first("bitmap").alias("bitmap"),
    )
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), folder, "classes")

    # Groups: equal prefix and size. Their number is the least class in them.
    key = [F.xxhash64("n", "prefix").alias("g1"), F.xxhash64(F.lit(1), "n", "prefix").alias("g2")]
    named = classes.select("cid", "n", "row", *key)
    groups = classes.select("cid", "n", "prefix", "bitmap", *key).groupBy("g1", "g2").agg(
        F.min("cid").alias("gid"), F.count(F.lit(1)).alias("members"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("bitmap").alias("bitmap")
    )
    groups = written(groups, folder, "groups")
    near = components(group_edges(groups, cfg), f"{folder}/near")
    near = near.unionByName(near.select(F.col("root").alias("node"), "root").distinct())  # roots aren't among the nodes
    rooted = groups.select("g1", "g2", "gid", "members").join(near.withColumnRenamed("node", "gid"), "gid", "left")
    rooted = rooted.where("root IS NOT NULL OR members > 1").select("g1", "g2", F.coalesce("root", "gid").alias("root"))
    members = written(named.join(rooted, ["g1", "g2"]).select("cid", "row", "root", "n"), folder, "members")
    roots = components(member_edges(docs, members, cfg), f"{folder}/links")

    whole = classes.select("d1", "d2", "cid", "least", "copies").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    whole = whole.withColumn("root", F.coalesce("root", "cid"))
    least = whole.groupBy("root").agg(F.min("least").alias("component"))
    share = max(LEAST_SHARE, -(-signed.count() // SHARES))
    parts = F.greatest(F.lit(1), F.ceil(F.col("copies") / share)).cast("int")
    final = written(whole.join(least, "root").select("d1", "d2", "cid", "component", parts.alias("parts")), folder, "final")

    # A class may hold a third of all rows: both sides know into how many parts it is dealt.
    hot = F.broadcast(final.where("parts > 1").select("d1", "d2", "parts"))
    rows = signed.select("row", "doc_id", "n", "d1", "d2").join(hot, ["d1", "d2"], "left")
    rows = rows.withColumn("part", F.coalesce(F.pmod(F.xxhash64("row"), F.col("parts")), F.lit(0)).cast("int")).drop("parts")
    spread = final.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    found = rows.where("n > 0").join(spread, ["d1", "d2", "part"]).select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("cid").alias("class_id"))
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("class_id"))
    remove(spark, f"{folder}/groups", f"{folder}/members", f"{folder}/near", f"{folder}/links")
    return found.unionByName(alone)
