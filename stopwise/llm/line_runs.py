"""Line dedup over levelled sorted runs of line hashes.

The state is a set of *runs*: tables ``(h1, h2, docs)`` of line hashes, each hash once per run, dealt by hash into
sorted buckets. A new batch of documents first merge-anti-joins the runs whose hashes are already known to be common
and adds the rest as a new run of level 0. Two runs of a level are merged into one of the next level by a full outer
merge join of their buckets, which shuffles nothing, so every hash is rewritten only a logarithmic number of times. The
number of documents of a line is the sum over the runs. The list of runs is kept beside them, so that a later
application goes on with them.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.llm.common import SPACE, ascii_lower, fresh, remove, require, shared_root, written

#: A line held by more than this share of all rows is joined in as many parts as it has such shares. There are at most
#: ``SHARES`` times as many such lines as a row has lines on average, whatever the number of rows.
SHARES = 1024
#: A share of this many rows is not split further.
LEAST_SHARE = 1000


def lines_of(text: Column) -> Column:
    """Lines of a text; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def hash_pair(key: Column) -> list[Column]:
    """128 bits in two columns, so that 64-bit collisions of a very large corpus don't drop a line."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


@dataclass
class LineRuns:
    """Runs as bucketed tables in a shared folder. ``common`` documents make a line common.

    ``levels[k]`` names the run of level ``k``, if there is one: adding a batch carries as in a binary counter. All runs
    have the same buckets, sorted by hash: joining a batch with them shuffles the batch once and no run, merging two
    runs shuffles nothing.
    """

    spark: SparkSession
    folder: str
    common: int
    levels: list[str | None] = field(default_factory=list)
    made: int = 0
    buckets: int = 0
    prefix: str = ""

    def __post_init__(self) -> None:
        self.buckets = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.prefix = self.prefix or f"line_run_{uuid.uuid4().hex}"

    @classmethod
    def reopen(cls, spark: SparkSession, folder: str, common: int) -> LineRuns:
        """The runs that another session has left in ``folder``."""
        state = json.loads(spark.read.json(f"{folder}/state").orderBy(F.col("made").desc()).first().state)
        runs = cls(spark, folder, common, state["levels"], state["made"], state["buckets"], state["prefix"])
        for name in filter(None, runs.levels):
            if not spark.catalog.tableExists(name):
                spark.sql(
                    f"CREATE TABLE {name} (h1 BIGINT, h2 BIGINT, docs BIGINT) USING parquet CLUSTERED BY (h1, h2) "
                    f"SORTED BY (h1, h2) INTO {runs.buckets} BUCKETS LOCATION '{folder}/{name}'"
                )
        return runs

    def _keep(self) -> None:
        """Note the list of runs; the highest number counts, so a lost driver leaves the list before or the one after."""
        state = json.dumps({"levels": self.levels, "made": self.made, "buckets": self.buckets, "prefix": self.prefix})
        self.spark.range(1).select(F.lit(self.made).alias("made"), F.lit(state).alias("state")).coalesce(1).write.mode("append").json(
            f"{self.folder}/state"
        )

    def _store(self, counts: DataFrame) -> str:
        name = f"{self.prefix}_{self.made}"
        self.made += 1
        writer = counts.select("h1", "h2", "docs").write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
        writer.option("path", f"{self.folder}/{name}").format("parquet").mode("overwrite").saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(self.spark, f"{self.folder}/{name}")

    def tables(self) -> list[DataFrame]:
        """The runs, oldest level first."""
        return [self.spark.table(name) for name in reversed(self.levels) if name]

    def unseen(self, keys: DataFrame, at_least: int = 1) -> DataFrame:
        """Rows of ``keys(h1, h2, …)`` whose hash no run holds with ``at_least`` documents: one merge anti-join per run."""
        for run in self.tables():
            known = run.where(F.col("docs") >= at_least).select("h1", "h2")
            keys = keys.join(known.hint("merge"), ["h1", "h2"], "left_anti")
        return keys

    def merged(self, older: str, newer: str) -> DataFrame:
        """Two runs as one. A union would be grouped by what Spark takes for one bucketed table, so it is a join."""
        a, b = self.spark.table(older), self.spark.table(newer).withColumnRenamed("docs", "more")
        both = a.join(b.hint("merge"), ["h1", "h2"], "full_outer")
        zero = F.lit(0).cast("long")
        return both.select("h1", "h2", (F.coalesce("docs", zero) + F.coalesce("more", zero)).alias("docs"))

    def add(self, counts: DataFrame) -> None:
        """Take a batch ``(h1, h2, docs)`` with each hash once.

        A hash that one run already shows to be common needs no more counting; such hashes are anti-joined away.
        """
        new, level, gone = self._store(self.unseen(counts, self.common)), 0, []
        while level < len(self.levels) and self.levels[level]:
            old, self.levels[level] = self.levels[level], None
            gone += [old, new]
            new, level = self._store(self.merged(old, new)), level + 1
        self.levels += [None] * (level + 1 - len(self.levels))
        self.levels[level] = new
        self._keep()
        for name in gone:
            self._drop(name)

    def compact(self) -> str | None:
        """All runs as one, merged from the smallest on; its name."""
        runs = [name for name in self.levels if name]
        if len(runs) > 1:
            new = runs[0]
            for k, older in enumerate(runs[1:]):
                step = self._store(self.merged(older, new))
                if k:
                    self._drop(new)
                new = step
            self.levels = [*[None] * (len(self.levels) - 1), new]
            self._keep()
            for name in runs:
                self._drop(name)
        return next(filter(None, self.levels), None)

    def common_lines(self) -> DataFrame:
        """``(h1, h2, docs)`` of the hashes found in at least ``common`` documents, over all runs."""
        name = self.compact()
        whole = self.spark.table(name) if name else self.spark.createDataFrame([], "h1 long, h2 long, docs long")
        return whole.where(F.col("docs") >= self.common)

    def close(self) -> None:
        for name in filter(None, self.levels):
            self._drop(name)
        self.levels = []
        remove(self.spark, f"{self.folder}/state")


def dedup_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4, folder: str | None = None
) -> DataFrame:
    """``docs`` with columns ``kept`` (text), ``n_lines`` and ``n_dropped`` (long) added.

    A line's key is the line without surrounding white space, A-Z lower-cased. Keys of at least ``min_chars`` code
    points found in at least ``min_docs`` documents lose all their lines. Rows count as documents: repeated rows, also
    with one id, are documents of their own. A null or empty text is one empty line, which always stays. Other columns,
    whatever their names, are passed on; a present ``kept``, ``n_lines`` or ``n_dropped`` is replaced. An empty table
    gives an empty result.

    Texts are taken whole, however long; the rows of a document's lines live in one task. The documents are dealt into
    ``batches`` as they would arrive; each batch's hashes go through the runs.
    """
    require(docs, "text")
    spark = docs.sparkSession
    folder = folder or shared_root(spark)
    base = docs.drop("kept", "n_lines", "n_dropped")
    uid, gone, parts = (fresh(base, x) for x in ("__row", "__gone", "__lines"))
    least = max(1, min_chars)  # an empty key never is dropped
    # Rows that share this number at most share the list of their common lines, which changes no result.
    known = [F.col(f"`{c}`") for c in base.columns if c.lower() in ("doc_id", "text")]
    source = base.withColumn(uid, F.xxhash64(*known))

    # One pass over the texts leaves only hashes and places: sorted in the row, a key's first place is marked to count it once.
    place = lambda key, i: F.struct(*hash_pair(key), (i + 1).alias("at"), (F.char_length(key) >= least).alias("long"))
    keys = F.transform(F.transform(lines_of(F.col("text")), line_key), place)
    listed = source.select(uid, F.array_sort(F.filter(keys, lambda e: e["long"])).alias("keys"))
    before = F.concat(F.array(F.lit(None)), F.slice("keys", 1, F.greatest(F.size("keys") - 1, F.lit(0))))
    first = lambda e, o: F.struct(
        e["h1"].alias("h1"), e["h2"].alias("h2"), e["at"].alias("at"), (o.isNull() | (e["h1"] != o["h1"]) | (e["h2"] != o["h2"])).alias("first")
    )
    marked = F.when(F.size("keys") > 0, F.zip_with("keys", before, first))
    hashed = listed.select(F.col(uid).alias("row"), F.pmod(F.col(uid), F.lit(batches)).cast("int").alias("batch"), F.inline(marked))
    hashed.select("row", "h1", "h2", "at", "first", "batch").write.partitionBy("batch").parquet(f"{folder}/hashes")
    hashes = spark.read.schema("row long, h1 long, h2 long, at int, first boolean, batch int").parquet(f"{folder}/hashes")
    once = hashes.where("first")

    runs = LineRuns(spark, f"{folder}/runs", min_docs)
    for batch in range(batches):
        runs.add(once.where(F.col("batch") == batch).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs")))
    common = written(runs.common_lines(), folder, "common")
    runs.close()

    # Which keys a document loses: an equi-join on the hash. What runs count of a common line is a lower bound of its
    # rows, as they stop counting it, so those held by very many rows are counted again for the parts they are dealt into.
    share = max(LEAST_SHARE, -(-docs.count() // SHARES))
    often = hashes.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > share)
    often = often.select("h1", "h2", F.ceil(F.col("n") / share).cast("int").alias("parts"))
    often = written(often, folder, "often")
    part = F.coalesce(F.pmod(F.xxhash64("row", "at"), F.col("parts")).cast("int"), F.lit(0))
    dealt = hashes.join(F.broadcast(often), ["h1", "h2"], "left").withColumn("part", part).drop("parts")
    spread = common.select("h1", "h2").join(F.broadcast(often), ["h1", "h2"], "left")
    spread = spread.select("h1", "h2", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts") - 1, F.lit(0)))).alias("part"))
    lost = (
        dealt.join(spread, ["h1", "h2", "part"])
        .groupBy(F.col("row").alias(uid))
        .agg(F.array_sort(F.collect_set("at")).alias("lost"))
    )
    lost = written(lost.withColumnRenamed("lost", gone), folder, "lost")
    remove(spark, *(f"{folder}/{name}" for name in ("hashes", "common", "often")))

    # Always a merge join: a broadcast list of these would grow with the corpus.
    out = source.join(lost.hint("merge"), uid, "left").withColumn(parts, lines_of(F.col("text")))
    # The stretches between lost lines, so that a very long text takes time in proportion.
    ends = F.concat(F.array(F.lit(0)), F.col(gone), F.array(F.size(parts) + 1))
    stretch = F.zip_with(ends, F.col(gone), lambda a, b: F.struct((a + 1).alias("from"), (F.coalesce(b, F.size(parts) + 1) - a - 1).alias("n")))
    stretch = F.filter(stretch, lambda e: e["n"] > 0)
    left = F.when(F.col(gone).isNull(), F.col(parts)).otherwise(F.flatten(F.transform(stretch, lambda e: F.slice(parts, e["from"], e["n"]))))
    out = out.select(*[F.col(f"`{c}`") for c in base.columns], parts, left.alias(gone))
    return out.select(
        *[F.col(f"`{c}`") for c in base.columns],
        F.array_join(gone, "\n").alias("kept"),
        F.size(parts).cast("long").alias("n_lines"),
        (F.size(parts) - F.size(gone)).cast("long").alias("n_dropped"),
    )
