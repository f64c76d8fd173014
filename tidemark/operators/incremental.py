"""Processing only new or changed records (problem 4), by a Merkle tree over key ranges.

The keys are spread over ranges of their hash, the leaves of a tree of fixed
fan-out whose depth follows the number of rows. A leaf's digest covers every
delivered row of its range and the run that sees it; a node's digest covers its
children's. What a call has to do is found by comparing the tree of the feed as
it stands with the tree saved by the last published call, from the root down:
only children of nodes that differ are looked at, and only the leaves so found
are decided anew. Their pages, the tree and the output are published together;
all other pages are carried over by reference and neither read nor written.

A row that arrives late, for a run that is long over, changes its leaf's digest
like any other, so it is found however old its run is.
"""

from __future__ import annotations

import json
import math
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.common import instant, unblank
from ..session import forget_later, materialize, release, shared_folder, ship

FANOUT_BITS = 4
#: Rows of the feed a leaf should have; a page file holds the cases of one leaf.
PER_LEAF = 4096
MOST_LEVELS = 6
#: Runs whose order is broadcast; more are joined by shuffle.
MAX_RUNS = 100_000
#: Leaves whose numbers are given to the scan of pages as a partition filter; more are found by a join.
MAX_LISTED = 10_000
CASE = "run_id int, file_id string, at timestamp, content string"
NODE = "level int, node bigint, digest bigint, n_rows bigint, page string, page_digest bigint"


class DamagedStore(RuntimeError):
    """What a store has saved is missing or not what was published."""


# ---- rows -------------------------------------------------------------------


def delivered(feed: DataFrame, run_log: DataFrame) -> DataFrame:
    """(run_id, file_id, at, content, feed_seq): every row of the feed with the successful run that sees it.

    A run is successful when its status is "success" in any letter case. It
    sees its own rows and those of all runs since the previous successful one;
    rows after the last successful run are left out until one sees them. Rows
    without file_id or run_id belong to no file or run and are left out.
    """
    good = run_log.where((F.lower(F.trim("status")) == "success") & F.col("run_id").isNotNull()).select(F.col("run_id").cast("int")).distinct()
    rows = feed.where(F.col("file_id").isNotNull() & F.col("run_id").isNotNull()).select(F.col("run_id").cast("int").alias("run"), "file_id", instant("modified_time").alias("at"), unblank("content_text_hash").alias("content"), F.col("feed_seq").cast("bigint").alias("feed_seq"))
    # one row a run, so one ordered window over them is small
    runs = rows.select(F.col("run").alias("run_id")).distinct().join(good.withColumn("__good", F.col("run_id")), "run_id", "full_outer")
    seen = materialize(runs.select(F.col("run_id").alias("run"), F.min("__good").over(Window.orderBy(F.desc("run_id"))).alias("run_id")).where(F.col("run_id").isNotNull()), "runs")
    seen = F.broadcast(seen) if seen.count() <= MAX_RUNS else seen
    return rows.join(seen, "run").select("run_id", "file_id", "at", "content", "feed_seq")


def with_leaf(df: DataFrame, levels: int) -> DataFrame:
    """`df` with the leaf of each file: the first bits of its key's hash."""
    return df.withColumn("leaf", F.shiftrightunsigned(F.xxhash64("file_id"), 64 - FANOUT_BITS * levels))


def taken(rows: DataFrame) -> DataFrame:
    """The row each run takes of each file: the latest `at`, then the greatest feed_seq; an unreadable time is the oldest, equal rows are one."""
    best = rows.groupBy("leaf", "run_id", "file_id").agg(F.max(F.struct("at", "feed_seq", "content")).alias("r"))
    return best.select("leaf", "run_id", "file_id", F.col("r.at").alias("at"), F.col("r.content").alias("content"))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of file and run; of each file only the row of its last case is remembered."""
    last_file, last_at, last_content = None, 0, None
    for b in batches:
        keep = []
        at = b.column("at").cast(pa.int64()).to_pylist()
        for i, (file, when, content) in enumerate(zip(b.column("file_id").to_pylist(), at, b.column("content").to_pylist())):
            when = -(2**62) if when is None else when
            if file != last_file:
                case = True
            elif when < last_at:
                case = False
            elif content is not None and last_content is not None:
                case = content != last_content
            else:
                case = when > last_at
            if case:
                last_file, last_at, last_content = file, when, content
                keep.append(i)
        if keep:
            yield b.take(pa.array(keep, pa.int64()))


def cases(rows: DataFrame) -> DataFrame:
    """The rows of taken() that are new or changed: (leaf, run_id, file_id, at, content).

    Each file's rows are held, in order of runs, against the row of its last
    case: the first is a case; an older one is not; with both contents known it
    is one when they differ, else when it is later. A row whose time cannot be
    read is older than any other. One file has at most one row a run, and none
    is kept but the last case, so no file is too much for a task.
    """
    ship(rows.sparkSession)
    placed = rows.repartition("leaf").sortWithinPartitions("leaf", "file_id", "run_id")
    return placed.select("leaf", "run_id", "file_id", "at", "content").mapInArrow(_fold, "leaf bigint, " + CASE)


# ---- trees ------------------------------------------------------------------


def depth_for(n_rows: int, per_leaf: int) -> int:
    """Levels below the root, so that a leaf has about `per_leaf` rows."""
    return max(1, min(MOST_LEVELS, round(math.log(max(n_rows / per_leaf, 1.0), 1 << FANOUT_BITS))))


def leaf_digests(rows: DataFrame) -> DataFrame:
    """(node, digest, n_rows) of each leaf that has rows: sums of row hashes, folded where the rows lie, whatever their order."""
    h = F.xxhash64("file_id", "run_id", F.unix_micros("at"), "content", "feed_seq")
    # sums of halves cannot overflow a long below 2**31 rows a leaf
    sums = rows.select("leaf", h.alias("h")).groupBy(F.col("leaf").alias("node")).agg(F.sum(F.shiftrightunsigned("h", 32)).alias("hi"), F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("lo"), F.count("*").alias("n_rows"))
    return sums.select("node", F.xxhash64("hi", "lo", "n_rows").alias("digest"), "n_rows")


def _parents(level: DataFrame) -> DataFrame:
    """The nodes above those of one level; a node's digest covers its children in order, and there are at most 2**FANOUT_BITS of them."""
    kids = F.array_sort(F.collect_list(F.struct("node", "digest")))
    return level.groupBy(F.shiftright("node", FANOUT_BITS).alias("node")).agg(F.xxhash64(kids).alias("digest"), F.sum("n_rows").alias("n_rows"))


def grow(leaves: DataFrame, levels: int) -> DataFrame:
    """(level, node, digest, n_rows) of all nodes, the root at level 0, from the digests of the leaves."""
    at = leaves.select("node", "digest", "n_rows")
    out = at.withColumn("level", F.lit(levels))
    for level in reversed(range(levels)):
        at = _parents(at)
        out = out.unionByName(at.withColumn("level", F.lit(level)))
    return out.select("level", "node", "digest", "n_rows")


def descend(now: DataFrame, saved: DataFrame, levels: int) -> DataFrame:
    """(node): the leaves whose digests differ between two trees of one depth, found from the root down.

    A node is looked at only if its parent differs; a node that only one tree
    has differs.
    """
    path = None
    for level in range(levels + 1):
        a, b = (t.where(F.col("level") == level).select("node", "digest") for t in (now, saved))
        if path is not None:
            a, b = (x.withColumn("up", F.shiftright("node", FANOUT_BITS)).join(path.withColumnRenamed("node", "up"), "up", "left_semi").drop("up") for x in (a, b))
        both = a.join(b.withColumnRenamed("digest", "__saved"), "node", "full_outer")
        path = both.where(~F.col("digest").eqNullSafe(F.col("__saved"))).select("node")
    return path


def broken_nodes(tree: DataFrame, levels: int) -> DataFrame:
    """Inner nodes whose digest isn't that of their children."""
    out = None
    for level in range(levels):
        mine = tree.where(F.col("level") == level).select("node", "digest")
        want = _parents(tree.where(F.col("level") == level + 1).select("node", "digest", "n_rows")).select("node", F.col("digest").alias("__want"))
        bad = mine.join(want, "node", "full_outer").where(~F.col("digest").eqNullSafe(F.col("__want"))).select(F.lit(level).alias("level"), "node")
        out = bad if out is None else out.unionByName(bad)
    return out


def page_digests(pages: DataFrame) -> DataFrame:
    """(node, page_digest) of pages (leaf and a case's columns)."""
    h = F.xxhash64("run_id", "file_id", F.unix_micros("at"), "content")
    sums = pages.select("leaf", h.alias("h")).groupBy(F.col("leaf").alias("node")).agg(F.sum(F.shiftrightunsigned("h", 32)).alias("hi"), F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("lo"))
    return sums.select("node", F.xxhash64("hi", "lo").alias("page_digest"))


# ---- the store --------------------------------------------------------------


class IncrementalStore:
    """The cases published so far, in pages by leaf, with their tree.

    Each call writes a version folder: the pages of the leaves it opened, the
    whole tree (a small fraction of the data) with the version that holds each
    leaf's page, and its output. The version counts only once a numbered
    pointer names it; the pointer is created in one piece if its number is
    free, and carries the root's digest and its own checksum. A call that dies
    leaves folders nobody points to and is simply repeated: no record is
    skipped or repeated. Two calls that publish the same number: one fails.

    The feed handed to process() is the log as it stands, in any order; rows
    taken back from it take back their cases. Pages are files by leaf, so
    `per_leaf` trades the number of files against what a small change opens.
    """

    def __init__(self, spark: SparkSession, folder: str, per_leaf: int = PER_LEAF):
        self.spark, self.folder, self.per_leaf = spark, folder.rstrip("/"), per_leaf
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        #: what the last call opened: leaves that differed, and page files read
        self.opened, self.pages_read = 0, 0

    # pointers

    def _pointers(self) -> list[str]:
        if not self._fs.exists(self._path(self.folder)):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(self.folder))]
        return sorted((n for n in names if n.startswith("pointer-")), reverse=True)

    def current(self) -> dict | None:
        """The published version: {version, number, levels, root}. A pointer that was not written whole does not count."""
        for name in self._pointers():
            lines = [r[0] for r in self.spark.read.text(f"{self.folder}/{name}").collect()]
            if len(lines) == 2 and lines[1] == str(zlib.crc32(lines[0].encode())):
                return json.loads(lines[0])
        return None

    def _publish(self, pointer: dict) -> None:
        """Create the pointer of that number, which fails if another call has published it."""
        body = json.dumps(pointer)
        text = f"{body}\n{zlib.crc32(body.encode())}\n".encode()
        try:
            stream = self._fs.create(self._path(f"{self.folder}/pointer-{pointer['number']:012d}"), False)
        except Exception as e:
            raise RuntimeError(f"version {pointer['number']} is published already") from e
        stream.write(bytearray(text))
        stream.close()

    # what is saved

    def tree(self, now: dict) -> DataFrame:
        """The saved tree of a version, checked against itself and the root that was published."""
        at = f"{self.folder}/{now['version']}/tree"
        if not self._fs.exists(self._path(at)):
            raise DamagedStore(f"the tree of version {now['number']} is missing")
        tree = self.spark.read.schema(NODE).parquet(at)
        root = tree.where("level = 0").select("digest").take(2)
        if [r[0] for r in root] != ([now["root"]] if now["root"] is not None else []) or broken_nodes(tree, now["levels"]).take(1):
            raise DamagedStore(f"the tree of version {now['number']} is not the one published")
        return tree

    def _pages(self, refs: DataFrame) -> DataFrame:
        """The saved cases of the leaves named, (node, page, page_digest): only their files are read."""
        versions = [r[0] for r in refs.select("page").distinct().collect()]  # at most one a call, most of them gone
        out = self.spark.createDataFrame([], "leaf bigint, " + CASE)
        self.pages_read = 0
        for v in versions:
            mine = refs.where(F.col("page") == v).select(F.col("node").alias("leaf"))
            pages = self.spark.read.schema(f"{CASE}, leaf bigint").parquet(f"{self.folder}/{v}/pages")
            listed = [r[0] for r in mine.limit(MAX_LISTED + 1).collect()]
            if len(listed) <= MAX_LISTED:
                pages = pages.where(F.col("leaf").isin(listed))
                self.pages_read += len(listed)
            else:
                pages = pages.join(mine, "leaf", "left_semi")
            out = out.unionByName(pages.select("leaf", "run_id", "file_id", "at", "content"))
        return out

    def published(self) -> DataFrame:
        """All cases that hold as of the published version: (run_id, file_id, at, content)."""
        now = self.current()
        if now is None:
            return self.spark.createDataFrame([], CASE)
        refs = self.tree(now).where((F.col("level") == now["levels"]) & F.col("page").isNotNull())
        pages = self._pages(refs)
        self._check(refs, pages)
        return pages.drop("leaf")

    # a call

    def process(self, feed: DataFrame, run_log: DataFrame) -> DataFrame:
        """What the feed and the runs finished since the last call change: (run_id, file_id, at, content, op).

        op is `new` for a case not published before, `corrected` where rows
        that came late put another row in a published case's place, and
        `withdrawn` where they leave none. Nothing changed gives no rows and
        publishes nothing. Extra columns of the tables are ignored.
        """
        now = self.current()
        number = 1 + (int(self._pointers()[0].rpartition("-")[2]) if self._pointers() else 0)
        # from the files' footers; a tree once grown does not shrink
        levels = max(depth_for(feed.count(), self.per_leaf), now["levels"] if now else 1)
        rows = with_leaf(delivered(feed, run_log), levels)
        leaves = materialize(leaf_digests(rows), "leaves")
        tree, saved = grow(leaves, levels), None
        if now:
            tree, whole = materialize(tree, "tree"), self.tree(now)
            # a tree that has grown deeper shares no nodes with the old one: every leaf is opened once
            saved = whole if now["levels"] == levels else whole.limit(0)
            changed = materialize(descend(tree, saved, levels), "changed")
        else:
            changed = leaves.select("node")  # nothing is saved, so the walk ends at every leaf there is
        self.opened = changed.count()
        if not self.opened and (not now or now["levels"] == levels):
            return self.spark.createDataFrame([], CASE + ", op string")
        version = f"v-{uuid.uuid4().hex}"
        at = f"{self.folder}/{version}"
        near = rows.join(changed.withColumnRenamed("node", "leaf"), "leaf", "left_semi") if now else rows
        cases(taken(near)).write.partitionBy("leaf").parquet(f"{at}/pages")
        pages = self.spark.read.schema(f"{CASE}, leaf bigint").parquet(f"{at}/pages")
        old = None
        if now:
            refs = whole.where((F.col("level") == now["levels"]) & F.col("page").isNotNull())
            refs = materialize(refs.join(changed, "node", "left_semi") if now["levels"] == levels else refs, "refs")
            old = self._pages(refs)
            self._check(refs, old)
        self._difference(pages, old).write.parquet(f"{at}/output")
        self._save_tree(tree, saved, changed, pages, levels, version, at)
        root = self.spark.read.schema(NODE).parquet(f"{at}/tree").where("level = 0").select("digest").take(1)
        self._publish({"version": version, "number": number, "levels": levels, "root": root[0][0] if root else None})
        for x in (leaves, tree, changed):
            release(x)
        return self.spark.read.schema(CASE + ", op string").parquet(f"{at}/output")

    def _check(self, refs: DataFrame, old: DataFrame) -> None:
        """Pages that are opened must be those that were published."""
        found = refs.select("node", "page_digest").join(page_digests(old).withColumnRenamed("page_digest", "__found"), "node", "left")
        if found.where(~F.col("page_digest").eqNullSafe(F.col("__found"))).take(1):
            raise DamagedStore("a page is not the one published")

    @staticmethod
    def _difference(pages: DataFrame, old: DataFrame | None) -> DataFrame:
        if old is None:
            return pages.select("run_id", "file_id", "at", "content", F.lit("new").alias("op"))
        a = pages.select("run_id", "file_id", F.struct("at", "content").alias("now"))
        b = old.select("run_id", "file_id", F.struct("at", "content").alias("was"))
        op = F.when(F.col("was").isNull(), "new").when(F.col("now").isNull(), "withdrawn").when(~F.col("now").eqNullSafe(F.col("was")), "corrected")
        both = a.join(b, ["run_id", "file_id"], "full_outer").withColumn("op", op).where(F.col("op").isNotNull())
        row = F.coalesce("now", "was")
        return both.select("run_id", "file_id", row["at"].alias("at"), row["content"].alias("content"), "op")

    @staticmethod
    def _save_tree(tree: DataFrame, saved: DataFrame | None, changed: DataFrame, pages: DataFrame, levels: int, version: str, at: str) -> None:
        """Leaves that were opened refer to this version's pages, all others to the page they had; a leaf without cases has none."""
        mine = changed.select("node").join(page_digests(pages), "node", "left").withColumn("page", F.when(F.col("page_digest").isNotNull(), version))
        refs = mine.select("node", "page_digest", "page")
        if saved is not None:
            refs = refs.unionByName(saved.where(F.col("level") == levels).join(changed, "node", "left_anti").select("node", "page_digest", "page"))
        refs = refs.withColumn("level", F.lit(levels))
        tree.join(refs, ["level", "node"], "left").select("level", "node", "digest", "n_rows", "page", "page_digest").write.parquet(f"{at}/tree")

    def vacuum(self) -> int:
        """Delete the pages of versions that no leaf refers to any more, and folders of calls that died; returns how many folders went.

        Only for times when no call is running. Outputs of published versions stay.
        """
        now = self.current()
        if now is None:
            return 0
        used = {r[0] for r in self.tree(now).where(F.col("page").isNotNull()).select("page").distinct().collect()} | {now["version"]}
        gone = 0
        for f in self._fs.listStatus(self._path(self.folder)):
            name = f.getPath().getName()
            if name.startswith("v-") and name not in used:
                gone += bool(self._fs.delete(self._path(f"{self.folder}/{name}/pages"), True))
        return gone


def changed_files(feed: DataFrame, run_log: DataFrame) -> DataFrame:
    """Every case of every successful run, (run_id, file_id, at, content): the first call of a new store, which finds nothing saved.

    An empty feed, or one that no successful run sees, gives no rows.
    """
    spark = feed.sparkSession
    folder = forget_later(spark, f"{shared_folder(spark)}/tidemark/store-{uuid.uuid4().hex}")
    return IncrementalStore(spark, folder).process(feed, run_log).drop("op")
