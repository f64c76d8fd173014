"""Parent-child links to full hierarchies (problem 6), by pointer doubling.

Every node points to an ancestor; each round replaces the pointer by the
pointer of the node pointed to, so it jumps twice as far. After k rounds every
node within 2**k of its root is resolved. If nodes of depth d exist, nodes of
every smaller depth do, so each round resolves some as long as any can be
resolved; what is left when a round resolves none leads into a cycle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.common import first_element
from ..session import materialize, release
from .references import current_rows
from .skew import split_join


def folder_links(items: DataFrame, drives: DataFrame) -> DataFrame:
    """(node, parent, root, name) of the folders' current rows.

    parent is the first element of parents, if that is itself a folder; else
    null, and root is the drive or, for a blank or unlisted parent, the folder
    itself (`root_step` tells 1 from 0). A folder whose first parent is listed
    but is no folder ends there: it counts as topmost.
    """
    folders = current_rows(items, "object_kind", "parents", "name").where(F.col("object_kind") == "folder").select(F.col("file_id").alias("node"), first_element("parents").alias("up"), "name")
    ids = folders.select(F.col("node").alias("up"), F.lit(True).alias("__folder"))
    roots = drives.select(F.col("drive_id").alias("up"), F.lit(True).alias("__drive"), F.col("shared_drive_name").alias("drive_name")).dropDuplicates(["up"])
    at = split_join(split_join(folders, ids, "up", "left"), roots, "up", "left", hot=[])
    drive, folder = F.coalesce("__drive", F.lit(False)), F.coalesce("__folder", F.lit(False))
    return at.select(
        "node", F.when(folder & ~drive, F.col("up")).alias("parent"), F.when(drive, F.col("up")).when(~folder, F.col("node")).alias("root"), F.when(drive, 1).when(~folder, 0).alias("root_step"), "name",
        F.when(drive, F.concat(F.lit("/"), F.col("drive_name"))).otherwise(F.lit("")).alias("root_path"),
    )


def resolve_hierarchy(links: DataFrame, paths: bool = False) -> DataFrame:
    """Per node: root_id, depth, n_below (nodes among all descendants), on_cycle and, if asked, full_path and the list of ancestors.

    links: (node, parent, root, root_step, name, root_path); node is unique,
    and exactly one of parent and root is filled. Nodes that lead into a cycle
    have root_id CYCLE, depth and n_below -1, and null paths. An empty table
    gives no rows.

    A node pointed to by a large share of all nodes is joined by split_join,
    and the counts below are summed with partial aggregation, so a folder with
    a third of all folders under it is no hot task.
    """
    name = F.concat(F.lit("/"), F.coalesce("name", F.lit("")))
    start = links.select(
        "node", F.col("parent").alias("ptr"), "root", F.col("root_step").alias("steps"), F.lit(0).cast("bigint").alias("below"),
        *([F.when(F.col("root").isNotNull(), F.concat("root_path", name)).otherwise(name).alias("path"), F.when(F.col("parent").isNotNull(), F.array("parent")).otherwise(F.array().cast("array<string>")).alias("above")] if paths else []),
    )
    # below starts as the number of nodes in the window [1, 2**k) above which each pointer jumps: none for k = 0
    cur = materialize(start, "tree")
    jump, open_now = 1, cur.where(F.col("root").isNull()).count()
    while open_now:
        # descendants within 2**(k+1)-1 steps = those within 2**k-1, plus, for each node exactly 2**k below, that node and those within 2**k-1 of it
        got = cur.where(F.col("ptr").isNotNull()).groupBy(F.col("ptr").alias("node")).agg(F.sum(F.col("below") + 1).alias("__more"))
        far = cur.select(F.col("node").alias("ptr"), F.col("ptr").alias("__ptr"), F.col("root").alias("__root"), F.col("steps").alias("__steps"), *([F.col("path").alias("__path"), F.col("above").alias("__above")] if paths else []))
        j = split_join(cur, far, "ptr", "left")
        step = j.select(
            "node", F.col("__ptr").alias("ptr"), F.coalesce("root", "__root").alias("root"),
            F.when(F.col("root").isNotNull(), F.col("steps")).when(F.col("__root").isNotNull(), F.col("__steps") + F.lit(jump)).alias("steps"), "below",
            *([F.concat(F.coalesce("__path", F.lit("")), F.col("path")).alias("path"), F.concat("above", F.coalesce("__above", F.array().cast("array<string>"))).alias("above")] if paths else []),
        )
        new = materialize(step.join(got, "node", "left").withColumn("below", F.col("below") + F.coalesce("__more", F.lit(0))).drop("__more"), "tree")
        release(cur)
        cur, jump, before = new, jump * 2, open_now
        open_now = cur.where(F.col("root").isNull()).count()
        if open_now == before:
            break
    # pointers that reach past a resolved node's root are null, so only cyclic nodes still have one
    loop = None
    if open_now:
        ring = materialize(cur.where(F.col("root").isNull()).select("node", "ptr"), "ring")
        n = jump  # how far the pointers jump already
        while n < open_now:  # after as many jumps as there are nodes, every pointer has come to lie on a cycle, and every node of a cycle is one
            nxt = materialize(split_join(ring, ring.select(F.col("node").alias("ptr"), F.col("ptr").alias("__next")), "ptr", "inner").select("node", F.col("__next").alias("ptr")), "ring")
            release(ring)
            ring, n = nxt, n * 2
        loop = ring.select(F.col("ptr").alias("node")).distinct().withColumn("__loop", F.lit(1))
    cyclic = F.col("root").isNull()
    out = cur.join(loop, "node", "left") if loop is not None else cur.withColumn("__loop", F.lit(None).cast("int"))
    return out.select(
        F.col("node").alias("file_id"), F.coalesce("root", F.lit("CYCLE")).alias("root_id"), F.when(cyclic, -1).otherwise(F.col("steps")).cast("int").alias("depth"),
        F.when(cyclic, -1).otherwise(F.col("below")).cast("int").alias("n_below"), F.coalesce("__loop", F.lit(0)).cast("int").alias("on_cycle"),
        *([F.when(~cyclic, F.col("path")).alias("full_path"), F.when(~cyclic, F.col("above")).alias("ancestors")] if paths else []),
    )


def descendants(tree: DataFrame) -> DataFrame:
    """(ancestor, file_id, distance): one row for every folder and each folder above it; cyclic folders have none.

    tree: resolve_hierarchy(..., paths=True). The result is as large as the sum of all depths.
    """
    return tree.select("file_id", F.posexplode("ancestors").alias("d", "ancestor")).select("ancestor", "file_id", (F.col("d") + 1).alias("distance"))


def subtree(tree: DataFrame, roots: list[str]) -> DataFrame:
    """The rows of `tree` (with ancestors) that are one of a few given folders or lie below one, each once."""
    return tree.where(F.col("file_id").isin(roots) | F.coalesce(F.arrays_overlap("ancestors", F.array(*map(F.lit, roots))), F.lit(False)))


def children(items: DataFrame) -> DataFrame:
    """(parent, file_id): every object under every parent it names, blank ones left out."""
    kids = items.select("file_id", F.explode(F.split("parents", ";")).alias("parent"))
    return kids.where(F.trim("parent") != "").select("parent", "file_id").distinct()
