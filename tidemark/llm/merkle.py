"""A Merkle manifest of a dataset: a tree of digests over its rows, and a proof for each row.

The tree is kept as a content-addressed store: a record leads from a digest to the digests of its children. Records
are packed into pages. A page holds all records of the up to six levels below a node, as the rows of digests of those
levels (the children of a digest are three neighbours in the row below), and is found by the node's digest.

Requests for leaves descend from the root. The digits of a leaf's rank, in base 3, say which child to take; the digests
of the children not taken are a segment of its path. Requests that share a page go through it together, so that the
root is not asked once for each leaf. At the leaves the path is turned round: it then leads from the leaf to the root.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage
from .ranking import ranked

FANOUT, LEVELS = 3, 6
PAGE = FANOUT**LEVELS
_PATH = "array<struct<left: string, right: string>>"


def field(column: Column) -> Column:
    """A value as text that can be told from its neighbours: its UTF-8 length, a colon and the value; - if null."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, columns)), 256)


def _row_above(row: Column) -> Column:
    """Digests of neighbouring threes; the last may be of fewer."""
    first = F.sequence(F.lit(0), (F.size(row) - 1).cast("int"), F.lit(FANOUT))
    return F.transform(first, lambda i: F.sha2(F.array_join(F.slice(row, i + 1, FANOUT), ""), 256))


def _height(n: Column) -> Column:
    """Levels above n nodes of one tree, within a page."""
    height = F.lit(LEVELS)
    for k in reversed(range(LEVELS)):
        height = F.when(n <= FANOUT**k, k).otherwise(height)
    return height


@dataclass
class Forest:
    """Pages of all trees, by stride from the leaves up, and the root of each tree."""

    pages: list[DataFrame]  # digest, rows, height: one record for each digest
    roots: DataFrame  # tree, digest, stride: where the tree's top page is


def build(nodes: DataFrame, label: str) -> Forest:
    """Trees over (tree, rank, digest), ranks from 0 without gaps in each tree."""
    pages, roots, stride = [], [], 0
    while True:
        sizes = nodes.groupBy("tree").agg(F.count("*").alias("n"))
        page = F.floor(F.col("rank") / PAGE).cast("long")
        grouped = nodes.groupBy("tree", page.alias("page")).agg(F.sort_array(F.collect_list(F.struct("rank", "digest")))["digest"].alias("row0"))
        grouped = grouped.join(sizes, "tree").withColumn("height", _height(F.col("n")))
        for k in range(LEVELS):
            above = F.when(F.col("height") > k, _row_above(F.col(f"row{k}")))
            grouped = grouped.withColumn(f"row{k + 1}", above)
        rows = F.slice(F.array(*[F.col(f"row{k}") for k in range(LEVELS + 1)]), F.lit(1), F.col("height") + 1)
        made = grouped.select("tree", "page", "n", "height", rows.alias("rows"))
        made = made.select("tree", "page", "n", "height", "rows", F.element_at(F.element_at("rows", -1), 1).alias("digest"))
        made = stage(made, f"{label}-pages")
        pages.append(made.select("digest", "rows", "height").dropDuplicates(["digest"]))
        roots.append(made.filter(F.col("n") <= PAGE).select("tree", "digest", F.lit(stride).alias("stride")))
        nodes = made.filter(F.col("n") > PAGE).select("tree", F.col("page").alias("rank"), "digest")
        stride += 1
        if nodes.isEmpty():
            break
    found = roots[0]
    for more in roots[1:]:
        found = found.union(more)
    return Forest(pages, stage(found, f"{label}-roots"))


def _segments(rows: Column, height: Column, offset: Column) -> Column:
    """The children not taken on the way down a page to a node of its lowest row, from the top."""

    leaves_below = F.array(*[F.lit(FANOUT**k) for k in range(LEVELS)])

    def passed(k):
        at = F.floor(offset / F.element_at(leaves_below, k + 1)).cast("int")
        first = at - at % FANOUT
        row = F.element_at(rows, k + 1)
        left = F.array_join(F.slice(row, first + 1, at - first), "")
        right = F.array_join(F.slice(row, at + 2, first + FANOUT - 1 - at), "")
        return F.struct(left.alias("left"), right.alias("right"))

    levels = F.slice(F.array(*[F.lit(k) for k in range(LEVELS)]), F.lit(1), height)
    return F.transform(F.reverse(levels), passed)


def descend(forest: Forest, starts: DataFrame, requests: DataFrame) -> DataFrame:
    """Rows of ``requests`` (tree, rank, asked) as (tree, rank, digest, path, kept, asked); path leads from the leaf up.

    ``starts`` has (tree, path, kept): what leads from the root above all trees down to each tree's root, from the top,
    and a value to carry along. ``asked`` is a value of the request's own.
    """
    entries = forest.roots.join(starts, "tree").select("tree", "stride", "digest", F.lit(0).cast("long").alias("page"), "path", "kept")
    reached = None
    for stride in reversed(range(len(forest.pages))):
        here = entries.filter(F.col("stride") == stride).drop("stride")
        if reached is not None:
            here = here.unionByName(stage(reached.select("tree", "digest", F.col("rank").alias("page"), "path", "kept"), "requests"))
        node = F.floor(F.col("rank") / PAGE**stride).cast("long")
        asked = F.lit(None) if stride else F.col("asked")
        wanted = requests.select("tree", node.alias("node"), asked.alias("asked"))
        wanted = wanted.distinct() if stride else wanted
        place = F.struct((F.col("node") % PAGE).cast("int").alias("offset"), "asked")
        wanted = wanted.groupBy("tree", F.floor(F.col("node") / PAGE).cast("long").alias("page")).agg(F.collect_list(place).alias("wanted"))
        found = here.join(wanted, ["tree", "page"]).join(forest.pages[stride], "digest")

        def step(w):
            path = F.concat("path", _segments(F.col("rows"), F.col("height"), w["offset"]))
            child = F.element_at(F.element_at("rows", 1), w["offset"] + 1)
            return F.struct(w["offset"].alias("offset"), child.alias("digest"), path.alias("path"), w["asked"].alias("asked"))

        # Only what is asked for leaves the row that holds the page.
        found = found.select("tree", "page", "kept", F.explode(F.transform("wanted", step)).alias("w"))
        reached = found.select("tree", (F.col("page") * PAGE + F.col("w.offset")).alias("rank"), "w.digest", "w.path", "kept", "w.asked")
    return reached.withColumn("path", F.reverse("path"))


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    return F.aggregate(path, digest, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def siblings(path: Column) -> Column:
    """All digests of a path, from the leaf up and from left to right, as one text."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def manifest(docs: DataFrame, columns: list[str], group: str, id_col: str, offered: list[Column] | None = None) -> DataFrame:
    """Columns id_col, leaf, subroot, root, path, offered_leaf: the manifest's digests of every row, with its proof.

    A leaf is the SHA-256 of the row's fields in the order of ``columns``. Leaves of one value of ``group`` ascend by id,
    three neighbours give a node (the last one of a row may have fewer), and so on to one subroot; subroots in the order
    of their group (null first, then by bytes) likewise give the root. ``path`` leads from the leaf to the root.
    ``offered_leaf`` is the digest of the fields ``offered``, which a verifier may fold along the path.

    Null values are marked as such and differ from every text. Rows with equal ids are ordered by their leaf, and equal
    rows each have a leaf and a proof of their own; null ids come first. One row: leaf, subroot and root are the same and
    the path is empty. An empty table gives an empty result. Other columns of the input are not looked at.
    """
    named = [F.col(f"`{c}`") for c in columns]
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    hashed = docs.select(
        tree.alias("tree"),
        F.col(f"`{id_col}`").alias("id"),
        leaf_digest(named).alias("digest"),
        leaf_digest(offered or named).alias("offered"),
        F.monotonically_increasing_id().alias("tie"),
    )
    hashed = stage(hashed, "leaves")
    leaves = ranked(hashed, "tree", [F.col("id").asc_nulls_first(), F.col("digest"), F.col("tie")], "ordered")
    forest = build(leaves.select("tree", "rank", "digest"), "rows")

    groups = forest.roots.select(F.lit("").alias("all"), F.col("tree").alias("group"), "digest")
    groups = stage(ranked(groups, "all", [F.col("group")], "groups").select(F.col("all").alias("tree"), "rank", "digest", "group"), "ranked-groups")
    top = build(groups.select("tree", "rank", "digest"), "groups")
    whole = top.roots.first()
    start = top.roots.select("tree", F.array().cast(_PATH).alias("path"), F.lit(None).alias("kept"))
    to_groups = descend(top, start, groups.select("tree", "rank", F.col("group").alias("asked")))
    # A group's path is needed from the top here, as the way down goes on.
    starts = to_groups.select(F.col("asked").alias("tree"), F.reverse("path").alias("path"), F.col("digest").alias("kept"))
    asked = F.struct("id", "offered").alias("asked")
    proved = descend(forest, stage(starts, "group-paths"), leaves.select("tree", "rank", asked))
    return proved.select(
        F.col("asked.id").alias(id_col),
        F.col("digest").alias("leaf"),
        F.col("kept").alias("subroot"),
        F.lit(whole["digest"] if whole else None).cast("string").alias("root"),
        "path",
        F.col("asked.offered").alias("offered_leaf"),
    )
