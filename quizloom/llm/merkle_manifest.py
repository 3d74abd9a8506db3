"""Merkle manifest of a dataset as a content-addressed graph of nodes.

Every row is a leaf, a hash of its columns. Per tree (a source), leaves are ranked by
their key, and runs of ``FAN`` consecutive nodes become the hash of their digests until
one is left; the subroots, in order of their source, become the root in the same way.
A node is stored as a record from its digest to its children's digests, and nothing
else is needed to prove a leaf: the request descends from the root, choosing at each
node the child that the rank's digit (base ``FAN``) names and collecting the others,
then reverses what it has collected.

Requests descend together. At a height the frontier holds one row for each node below
which something is asked for, so the root is read once, not once for each leaf, and the
last step, the widest, moves a path for each run of ``FAN`` leaves. Every step is an
equi-join on digests; a task never holds more than a run and its path.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.operators.ordering import with_position
from quizloom.staging import staged

FAN = 16


def hashed(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts in turn."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value that can't be mistaken for another: ``-`` for null, else its UTF-8 bytes, ``:`` and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return hashed(*map(field, values))


def lowered(text: Column) -> Column:
    """The text with A-Z in lower case, other letters as they are."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def ranked(leaves: DataFrame, tree: list[Column], order: list[Column]) -> DataFrame:
    """``leaves`` with ``tree`` (a number from 0) and ``rank`` (from 0 within it).

    Trees are numbered in the order of the columns ``tree``, nulls first, and the leaves of
    each by ``order``. One range sort over the leaves; a tree may hold any share of them.
    """
    firsts = [c.asc_nulls_first() for c in tree]
    placed = with_position(leaves.withColumn("_tree", F.struct(*tree)), [*firsts, *order], "_position")
    placed = staged(placed, "merkle-placed")
    trees = placed.groupBy("_tree").agg(F.min("_position").alias("_first"))
    trees = with_position(staged(trees, "merkle-trees"), [F.col("_first").asc()], "_number")
    # A null in the struct is a value like any other.
    trees = trees.select(F.col("_tree").alias("_known"), "_first", (F.col("_number") - 1).alias("tree"))
    found = placed.join(trees, F.col("_tree").eqNullSafe(F.col("_known")))
    rows = found.withColumn("rank", F.col("_position") - F.col("_first"))
    return rows.drop("_tree", "_known", "_first", "_position")


def built(leaves: DataFrame, fan: int = FAN) -> tuple[list[DataFrame], DataFrame]:
    """The records and subroots above ``leaves`` (``tree``, ``rank``, ``digest``).

    Records are one table for each height from 1 on: ``digest`` to ``children``, in order.
    Equal subtrees are one record. Subroots are ``tree``, ``height`` and ``digest``; the
    subroot of a single leaf is the leaf, at height 0.
    """
    nodes = staged(leaves.select("tree", F.col("rank").alias("at"), "digest"), "merkle-leaves")
    records, tops, height = [], None, 0
    while True:
        # A tree is finished once its only node is at place 0 and no other is there.
        width = nodes.groupBy("tree").agg(F.max("at").alias("last"))
        done = width.where("last = 0").select("tree")
        top = nodes.where("at = 0").join(done, "tree").select("tree", F.lit(height).alias("height"), "digest")
        tops = top if tops is None else tops.union(top)
        open_trees = width.where("last > 0").select("tree")
        if open_trees.isEmpty():
            return records, staged(tops, "merkle-subroots")
        height += 1
        open_nodes = nodes if done.isEmpty() else nodes.join(open_trees, "tree", "left_semi")
        runs = open_nodes.groupBy("tree", F.floor(F.col("at") / F.lit(fan)).alias("at")).agg(
            F.sort_array(F.collect_list(F.struct("at", "digest"))).alias("run")
        )
        children = F.transform("run", lambda x: x["digest"])
        level = staged(
            runs.select("tree", "at", children.alias("children")).withColumn(
                "digest", F.sha2(F.array_join("children", "").cast("binary"), 256)
            ),
            f"merkle-height-{height}",
        )
        # Trees with equal subtrees share the record.
        records.append(level.select("digest", "children").dropDuplicates(["digest"]))
        nodes = level.select("tree", "at", "digest")


def others(children: Column, digit: Column) -> Column:
    """What a path keeps of a node: the digests before and after the chosen child."""
    before = F.array_join(F.slice(children, F.lit(1), digit), "")
    after = F.array_join(F.slice(children, digit + 2, F.size(children)), "")
    return F.struct(before.alias("before"), after.alias("after"))


def descended(frontier: DataFrame, store: DataFrame, wanted: DataFrame, fan: int = FAN) -> DataFrame:
    """The children of ``frontier`` (``tree``, ``at``, ``digest``, ``path``) that lie above something wanted.

    ``wanted`` holds ``tree`` and ``at`` of the nodes to reach, one height further down.
    """
    carried = [c for c in frontier.columns if c not in ("tree", "at", "digest", "path")]
    below = wanted.select("tree", F.col("at").alias("next"), F.floor(F.col("at") / F.lit(fan)).alias("at"))
    met = frontier.join(store, "digest").join(below, ["tree", "at"])
    digit = F.pmod(F.col("next"), F.lit(fan)).cast("int")
    return met.select(
        "tree",
        F.col("next").alias("at"),
        F.get("children", digit).alias("digest"),
        F.concat("path", F.array(others(F.col("children"), digit))).alias("path"),
        *carried,
    ).where("digest IS NOT NULL")


def prefixes(wanted: DataFrame, height: int, fan: int = FAN) -> list[DataFrame]:
    """The distinct nodes above ``wanted`` (``tree``, ``at``) at each height from 0 to ``height``."""
    levels = [wanted]
    for _ in range(height):
        up = F.floor(F.col("at") / F.lit(fan)).alias("at")
        levels.append(staged(levels[-1].select("tree", up).distinct(), "merkle-wanted"))
    return levels


EMPTY_PATH = "CAST(array() AS array<struct<before: string, after: string>>)"


def proofs(
    root: str,
    source_records: list[DataFrame],
    subroots: DataFrame,
    records: list[DataFrame],
    requests: DataFrame,
    fan: int = FAN,
) -> DataFrame:
    """The leaf and its path for each of ``requests`` (``tree``, ``rank``, further columns).

    Adds ``digest``, the leaf; ``subroot``; and ``path``, from the leaf's own run up to the
    root: the digests before and after the node on the way, in each run. Of ``subroots`` only
    the heights are used; every digest below ``root`` is found in a record. Requests for a
    rank that a tree doesn't have, and for trees that aren't there, are left out. A leaf is
    asked for once: requests of a run travel together.
    """
    spark = requests.sparkSession
    heights = subroots.select("tree", "height")
    kept = [c for c in requests.columns if c not in ("tree", "rank")]
    asked = requests.join(heights, "tree")
    tree_nodes = staged(asked.select("tree").distinct(), "merkle-asked")
    # Down the tree of sources: its leaves are the subroots, ranked by the tree's number.
    above = prefixes(
        tree_nodes.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at")), len(source_records), fan
    )
    frontier = spark.range(1).select(
        F.lit(0).cast("long").alias("tree"),
        F.lit(0).cast("long").alias("at"),
        F.lit(root).cast("string").alias("digest"),
        F.expr(EMPTY_PATH).alias("path"),
    )
    for height in range(len(source_records), 0, -1):
        frontier = descended(frontier, source_records[height - 1], above[height - 1], fan)
    tops = staged(frontier.select(F.col("at").alias("tree"), "digest", "path"), "merkle-tops").join(heights, "tree")
    tops = tops.select(
        "tree", F.lit(0).cast("long").alias("at"), "digest", "path", F.col("digest").alias("subroot"), "height"
    )
    # Down the trees: each joins in at its own height.
    runs = asked.groupBy("tree", F.floor(F.col("rank") / F.lit(fan)).alias("at"), "height").agg(
        F.collect_list(F.struct("rank", *kept)).alias("asked")
    )
    runs = staged(runs, "merkle-runs")
    below = prefixes(runs.where("height > 0").select("tree", "at"), max(len(records) - 1, 0), fan)
    frontier = None
    for height in range(len(records), 0, -1):
        here = tops.where(F.col("height") == height).drop("height")
        frontier = here if frontier is None else frontier.union(here)
        if height > 1:
            of_height = below[height - 2]
            frontier = staged(descended(frontier, records[height - 1], of_height, fan), "merkle-frontier")
    single = tops.where("height = 0").join(
        runs.where("height = 0").select("tree", F.explode("asked").alias("one")), "tree"
    )
    found = single.where("one.rank = 0").select(
        "tree", *[F.col(f"one.{c}").alias(c) for c in ("rank", *kept)], "digest", "subroot", F.reverse("path").alias("path")
    )
    if frontier is not None:
        # The last step keeps a run together until its path has been met.
        met = frontier.join(records[0], "digest").drop("digest")
        met = met.join(runs.where("height > 0").drop("height"), ["tree", "at"])
        digit = F.pmod(F.col("one.rank"), F.lit(fan)).cast("int")
        each = met.select("tree", "subroot", "path", "children", F.explode("asked").alias("one"))
        found = found.union(
            each.where(digit < F.size("children")).select(
                "tree",
                *[F.col(f"one.{c}").alias(c) for c in ("rank", *kept)],
                F.get("children", digit).alias("digest"),
                "subroot",
                F.reverse(F.concat("path", F.array(others(F.col("children"), digit)))).alias("path"),
            )
        )
    return found


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(
        path, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]).cast("binary"), 256)
    )


def path_hash(path: Column) -> Column:
    """Hash of all siblings, from the leaf's run to the root, each run from left to right."""
    siblings = F.transform(path, lambda step: F.concat(step["before"], step["after"]))
    return F.sha2(F.array_join(siblings, "").cast("binary"), 256)


def manifest(
    rows: DataFrame, key: str, tree: str, columns: list[str], tampered: Column, changed: dict[str, Column], fan: int = FAN
) -> DataFrame:
    """A leaf, a proof and a check of it for every row.

    ``columns`` are hashed in their order. Where ``tampered`` holds, the row that is checked
    has the columns of ``changed`` instead, and its own proof. Returns ``key``, ``leaf``,
    ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified``.

    Nulls are hashed as ``-``, empty texts as ``0:``. Rows with a null ``tree`` are a tree of
    their own, the first one; null keys come before all others, and rows of equal keys are
    ordered by their leaves. Repeated rows are leaves of their own. Texts are hashed where
    they are read and go nowhere. An empty table gives an empty table. Other columns are
    not read.
    """
    now = {c: changed.get(c, F.col(c)) for c in columns}
    leaves = rows.select(
        F.col(key).alias("_key"),
        F.col(tree).alias("_source"),
        leaf_hash(*map(F.col, columns)).alias("digest"),
        # Null where nothing was changed: the row is checked as it is.
        F.when(F.coalesce(tampered, F.lit(False)), leaf_hash(*now.values())).alias("_shown"),
    )
    # Written before it is sorted: sampling for the sort would hash every text again.
    leaves = staged(leaves, "merkle-hashed")
    placed = ranked(leaves, [F.col("_source")], [F.col("_key").asc_nulls_first(), F.col("digest").asc()])
    placed = staged(placed.drop("_source"), "merkle-ranked")
    records, subroots = built(placed, fan)
    # The subroots are the leaves of one more tree, whose order is that of their numbers.
    tops = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), "digest")
    source_records, top = built(tops, fan)
    top = top.first()  # one row, or none
    root = top and top["digest"]
    found = proofs(root, source_records, subroots, records, placed.drop("digest"), fan)
    shown = F.coalesce("_shown", "digest")
    return found.select(
        F.col("_key").alias(key),
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root).cast("string").alias("root"),
        path_hash(F.col("path")).alias("proof_sha256"),
        folded(shown, F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def document_manifest(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """The manifest of documents by source; every fifth one (by its key's crc) shown with its text in lower case."""
    fifth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest(
        docs,
        "doc_id",
        "source",
        ["doc_id", "source", "lang", "n_chars", "text"],
        fifth,
        {"text": lowered(F.col("text"))},
        fan,
    )
