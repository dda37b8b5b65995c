"""Graph operators over edge tables: closures by frontier, redirects by bounded joins.

A closure takes one round a level; the visited set stays distributed and each
round is checkpointed in the shared folder, so lineage does not grow.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import last_segment, spaced
from ..sources.shared import shared_dir

HOPS = 4
#: Levels of a closure that are kept apart before they are written as one table.
_LEVELS = 16


def _cut(frame: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder."""
    shared_dir(frame.sparkSession)
    return frame.checkpoint()


def reachable(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """edges: parent, child; roots: node. All nodes reachable, roots included; cycles are allowed.

    Edges are saved once; a level writes only its new nodes.
    """
    edges = _cut(edges.select("parent", "child").distinct())
    frontier = _cut(roots.select("node").distinct())
    levels = [frontier]
    union = lambda: reduce(DataFrame.unionByName, levels)
    while not frontier.isEmpty():
        ahead = frontier.join(edges, F.col("node") == F.col("parent")).select(F.col("child").alias("node")).distinct()
        frontier = _cut(ahead.join(union(), "node", "left_anti"))
        levels.append(frontier)
        if len(levels) > _LEVELS:
            levels = [_cut(union())]
    return union()


def ancestry(edges: DataFrame) -> DataFrame:
    """ancestor, descendant: all pairs, by doubling path lengths; on a cycle a node is its own ancestor.

    As many rows as there are pairs: for counts, ``descendant_counts`` needs one row a node.
    """
    pairs = new = _cut(edges.select(F.col("parent").alias("ancestor"), F.col("child").alias("descendant")).distinct())
    while not new.isEmpty():
        p, n = pairs.alias("p"), new.alias("n")
        far = p.join(n, F.col("p.descendant") == F.col("n.ancestor")).select("p.ancestor", "n.descendant")
        far = far.unionByName(n.join(p, F.col("n.descendant") == F.col("p.ancestor")).select("n.ancestor", "p.descendant"))
        new = _cut(far.distinct().join(pairs, ["ancestor", "descendant"], "left_anti"))
        pairs = _cut(pairs.unionByName(new))
    return pairs


def descendant_counts(edges: DataFrame) -> DataFrame:
    """node, direct_children, total_descendants of a forest's inner nodes (of several parents of a node, the least counts).

    By pointer doubling: each round a node hands the number of nodes it stands for to the ancestor its pointer leads to,
    and pointers double, so there are as many rounds as the height has bits. Nodes above, on or below a cycle, whose
    pointers never end, get no count (null).
    """
    edges = edges.select("parent", "child").distinct()
    up = edges.groupBy(F.col("child").alias("node")).agg(F.min("parent").alias("up"))
    nodes = edges.select(F.explode(F.array("parent", "child")).alias("node")).distinct()
    state = _cut(nodes.join(up, "node", "left").withColumn("n", F.lit(1).cast("long")))
    rounds = math.ceil(math.log2(state.count() + 1)) + 1
    for _ in range(rounds):
        if state.where("up is not null").isEmpty():
            break
        given = state.where("up is not null").groupBy(F.col("up").alias("node")).agg(F.sum("n").alias("_more"))
        further = state.select(F.col("node").alias("up"), F.col("up").alias("_up"))
        state = _cut(
            state.join(given, "node", "left").join(further, "up", "left").select("node", F.col("_up").alias("up"), (F.col("n") + F.coalesce("_more", F.lit(0))).alias("n"))
        )
    endless = state.where("up is not null").select("node", F.lit(True).alias("_endless"))
    direct = edges.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("direct_children"))
    out = direct.join(state, "node").join(endless, "node", "left")
    return out.select("node", "direct_children", F.when(F.col("_endless").isNull(), F.col("n") - 1).alias("total_descendants"))


def sorted_siblings(nodes: DataFrame, by: str = "name", descending: bool = False) -> DataFrame:
    """nodes: node, parent, timestamp, child_count. Adds place (from 0) among siblings by name, timestamp or child_count.

    What is missing comes last in either direction; ties go by name.
    """
    key = {"name": F.collate(F.coalesce("node", F.lit("")), "fr"), "timestamp": F.col("timestamp"), "child_count": F.col("child_count")}[by]
    order = key.desc_nulls_last() if descending else key.asc_nulls_last()
    same = Window.partitionBy("parent").orderBy(order, F.collate("node", "fr"), "node")
    return nodes.withColumn("place", F.row_number().over(same) - 1)


def tree_view(nodes: DataFrame, edges: DataFrame, types: list[str], by: str = "name", descending: bool = False) -> DataFrame:
    """node, parent, type, child_count, place: nodes of the types with their ancestors, counted and sorted among siblings.

    nodes: node, type, timestamp. ``child_count`` is of the children shown.
    """
    shown = _cut(matching_with_ancestors(nodes, edges, types))
    up = edges.groupBy(F.col("child").alias("node")).agg(F.min("parent").alias("parent"))
    placed = shown.join(up, "node", "left")
    counts = placed.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("child_count"))
    counted = placed.join(counts, "node", "left").withColumn("child_count", F.coalesce("child_count", F.lit(0)))
    return sorted_siblings(counted, by, descending).select("node", "parent", "type", "child_count", "place")


def changes_in_order(changes: DataFrame) -> DataFrame:
    """Changes of ``compare_trees`` with place (from 0) in their status: by last path segment, accents and case aside."""
    last = F.collate(last_segment(F.col("node")), "fr_CI_AI")
    return changes.withColumn("place", F.row_number().over(Window.partitionBy("status").orderBy(last, "node")) - 1)


def matching_with_ancestors(nodes: DataFrame, edges: DataFrame, types: list[str]) -> DataFrame:
    """Nodes (node, type) of the types and all their ancestors."""
    active = nodes.where(F.col("type").isin(types)).select("node")
    upward = edges.select(F.col("child").alias("parent"), F.col("parent").alias("child"))
    return nodes.join(reachable(upward, active), "node", "left_semi")


def flatten(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node, type, children (sorted)."""
    children = edges.distinct().groupBy(F.col("parent").alias("node")).agg(F.sort_array(F.collect_list("child")).alias("children"))
    out = nodes.join(children, "node", "left")
    return out.withColumn("children", F.coalesce("children", F.array().cast("array<string>")))


def compare_trees(a: DataFrame, b: DataFrame) -> DataFrame:
    """Flattened trees: node, status (added, removed, modified), types, children added and removed."""
    both = a.select("node", F.col("type").alias("type_a"), F.col("children").alias("_a")).join(
        b.select("node", F.col("type").alias("type_b"), F.col("children").alias("_b")), "node", "full_outer"
    )
    both = both.withColumn("children_added", F.array_sort(F.array_except("_b", "_a"))).withColumn(
        "children_removed", F.array_sort(F.array_except("_a", "_b"))
    )
    changed = ~F.col("type_a").eqNullSafe(F.col("type_b")) | (F.size("children_added") > 0) | (F.size("children_removed") > 0)
    status = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(changed, "modified")
    return both.withColumn("status", status).where(F.col("status").isNotNull()).drop("_a", "_b")


def category_edges(pages: DataFrame, links: DataFrame, targets: DataFrame) -> DataFrame:
    """parent, child (target ids of categories): a subcategory page's title leads to its own target."""
    own = targets.where(F.col("namespace") == 14).select(F.col("target_id").alias("child"), spaced(F.col("title")).alias("_title"))
    sub = links.where(F.col("type") == "subcat").join(pages.where(F.col("namespace") == 14), "page_id")
    return sub.select(F.col("target_id").alias("parent"), spaced(F.col("title")).alias("_title")).join(own, "_title").select("parent", "child")


def pages_in_category(pages: DataFrame, links: DataFrame, targets: DataFrame, root: str, edges: DataFrame | None = None) -> DataFrame:
    """page_id of namespace 0 in the category tree below ``root``; empty if there is no such category. ``edges`` may be at hand."""
    edges = category_edges(pages, links, targets) if edges is None else edges
    start = targets.where((F.col("namespace") == 14) & (spaced(F.col("title")) == spaced(F.lit(root)))).select(F.col("target_id").alias("node"))
    inside = reachable(edges, start).withColumnRenamed("node", "target_id")
    found = links.where(F.col("type") == "page").join(inside, "target_id", "left_semi").select("page_id").distinct()
    return found.join(pages.where(F.col("namespace") == 0).select("page_id"), "page_id", "left_semi")


def direct_members(pages: DataFrame, links: DataFrame, targets: DataFrame, category: str, kind: str = "page") -> DataFrame:
    """Pages or subcategories directly in a category."""
    own = targets.where((F.col("namespace") == 14) & (spaced(F.col("title")) == spaced(F.lit(category)))).select("target_id")
    return links.where(F.col("type") == kind).join(own, "target_id", "left_semi").join(pages, "page_id")


def shallow_members(pages: DataFrame, links: DataFrame, targets: DataFrame, root: str) -> DataFrame:
    """category (title of a direct subcategory of ``root``), page_id, title of the pages directly in it: no deeper level."""
    subs = direct_members(pages, links, targets, root, "subcat").select(spaced(F.col("title")).alias("category"))
    named = targets.where(F.col("namespace") == 14).select("target_id", spaced(F.col("title")).alias("category"))
    inside = links.where(F.col("type") == "page").join(named.join(subs, "category"), "target_id")
    return inside.select("category", "page_id").join(pages, "page_id").select("category", "page_id", "title").distinct()


def category_sizes(links: DataFrame, targets: DataFrame) -> DataFrame:
    """title, pages, subcats of each category that has members."""
    named = links.join(targets.where(F.col("namespace") == 14), "target_id")
    return named.groupBy(spaced(F.col("title")).alias("title")).agg(
        F.count_if(F.col("type") == "page").alias("pages"), F.count_if(F.col("type") == "subcat").alias("subcats")
    )


def resolve_redirects(redirects: DataFrame, hops: int = HOPS) -> DataFrame:
    """redirects: source, target. Adds resolved: where at most ``hops`` redirects lead, null if more, in a circle or nowhere."""
    edges = redirects.groupBy("source").agg(F.min("target").alias("target"))
    out = edges.select("source", "target", F.col("target").alias("resolved"))
    for _ in range(hops - 1):
        ahead = edges.select(F.col("source").alias("_from"), F.col("target").alias("_to"))
        out = out.join(ahead, F.col("resolved") == F.col("_from"), "left")
        out = out.withColumn("resolved", F.coalesce("_to", "resolved")).drop("_from", "_to")
    still = edges.select(F.col("source").alias("_from"))
    out = out.join(still, F.col("resolved") == F.col("_from"), "left")
    return out.select("source", F.when(F.col("_from").isNull(), F.col("resolved")).alias("resolved"))
