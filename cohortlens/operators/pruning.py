"""Cost-complexity pruning of a fitted decision tree: its saved node rows are cut back and loaded as a normal model."""

from __future__ import annotations

import heapq

from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.sql import Row

from cohortlens.session import shared_folder


def weakest_links(nodes: dict[int, Row], alpha: float) -> set[int]:
    """The nodes that become leaves: links are cut, the weakest first, while a leaf less costs at most ``alpha``.

    A node costs its impurity times its share of the rows. The strength of a link is what the tree below it saves, for each leaf that it has
    more than one; equal ones go by number.
    """
    total = sum(nodes[0]["impurityStats"])
    cost = {i: r["impurity"] * sum(r["impurityStats"]) / total for i, r in nodes.items()}
    parent, order, stack = {0: None}, [], [0]
    while stack:
        i = stack.pop()
        order.append(i)
        if nodes[i]["leftChild"] >= 0:
            for child in (nodes[i]["leftChild"], nodes[i]["rightChild"]):
                parent[child] = i
                stack.append(child)
    leaves, below = {}, {}
    for i in reversed(order):
        split = nodes[i]["leftChild"] >= 0
        children = (nodes[i]["leftChild"], nodes[i]["rightChild"]) if split else ()
        leaves[i] = sum(leaves[c] for c in children) if split else 1
        below[i] = sum(below[c] for c in children) if split else cost[i]
    strength = lambda i: (cost[i] - below[i]) / (leaves[i] - 1)
    heap = [(strength(i), i) for i in order if leaves[i] > 1]
    heapq.heapify(heap)
    cut: set[int] = set()
    while heap and heap[0][0] <= alpha:
        s, i = heapq.heappop(heap)
        # what was pushed before its tree changed, or lies below a cut, counts no more
        if leaves[i] == 1 or s != strength(i):
            continue
        above, gone = i, False
        while above is not None and not gone:
            gone = above in cut
            above = parent[above]
        if gone:
            continue
        cut.add(i)
        fewer, more = leaves[i] - 1, cost[i] - below[i]
        at: int | None = i
        while at is not None:
            leaves[at] -= fewer
            below[at] += more
            if leaves[at] > 1:
                heapq.heappush(heap, (strength(at), at))
            at = parent[at]
    return cut


def pruned(model: DecisionTreeClassificationModel, alpha: float) -> DecisionTreeClassificationModel:
    """The tree without links whose strength is at most ``alpha``; 0 leaves it as it is. Nodes are no more than the model the driver holds."""
    if alpha <= 0 or model.numNodes == 1:
        return model
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    path = f"{shared_folder(spark)}/tree"
    model.write().overwrite().save(f"{path}/whole")
    table = spark.read.parquet(f"{path}/whole/data")
    nodes = {r["id"]: r for r in table.collect()}
    cut = weakest_links(nodes, alpha)
    if not cut:
        return model
    leaf = Row(featureIndex=-1, leftCategoriesOrThreshold=[], numCategories=-1)
    # numbers in the order in which Spark writes a tree: a node, its left part, its right part
    kept, stack = [], [0]
    while stack:
        i = stack.pop()
        kept.append(i)
        if i not in cut and nodes[i]["leftChild"] >= 0:
            stack += [nodes[i]["rightChild"], nodes[i]["leftChild"]]
    number = {i: k for k, i in enumerate(kept)}
    rows = []
    for i in kept:
        own = nodes[i].asDict()
        own["id"] = number[i]
        if i in cut:
            own |= {"gain": -1.0, "leftChild": -1, "rightChild": -1, "split": leaf}
        elif own["leftChild"] >= 0:
            own |= {"leftChild": number[own["leftChild"]], "rightChild": number[own["rightChild"]]}
        rows.append(tuple(own[c] for c in table.columns))
    spark.read.text(f"{path}/whole/metadata").coalesce(1).write.text(f"{path}/cut/metadata")
    spark.createDataFrame(rows, table.schema).coalesce(1).write.parquet(f"{path}/cut/data")
    return DecisionTreeClassificationModel.load(f"{path}/cut")
