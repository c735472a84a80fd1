"""Problem 4: splits that keep related records together.

Method: frontier breadth-first components.  Adjacency lists are hash-partitioned; many seeds (the nodes whose hash is
least among their neighbours) grow at once; where labels of two seeds collide an edge of a much smaller graph is
noted; that graph is merged, in one task when it is small and by another round when it is not; components are dealt
to the splits in the order of their hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import cut
from ..plans.skew import HOT_ONE_IN, grid_join, hot_cold_join

#: Most collision edges that one task merges; expansions of the frontier in a round; neighbours from which a node
#: can be a hub, the most hubs there can be, and the shares a hub's list is split into.
SMALL_GRAPH, STEPS, HUB, HUBS, SALTS = 200_000, 2, 1_000, 10_000, 32
#: Members from which a component can be hot.
HOT = 1_000


def _union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    up: dict[str, str] = {}

    def root(x: str) -> str:
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                up[max(a, b)] = min(a, b)
    if up:
        names = list(up)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([root(x) for x in names], pa.string())], names=["node", "label"])


def _grow(edges: DataFrame, seed: int, steps: int, total: int) -> DataFrame:
    """(node, label, d): every node with the seed that reached it first and its neighbours' number; edges, ``total`` of them, hold both directions."""
    degree = cut(edges.groupBy("src").agg(F.count(F.lit(1)).alias("d")), "degrees")
    bar = max(HUB, total // HUBS)
    hubs = F.broadcast(degree.filter(F.col("d") >= bar).select("src", F.lit(True).alias("hub")))  # no more than HUBS by arithmetic
    nodes = degree.select(F.col("src").alias("node"), "d", F.struct(F.xxhash64(F.lit(seed), "src").alias("h"), F.col("src").alias("s")).alias("rank"), (F.col("d") >= bar).alias("hub"))
    salt = F.when(F.col("hub"), F.pmod(F.xxhash64("dst"), F.lit(SALTS)).cast("int")).otherwise(0)
    lists = cut(edges.join(hubs, "src", "left").select("src", "dst", salt.alias("salt")), "adjacency")
    spread = F.explode(F.when(F.col("hub"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))

    def told(state: DataFrame, what: Column) -> DataFrame:
        """Least of what its neighbours say, by node; what a hub says is copied to the shares of its list."""
        said = state.select(F.col("node").alias("src"), what.alias("say"), "hub").filter("say is not null").select("src", "say", spread.alias("salt"))
        return lists.join(said, ["src", "salt"]).groupBy(F.col("dst").alias("node")).agg(F.min("say").alias("least"))

    least = told(nodes, F.col("rank"))
    state = cut(nodes.join(least, "node", "left").select("node", "d", "hub", "rank", F.when(F.col("least").isNull() | (F.col("rank") < F.col("least")), F.col("rank")).alias("label")), "frontier")
    for _ in range(steps):
        state = cut(state.join(told(state, F.col("label")), "node", "left").select("node", "d", "hub", "rank", F.coalesce("label", "least").alias("label")), "frontier")
    return state.select("node", F.coalesce(F.col("label.s"), F.col("node")).alias("label"), "d")


def components(edges: DataFrame, a: str = "a", b: str = "b", small_graph: int = SMALL_GRAPH, steps: int = STEPS) -> DataFrame:
    """(node, component) of every node of an undirected graph with string nodes.

    Loops and repeated edges change nothing; an edge with a null end is dropped.  ``component`` is some node of the
    component.  Every round contracts each seed's region to one node; a graph of more than ``small_graph`` collision
    edges goes through another round, so no task ever holds more than that.
    """
    graph = edges.select(F.col(a).alias("src"), F.col(b).alias("dst")).filter("src is not null and dst is not null")
    graph = cut(graph.unionByName(graph.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(), "edges")
    maps: list[DataFrame] = []
    while True:
        total = graph.count()
        label = cut(_grow(graph, len(maps), steps, total), "labels")
        maps.append(label.select("node", "label"))
        at_src, at_dst = label.select(F.col("node").alias("src"), F.col("label").alias("la"), F.col("d").alias("ds")), label.select(F.col("node").alias("dst"), F.col("label").alias("lb"), F.col("d").alias("dd"))
        ends = hot_cold_join(hot_cold_join(graph.filter("src <> dst"), at_src, "src", "ds", total), at_dst, "dst", "dd", total)
        met = cut(ends.filter("la <> lb").select(F.col("la").alias("src"), F.col("lb").alias("dst")).distinct(), "collisions")
        n = met.count()
        if n <= small_graph:
            if n:
                maps.append(cut(met.filter("src < dst").coalesce(1).mapInArrow(_union_find, "node string, label string"), "merged"))
            break
        graph = met
    out = maps[0]
    for later in maps[1:]:
        out = out.join(later.select(F.col("node").alias("label"), F.col("label").alias("next")), "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    return out.select("node", F.col("label").alias("component"))


def pairs_within(members: DataFrame, node: str, component: str, hot: int = HOT) -> DataFrame:
    """(node_a, node_b), a < b, of ``members`` (unique in ``node``) of one component.

    As many rows as there are such pairs; ``classes`` says the same in one row a node.  Components of ``hot`` members or more, and no less than one
    in HOT_ONE_IN of all, are dealt over a grid of tasks.
    """
    sizes = members.groupBy(component).agg(F.count(F.lit(1)).alias("n"))
    large = sizes.filter(F.col("n") >= max(hot, members.count() // HOT_ONE_IN)).select(component)
    a, b = members.select(F.col(node).alias(f"{node}_a"), component), members.select(F.col(node).alias(f"{node}_b"), component)
    return grid_join(a, b, component, large, f"{node}_a", f"{node}_b").filter(F.col(f"{node}_a") < F.col(f"{node}_b")).select(f"{node}_a", f"{node}_b")


def classes(members: DataFrame, node: str, component: str) -> DataFrame:
    """(node, class_id, n_links): the least node of its component, and how many others that has."""
    sizes = cut(members.groupBy(component).agg(F.count(F.lit(1)).alias("n"), F.min(node).alias("class_id")), "sizes")
    out = hot_cold_join(members, sizes, component, "n", members.count())
    return out.select(node, "class_id", (F.col("n") - 1).alias("n_links"))


def deal(weights: DataFrame, proportions: dict[str, float], seed: int = 0, buckets: int = 4096) -> DataFrame:
    """(component, split) for ``weights(component, n)``: whole components, as near to ``proportions`` as they allow.

    A component larger than a quarter of the smallest wanted share (there are few by arithmetic) goes, largest first,
    to the split that lacks most; the rest follow in the order of their hash, each split taking the stretch of the
    running sum that is still its due.  The running sum is made from ``buckets`` sums of hash ranges and a window
    inside each range, so no task sees all components.  Splits of proportion 0 get nothing.
    """
    wanted = {k: v for k, v in proportions.items() if v > 0}
    whole = sum(wanted.values())
    total = weights.agg(F.sum("n")).first()[0] or 0
    due = {k: v / whole * total for k, v in wanted.items()}
    bar = min(wanted.values()) / whole * total / 4
    heavy = sorted(((r.n, r.component) for r in weights.filter(F.col("n") > bar).select("component", "n").collect()), reverse=True)
    placed: list[tuple[str, str]] = []
    for n, c in heavy:
        k = max(due, key=lambda k: due[k])
        due[k] -= n
        placed.append((c, k))
    light = weights.filter(F.col("n") <= bar).withColumn("h", F.xxhash64(F.lit(seed), "component")).withColumn("bucket", F.shiftrightunsigned("h", 64 - (buckets - 1).bit_length()).cast("int"))
    light = cut(light, "light")
    sums, start = [], 0
    for r in sorted(light.groupBy("bucket").agg(F.sum("n").alias("n")).collect()):
        sums.append((r.bucket, start))
        start += r.n
    spark, left = weights.sparkSession, {k: max(v, 0.0) for k, v in due.items()}
    scale, edge, case = start / (sum(left.values()) or 1), 0.0, F.lit(None).cast("string")
    for k in sorted(left):
        edge += left[k] * scale
        case = F.coalesce(case, F.when(F.col("mid") <= edge, k))
    case = F.coalesce(case, F.lit(max(left, key=lambda k: left[k])))
    from pyspark.sql import Window

    inside = F.sum("n").over(Window.partitionBy("bucket").orderBy("h", "component").rowsBetween(Window.unboundedPreceding, 0))
    base = F.broadcast(spark.createDataFrame(sums or [(0, 0)], "bucket int, base bigint"))
    dealt = light.join(base, "bucket").select("component", (F.col("base") + inside - F.col("n") / 2).alias("mid")).select("component", case.alias("split"))
    return dealt.unionByName(spark.createDataFrame(placed, "component string, split string"))


def related_splits(rows: DataFrame, row_id: str, links: dict[str, Column], proportions: dict[str, float], seed: int = 0, **how: int) -> DataFrame:
    """(row_id, component, split) for every row: rows that share any link, also through others, share their split.

    ``links`` gives the kinds of link as string columns; null relates nothing, and a row without links stands alone.
    Repeated rows are rows of their own with one component.  An empty table gives no rows.
    """
    tagged = [F.concat(F.lit(f"{i}\x1f"), c) for i, c in enumerate(links.values())]
    base = cut(rows.select(F.col(row_id).alias("rid"), F.filter(F.array(*tagged), lambda x: x.isNotNull()).alias("nodes")), "rows")
    parts = components(link_edges(base), **how)
    lone = F.concat(F.lit("row\x1f"), F.coalesce(F.col("rid").cast("string"), F.lit("")))
    first = F.coalesce(F.get("nodes", F.lit(0)), lone).alias("node")
    weight = base.groupBy(first).agg(F.count(F.lit(1)).alias("n"))
    known = cut(weight.join(parts, "node", "left").select("node", "n", F.coalesce("component", "node").alias("component")), "weights")
    dealt = deal(known.groupBy("component").agg(F.sum("n").alias("n")), proportions, seed)
    place = known.join(dealt, "component").select("node", "n", "component", "split")
    total = known.agg(F.sum("n")).first()[0] or 0
    out = hot_cold_join(base.select("rid", first), cut(place, "places"), "node", "n", total)
    return out.select(F.col("rid").alias(row_id), "component", "split")


def link_edges(base: DataFrame) -> DataFrame:
    """Distinct (a, b) of rows with an array ``nodes``: the first node with every other, a lone node with itself."""
    one, more = F.get("nodes", F.lit(0)), F.expr("slice(nodes, 2, size(nodes))")
    return base.filter(F.size("nodes") > 0).select(one.alias("a"), F.explode(F.when(F.size("nodes") > 1, more).otherwise(F.array(one))).alias("b")).distinct()
