"""Code graphs, vectors and ranked paths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.operators import search
from quarryline.session import stored

# What the ends and kinds of edges are called.
SOURCE_KEYS, TARGET_KEYS = ["source", "src", "from", "caller", "u"], ["target", "dst", "to", "callee", "v"]
KIND_KEYS = ["type", "kind", "relation", "label", "edge_type", "rel"]


def normal_edges(edges: DataFrame, key: str) -> DataFrame:
    """(key, source, target, type) of edges (key, edge: map of texts) under any of the known names; one edge for each pair of ends."""
    first = lambda keys: F.coalesce(*(F.try_element_at("edge", F.lit(k)) for k in keys))
    edges = edges.select(key, F.inline(F.array(F.struct("edge"))))  # a map that is made on the way is made once, not for each name
    rows = edges.select(key, first(SOURCE_KEYS).alias("source"), first(TARGET_KEYS).alias("target"), F.coalesce(first(KIND_KEYS), F.lit("edge")).alias("type"))
    rows = rows.where("source is not null and target is not null").repartition(key, "target")  # a sort of one exchange's rows, which counts by target need too
    return rows.groupBy(key, "source", "target").agg(F.max("type").alias("type"))


def node_tail(node: Column) -> Column:
    """The part of a node's id behind the last separator."""
    return F.element_at(F.split(node, "[.:/#]"), -1)


def node_label(node: Column) -> Column:
    """The last two parts of a node's id; the id where it has one part."""
    parts = F.filter(F.split(node, "[.:/#]"), lambda p: p != "")
    return F.when(F.size(parts) > 1, F.array_join(F.slice(parts, F.size(parts) - 1, 2), ".")).otherwise(node)


def symbol_nodes(nodes: DataFrame, symbols: DataFrame) -> DataFrame:
    """Nodes (id, name) whose tail or name is one of the symbols (symbol)."""
    names = nodes.select("id", "name", F.explode(F.array_distinct(F.array(node_tail(F.col("id")), F.col("name")))).alias("symbol"))
    return names.join(symbols.select("symbol").distinct(), "symbol", "left_semi").select("id", "name").distinct()


def resolved(names: DataFrame, nodes: DataFrame) -> DataFrame:
    """(name, id, tier): for each name (name) the node (id) that it means; the smallest id of equal tiers.

    0: the name is the id; 1: it is what follows a dot, slash or hash in it; 2: it is the id in another case; 3: it is a part of it.
    Three tiers are joins on equality; parts are found by postings of their letters (see search.containing). Empty names mean nothing.
    """
    asked, ids = names.where("name <> ''").select("name").distinct(), nodes.select("id").distinct()
    ends = ids.select("id", F.explode(F.array_distinct(tails(F.col("id")))).alias("name"))
    low = asked.select("name", F.lower("name").alias("low")).join(ids.select("id", F.lower("id").alias("low")), "low")
    tiers = [
        asked.join(ids.select("id", F.col("id").alias("name")), "name").select("name", "id", F.lit(0).alias("tier")),
        asked.join(ends, "name").select("name", "id", F.lit(1).alias("tier")),
        low.select("name", "id", F.lit(2).alias("tier")),
        search.containing(ids, "id", "id", asked.select(F.col("name").alias("needle"))).select(F.col("needle").alias("name"), F.col("key").alias("id"), F.lit(3).alias("tier")),
    ]
    best = reduce(DataFrame.unionByName, tiers).groupBy("name").agg(F.min(F.struct("tier", "id")).alias("x"))
    return best.select("name", "x.id", F.col("x.tier").cast("long").alias("tier"))


def tails(node: Column) -> Column:
    """What follows each dot, slash or hash in a node's id."""
    at = F.filter(F.sequence(F.lit(1), F.length(node)), lambda k: F.substr(node, k, F.lit(1)).isin(".", "/", "#"))
    return F.transform(at, lambda k: F.substr(node, k + 1))


def neighbours(edges: DataFrame, node: str, kind: str | None = None, most: int = 50) -> DataFrame:
    """(direction, node, type): at most so many neighbours of a node, of one kind of edge if given, in order of direction and name."""
    own = edges.where(F.col("type") == kind) if kind else edges
    out = own.where(F.col("source") == node).select(F.lit("out").alias("direction"), F.col("target").alias("node"), "type")
    into = own.where(F.col("target") == node).select(F.lit("in").alias("direction"), F.col("source").alias("node"), "type")
    return out.unionByName(into).orderBy("direction", "node", "type").limit(most)


def suffixes(path: Column) -> Column:
    """A path and its ends at each slash."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "/"))


def gold_rank(ranked: DataFrame, gold: DataFrame) -> DataFrame:
    """(task, rank): the first place of ranked (task, path, k) that a gold path (task, path) equals, ends with or is the end of.

    Paths are met by their ends, so there is no comparison of all with all. Tasks without a hit are left out.
    """
    ends = ranked.select("task", "k", F.explode(suffixes(F.col("path"))).alias("path")).join(gold.select("task", "path"), ["task", "path"]).select("task", "k")
    longer = gold.select("task", F.explode(suffixes(F.col("path"))).alias("path")).join(ranked, ["task", "path"]).select("task", "k")
    return ends.unionByName(longer).groupBy("task").agg(F.min("k").alias("rank"))


def hits(ranks: DataFrame, group: str, ks: tuple[int, ...] = (1, 5, 10)) -> DataFrame:
    """Rows of group, and the total under null: share of ranks up to each k, and mean reciprocal rank over all tasks; no rank is a miss."""
    columns = [F.avg(F.when(F.col("rank") <= k, 1.0).otherwise(0.0)).alias(f"hit{k}") for k in ks]
    return ranks.rollup(group).agg(F.count("*").alias("tasks"), *columns, (F.coalesce(F.sum(1 / F.col("rank")), F.lit(0.0)) / F.count("*")).alias("mrr"))


def artifact_matches(tasks: DataFrame, files: DataFrame) -> DataFrame:
    """(instance_id, path): the file of each task by its first key that a path contains: id, commit in 12 and 7 letters, repository.

    Keys have four letters at least; of several paths the shortest counts, then the smallest. Paths are found by postings of the
    keys' letters (see search.containing), each key once however many tasks have it.
    """
    keys = F.array(F.col("instance_id"), F.substr("base_commit", F.lit(1), F.lit(12)), F.substr("base_commit", F.lit(1), F.lit(7)), F.replace("repo", F.lit("/"), F.lit("__")), F.element_at(F.split("repo", "/"), -1))
    asked = tasks.select("instance_id", F.posexplode(keys).alias("place", "needle")).where(F.length("needle") >= 4)
    found = search.containing(files.select("path").distinct(), "path", "path", asked.select("needle"))
    shortest = found.groupBy("needle").agg(F.min(F.struct(F.length("key").alias("n"), F.col("key").alias("path"))).alias("x"))
    best = asked.join(shortest, "needle").groupBy("instance_id").agg(F.min_by("x", "place").alias("x"))
    return best.select("instance_id", "x.path")


def presence(texts: DataFrame, corpus: str, text: str, words: list[str]) -> DataFrame:
    """(corpus, word, found): whether a corpus has each word as a word; one pass over the texts."""
    sums = texts.groupBy(corpus).agg(*(F.bool_or(F.regexp_like(text, F.lit(rf"\b\Q{w}\E\b"))).alias(f"_{k}") for k, w in enumerate(words)))
    pairs = F.array(*(F.struct(F.lit(w).alias("word"), F.coalesce(f"_{k}", F.lit(False)).alias("found")) for k, w in enumerate(words)))
    return sums.select(corpus, F.explode(pairs).alias("p")).select(corpus, "p.*")


def norms(vectors: DataFrame, column: str) -> Column:
    return F.sqrt(F.aggregate(F.col(column), F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def norm_histogram(vectors: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """(bin, n): vectors by their norms, bin 0 below low and bins + 1 from high on."""
    return vectors.groupBy(F.width_bucket(norms(vectors, column), F.lit(low), F.lit(high), F.lit(bins)).alias("bin")).agg(F.count("*").alias("n"))


def principal_components(vectors: DataFrame, key: str, column: str, k: int = 2) -> DataFrame:
    """(key, components): vectors along the k directions of largest variance; the covariance is summed over partitions."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = vectors.select(key, array_to_vector(F.transform(column, lambda x: x.cast("double"))).alias("x"))
    model = PCA(k=k, inputCol="x", outputCol="y").fit(rows)
    return model.transform(rows).select(key, vector_to_array("y").alias("components"))


def numbered(df: DataFrame, order: str, name: str) -> DataFrame:
    """df with each row's place in order, from 0 on, as a column name; rows of equal order stand in any order, but always in the same.

    The ranges are stored once with each row's place in its range, so that counting and reading see the same ranges; the rows
    before a range are the sum of those counts. No task orders all rows, and equal values are spread by a hash of the row.
    """
    names = [f"_{k}" for k in range(3)]
    spread = F.xxhash64(*(F.col(f"`{c}`") if not kind.startswith(("map", "variant")) else F.lit(0) for c, kind in df.dtypes))
    ranged = df.withColumn(names[0], spread).repartitionByRange(order, names[0]).sortWithinPartitions(order, names[0])
    placed = stored(ranged.withColumns({names[1]: F.spark_partition_id(), names[2]: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "numbered")
    sizes = placed.groupBy(names[1]).agg(F.count("*").alias("n"))
    before = sizes.select(names[1], (F.sum("n").over(Window.orderBy(names[1])) - F.col("n")).alias("before"))  # one row a range
    return placed.join(F.broadcast(before), names[1]).select(*(f"`{c}`" for c in df.columns), (F.col("before") + F.col(names[2])).alias(name))


def sharded(df: DataFrame, order: str, shard: int, shards: int) -> DataFrame:
    """Every shards-th row in order, from row shard on (see numbered)."""
    rows = numbered(df, order, "_place")
    return rows.where(F.pmod(F.col("_place"), F.lit(shards)) == shard).drop("_place")


def positional(left: DataFrame, right: DataFrame, left_order: str, right_order: str) -> DataFrame:
    """Rows of both at the same place in order, until the shorter ends. Their columns have different names."""
    return numbered(left, left_order, "_place").join(numbered(right, right_order, "_place"), "_place").drop("_place")


def ego_graphs(edges: DataFrame, centers: DataFrame, least: int = 8, most: int = 40) -> DataFrame:
    """(center, node, degree, place): the neighbourhood of each center (node) in edges (source, target), whatever their direction.

    One step from the center, or two where one leads to fewer than least nodes with it; of these the center and then those of
    the highest degree, up to most. A neighbour can only bring in the most nodes of highest degree next to it, so its list is
    cut to those before it is joined; all neighbours of a wide center count, also those that are themselves left out. The best
    of each list give a place among all nodes that a wide center's last one has at least; what stands behind it is never listed.
    """
    pairs = edges.select(F.col("source").alias("a"), F.col("target").alias("b")).where("a <> b")
    pairs = stored(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "pairs")
    degrees = stored(pairs.groupBy("a").agg(F.count("*").alias("degree")), "degrees")
    asked = centers.select(F.col("node").alias("center")).distinct().join(degrees.withColumnRenamed("a", "center"), "center", "left")
    asked = stored(asked.select("center", F.coalesce("degree", F.lit(0)).alias("degree")), "asked")
    wide = asked.where(F.col("degree") + 1 < least).select("center")
    steps = stored(wide.join(pairs, wide["center"] == pairs["a"]).select("center", F.col("b").alias("a")), "steps")
    ends = asked.select(F.col("center").alias("a")).unionByName(steps.select("a")).distinct()
    # the most neighbours of highest degree of each node that is asked; -degree, node is the order of places
    near = pairs.join(ends, "a", "left_semi").join(degrees.select(F.col("a").alias("b"), "degree"), "b")
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("degree"), "b"))
    best = near.withColumn("place", place).where(F.col("place") <= most).select("a", F.struct((-F.col("degree")).alias("low"), F.col("b").alias("node")).alias("x"))
    lists = stored(best.groupBy("a").agg(F.sort_array(F.collect_list("x")).alias("list")), "lists")  # at most that many each
    own = asked.join(lists, asked["center"] == lists["a"]).select("center", "list")
    heads = steps.join(lists.select("a", F.slice("list", 1, 2).alias("heads")), "a").select("center", F.explode("heads").alias("x"))
    heads = heads.where("x.node <> center").distinct()
    last = F.row_number().over(Window.partitionBy("center").orderBy("x"))
    reach = heads.withColumn("place", last).where(F.col("place") == most).select("center", F.col("x").alias("reach"))
    asking = steps.join(reach, "center", "left")
    two = asking.join(lists, "a").select("center", F.explode(F.filter("list", lambda x: F.col("reach").isNull() | (x <= F.col("reach")))).alias("x"))
    every = own.select("center", F.explode("list").alias("x")).unionByName(two).where("x.node <> center").distinct()
    every = every.select("center", F.col("x.node").alias("node"), (-F.col("x.low")).alias("degree")).unionByName(asked.select("center", F.col("center").alias("node"), "degree"))
    place = F.row_number().over(Window.partitionBy("center").orderBy(F.col("node") != F.col("center"), F.desc("degree"), "node"))
    return every.withColumn("place", place.cast("long")).where(F.col("place") <= most)
