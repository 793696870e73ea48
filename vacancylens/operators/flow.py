"""Weighted edges between the frequent values of two columns."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vacancylens.operators.bounded import broadcast_bounded


def flow_edges(
    df: DataFrame, source: str, target: str, top_sources: int, top_targets: int, min_count: int
) -> DataFrame:
    """``(source, target, n)`` for pairs of frequent values seen ``min_count`` times.

    Each column's frequent values are ranked over the whole table.
    """
    rows = df.select(F.col(source).alias("source"), F.col(target).alias("target"), F.lit(1).alias("n"))
    return edges_of_pairs(rows, top_sources, top_targets, min_count)


def edges_of_pairs(pairs: DataFrame, top_sources: int, top_targets: int, min_count: int) -> DataFrame:
    """The same from counted pairs ``(source, target, n)``; a pair may have several rows.

    Pairs and the totals of either side are one aggregation over sets of keys, so
    the input is read once and the counts meet nothing but themselves: ranks are
    given among the totals and handed to the pairs of their value by windows.
    """
    source, target, nothing = F.col("source"), F.col("target"), F.lit(None).cast("string")
    kinds = [(source, target), (source, nothing), (nothing, target)]
    sets = [F.struct(F.lit(k).alias("side"), s.alias("source"), t.alias("target"), F.col("n")) for k, (s, t) in enumerate(kinds)]
    counted = pairs.select(F.inline(F.array(*sets))).groupBy("side", "source", "target").agg(F.sum("n").alias("n"))
    pair, of_source, of_target = (F.col("side") == k for k in (0, 1, 2))
    both = F.col("source").isNotNull() & F.col("target").isNotNull()
    known = counted.where(
        (pair & both & (F.col("n") >= min_count)) | (of_source & F.col("source").isNotNull()) | (of_target & F.col("target").isNotNull())
    )
    # Every pair is first among itself, so one limit before the shuffle serves all.
    group = Window.partitionBy("side", F.when(pair, F.col("source")), F.when(pair, F.col("target")))
    rank = F.row_number().over(group.orderBy(F.desc("n"), F.coalesce("source", "target")))
    ranked = known.withColumn("rank", rank).where(F.col("rank") <= max(top_sources, top_targets, 1))
    top = ranked.where(pair | (of_source & (F.col("rank") <= top_sources)) | (of_target & (F.col("rank") <= top_targets)))
    marked = top.withColumn("top_source", F.max(of_source).over(Window.partitionBy("source"))).where(pair & F.col("top_source") | of_target)
    marked = marked.withColumn("top_target", F.max(of_target).over(Window.partitionBy("target")))
    return marked.where(pair & F.col("top_target")).select("source", "target", "n")


def flow_nodes(edges: DataFrame) -> DataFrame:
    """``(node_id, label)``: labels of both ends, numbered from 0 in sorted order.

    The numbering needs one global order. It runs over the distinct labels of
    an edge table already cut to the frequent values of either side.
    """
    labels = edges.select(F.explode(F.array("source", "target")).alias("label")).distinct()
    return labels.select((F.dense_rank().over(Window.orderBy("label")) - 1).alias("node_id"), "label")


def numbered_edges(edges: DataFrame) -> DataFrame:
    """Edges with ``source_id`` and ``target_id`` as :func:`flow_nodes` numbers them, in one pass.

    Like there, the one global order is over edges between frequent values.
    """
    edge = F.struct("source", "target", "n")
    source, target = (F.struct(F.col(c).alias("label"), F.lit(k).alias("end")) for k, c in enumerate(("source", "target")))
    ends = edges.select(edge.alias("edge"), F.inline(F.array(source, target)))
    numbered = ends.withColumn("node_id", F.dense_rank().over(Window.orderBy("label")) - 1)
    ids = [F.max(F.when(F.col("end") == k, F.col("node_id"))).alias(name) for k, name in enumerate(("source_id", "target_id"))]
    return numbered.groupBy("edge").agg(*ids).select("edge.*", "source_id", "target_id")


def encode_edges(edges: DataFrame, nodes: DataFrame, max_nodes: int | None = None) -> DataFrame:
    """Add ``source_id`` and ``target_id`` from a table of nodes; a label has one id on both sides."""
    sources = nodes.select(F.col("node_id").alias("source_id"), F.col("label").alias("_source"))
    targets = nodes.select(F.col("node_id").alias("target_id"), F.col("label").alias("_target"))
    return (
        edges.join(broadcast_bounded(sources, max_nodes), F.col("source").eqNullSafe(F.col("_source")))
        .join(broadcast_bounded(targets, max_nodes), F.col("target").eqNullSafe(F.col("_target")))
        .drop("_source", "_target")
    )
