"""Connected components by joins, for graphs that no machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martweave.session import remove, work_folder


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) of every node of ``edges`` (a, b: longs).

    Alternates large-star and small-star steps: each node's larger neighbours, then its
    smaller ones and itself, are hung on the least node of its neighbourhood. A step is
    a partial minimum and a join back on the node, so that a hub meets the shuffle once
    from each task and the adaptive planner may split its rows. Edges become stars after
    about the logarithm of the longest path of steps. Every step is a written table in
    the shared folder, so lineage stays short and a lost executor costs one step; a step
    goes when the next one is written.
    """
    spark = edges.sparkSession
    folders: list[str] = []

    def kept(df: DataFrame) -> DataFrame:
        folders.append(work_folder(spark, "components"))
        df.write.parquet(folders[-1])
        return spark.read.parquet(folders[-1])

    now = kept(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = None
    while True:
        # Large star: (a, b) with a > b, both ways.
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = kept(large.where("a != b").distinct())
        # Small star: (a, b) with a > b, from the larger end.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = kept(small.union(least.select("a", F.col("m").alias("b"))).distinct())
        for folder in folders[:-1]:
            remove(spark, folder)
        del folders[:-1]
        sums = now.agg(F.count("a"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 30)))).first()
        if sums == state:
            break
        state = sums
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
