"""Groups of several blocks whose members left are few: their links are found."""

from pyspark.sql import functions as F

from loanlens.llm import blocks
from loanlens.llm.star_components import components


def test_a_large_group_that_shrinks_to_one_block_keeps_its_links(spark, monkeypatch):
    monkeypatch.setattr(blocks, "ROWS", 8)
    sets = spark.range(64).select("id", F.col("id").alias("node"), F.lit(1).alias("n"), F.lit(0).alias("light"))
    members = sets.select(F.lit(7).cast("long").alias("key"), "node")
    comp = spark.createDataFrame([], "node long, component long")
    slots = {r["node"]: r["x"] for r in blocks.own(members.join(sets.withColumn("comp", F.col("id")), "node")).collect()}
    one = 0
    other = next(i for i in range(64) if slots[i] != slots[one])  # in another block

    def links(placed):
        a, b = placed.alias("a"), placed.alias("b")
        same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in blocks.PLACE]
        return a.join(b, [*same, F.col("a.id") < F.col("b.id")]).select(F.col("a.id").alias("u"), F.col("b.id").alias("v"))

    def alive(placed):  # those that meet a partner in a block
        both = placed.where(F.col("id").isin(one, other))
        met = both.groupBy(*blocks.PLACE).agg(F.countDistinct("id").alias("c")).where("c = 2")
        return both.join(met, blocks.PLACE, "left_semi").select("key", "node")

    got = blocks.completed(members, sets, comp, components, alive, links, ["light"], ["light"])
    assert {(r["node"], r["component"]) for r in got.collect()} >= {(other, one)}
