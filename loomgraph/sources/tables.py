"""A graph from star-schema tables: parts are concepts, orders sources, lines items, neighbouring lines chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomgraph.model import Graph


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def item_id() -> Column:
    """Lines have no key; these six columns together are one."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents, F.date_format("l_shipdate", "yyyyMMdd"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_returnflag", "l_linestatus", "l_quantity")
    return rows.select(item_id().alias("item_id"), F.col("l_orderkey").cast("string").alias("ref"), F.col("l_partkey").cast("string").alias("concept"), "*")


def chains(rows: DataFrame) -> DataFrame:
    """From each line's part to the next one's within the order.  The window's key is the order: no large group."""
    within = W.partitionBy("ref").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    out = rows.select("item_id", F.col("concept").alias("source"), F.lead("concept").over(within).alias("target"), F.col("l_returnflag").alias("type"))
    return out.where("target is not null").select("item_id", "source", "target", "type", F.lit(None).cast("string").alias("description"), F.col("item_id").alias("ord"))


def graph(spark: SparkSession, sf_dir: str) -> Graph:
    part = read(spark, sf_dir, "part")
    rows = lines(spark, sf_dir)
    name = F.col("p_partkey").cast("string")
    no_text, no_props = F.lit(None).cast("string"), F.create_map().cast("map<string,string>")
    value = lambda f, v, o: part.select(name.alias("concept"), F.lit(f).alias("field"), v.alias("value"), F.lit(o).alias("ord"))
    orders = read(spark, sf_dir, "orders")
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    up = nation.join(region, nation.n_regionkey == region.r_regionkey).select(F.col("n_name").alias("child"), F.col("r_name").alias("parent"), F.lit("PART_OF").alias("type"))
    inside = read(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_name").alias("child"), F.col("n_name").alias("parent"), F.lit("INSTANCE_OF").alias("type"))
    return Graph(
        concepts=part.select(name.alias("name"), F.col("p_name").alias("search_name"), no_text.alias("description"), F.lit(None).cast("array<string>").alias("aliases"), no_props.alias("props")),
        values=value("topic", F.col("p_brand"), 0).unionByName(value("aspect", F.col("p_type"), 0)).unionByName(value("dimension", F.concat(F.lit("size "), F.col("p_size").cast("string")), 0)),
        sources=orders.select(F.col("o_orderkey").cast("string").alias("bibtex"), F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"), F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("author"), F.year("o_orderdate").cast("string").alias("year"), F.col("o_orderpriority").alias("journal")),
        items=rows.select("item_id", F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("citation"), no_text.alias("description"), F.concat(F.lit("orders/"), F.col("ref")).alias("source_file"), F.col("l_linenumber").alias("source_line"), F.concat_ws("_", "l_orderkey", "l_linenumber").alias("annotation_id")),
        from_source=rows.select("item_id", "ref"),
        mentions=rows.select("item_id", "concept", F.lit(1).alias("mention_order")),
        located=rows.select("concept", "item_id", "ref"),
        chains=chains(rows),
        hierarchy=up.unionByName(inside),
        graph_fields=["topic", "aspect", "dimension"],
        field_specs={"topic": {"type": "TOPIC", "scope": "ONTOLOGY"}},
        context={"project": "orders"},
    )
