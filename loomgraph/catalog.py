"""Queries over the star-schema tables, one or more for each operator, and their SQL equivalents."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.catalog_sql import SQL
from loomgraph.functions import text
from loomgraph.model import Graph
from loomgraph.operators import algorithms, embeddings, estimates, fulltext, linkage, metrics, projection, search, taxonomy, view
from loomgraph.plans import catalogue, context
from loomgraph.sources import project_json, sinks, tables
from loomgraph.streaming import windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PART, ORDER, BRAND = "7", "7", "Brand#23"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def on_graph(f: Callable[[Graph], DataFrame]) -> Callable[[Graph], DataFrame]:
    QUERIES[f.__name__] = lambda spark, sf_dir: f(tables.graph(spark, sf_dir))
    return f


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return f2_mention_counts(tables.graph(spark, sf_dir))


# scans, builders and sinks -------------------------------------------------------------------------------------------


@on_graph
def a14_counts(g: Graph) -> DataFrame:
    return metrics.counting_units(g)


@on_graph
def b5_from_source(g: Graph) -> DataFrame:
    """Edges whose both ends exist, each once."""
    edges = g.from_source.join(g.items.select("item_id"), "item_id").join(g.sources.select(F.col("bibtex").alias("ref")), "ref").dropDuplicates(["item_id", "ref"])
    return edges.groupBy("ref").agg(F.count(F.lit(1)).alias("items"))


@on_graph
def b6_relates_to(g: Graph) -> DataFrame:
    return g.relates_to().select("source", "target", "type", "item_id")


@on_graph
def b6_vertices(g: Graph) -> DataFrame:
    return g.vertices()


@on_graph
def b7_taxonomy_edges(g: Graph) -> DataFrame:
    return g.values.select("field", "concept", "value").distinct()


@query
def b8_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions by (item, order, concept); suppliers as criteria are no vertices, so theirs vanish."""
    g = tables.graph(spark, sf_dir)
    criteria = tables.lines(spark, sf_dir).select("item_id", F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("concept"), F.lit(0).alias("mention_order"))
    rows = g.mentions.unionByName(criteria).join(g.vertices().withColumnRenamed("name", "concept"), "concept").dropDuplicates(["item_id", "mention_order", "concept"])
    return rows.groupBy("concept", "mention_order").agg(F.count(F.lit(1)).alias("mentions"))


@on_graph
def b9_hierarchy(g: Graph) -> DataFrame:
    return g.hierarchy.distinct()


@query
def b3_upsert_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of open orders replace whole rows, others stay."""
    from loomgraph.sources.sinks import upserted

    old = tables.graph(spark, sf_dir).sources.select("bibtex", "title", "year")
    new = tables.read(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").cast("string").alias("bibtex"), F.lit("open").alias("title"))
    return upserted(old, new, ["bibtex"])


@query
def c4_description_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A description that repeats a property is none."""
    part = tables.read(spark, sf_dir, "part")
    props = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("kind"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise(F.lit("other")))
    return part.select("p_partkey", project_json.own_description(F.col("p_type"), props).alias("description"))


@query
def c11_item_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.read(spark, sf_dir, "conversations")
    block = rows.where("role = 'user'").groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    hops = block.select(F.concat(F.lit("conv"), F.col("conv_id").cast("string")).alias("id"), F.posexplode("turns").alias("i", "turn"))
    return hops.select(project_json.item_id("n").alias("item_id"), "turn")


@query
def c12_relation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, sf_dir, "orders").select(text.relation_type(F.col("o_orderpriority")).alias("type")).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


@query
def c14_relative_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = tables.read(spark, sf_dir, "pages")
    return pages.select("page_id", text.relative_path(F.col("url"), "https:/").alias("path"))


# filters, joins ------------------------------------------------------------------------------------------------------


@on_graph
def d1_filtered_concepts(g: Graph) -> DataFrame:
    return view.kept(g, view.Scope(min_frequency=30, min_source_count=30))


@on_graph
def d2_connected_concepts(g: Graph) -> DataFrame:
    return view.kept(g, view.Scope(include_isolated=False))


@on_graph
def d3_kept_chains(g: Graph) -> DataFrame:
    names = view.kept(g, view.Scope(min_frequency=32))
    return view.kept_chains(g, names).select("item_id", "source", "target", "type")


@on_graph
def d4_without_loops(g: Graph) -> DataFrame:
    return g.chains.where("source <> target").groupBy("type").agg(F.count(F.lit(1)).alias("n"))


@query
def d6_valid_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = tables.read(spark, sf_dir, "events").select("event_type").unionByName(tables.read(spark, sf_dir, "part").select(F.col("p_brand").alias("event_type"))).distinct()
    return names.select(F.col("event_type").alias("label"), text.valid_label(F.col("event_type")).alias("valid"))


@query
def d8_constant_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = tables.read(spark, sf_dir, "part").withColumn("same", F.lit(" one  value "))
    return search.constant_fields(part, ["p_brand", "p_type", "same"])


@on_graph
def d11_label_search(g: Graph) -> DataFrame:
    return view.find(g.concepts.select(F.col("search_name").alias("name")).distinct(), "RE")


@on_graph
def d10_visible_nodes(g: Graph) -> DataFrame:
    s = view.Scope(min_frequency=30)
    return view.visible(view.nodes(g, s), projection.neighbours(g.chains), 40, [0, 2]).select("name", "cid", "filtered")


@on_graph
def e2_located_mentions(g: Graph) -> DataFrame:
    return metrics.located_mentions(g).groupBy("ref").agg(F.countDistinct("concept").alias("concepts"))


@on_graph
def e6_co_taxonomy(g: Graph) -> DataFrame:
    return projection.co_taxonomy(g)


@on_graph
def e7_co_citation(g: Graph) -> DataFrame:
    return projection.co_citation(g)


@query
def e9_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that share a name stand for the one with the smallest key."""
    g, named = tables.graph(spark, sf_dir), tables.read(spark, sf_dir, "part")
    low = named.groupBy("p_name").agg(F.min("p_partkey").alias("low"))
    aliases = named.join(low, "p_name").where("p_partkey <> low").select(F.col("p_partkey").cast("string").alias("alias"), F.col("low").cast("string").alias("target"))
    chains, _ = linkage.resolve_aliases(g.chains, g.mentions, aliases)
    return chains.groupBy("source", "target").agg(F.count(F.lit(1)).alias("n"))


@query
def e10_merged_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tables.read(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string").alias("bibref")
    first = orders.where("o_orderkey % 3 <> 0").select(key, F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).otherwise("").alias("title"))
    second = orders.where("o_orderkey % 5 <> 0").select(key, F.col("o_orderstatus").alias("title"), F.col("o_custkey").cast("string").alias("author"))
    return linkage.merge_origins(first, second, "bibref")


@query
def e11_tolerant_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = tables.read(spark, sf_dir, "customer")
    shape = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("@"), F.upper("c_name"))).otherwise(F.concat(F.lit("@"), F.lower("c_name")))
    refs = customer.select("c_custkey", shape.alias("ref"))
    table = customer.select(F.lower("c_name").alias("key"), "c_mktsegment")
    return linkage.tolerant_lookup(refs, "ref", table, "key", "c_mktsegment")


def _linked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    customer, orders = tables.read(spark, sf_dir, "customer"), tables.read(spark, sf_dir, "orders")
    owners = customer.where("c_mktsegment = 'BUILDING'").select(F.lit("customer").alias("entity"), F.col("c_custkey").cast("string").alias("value"), F.lit("crm").alias("member"), F.col("c_name").alias("source"), F.col("c_custkey").alias("ord"))
    referrers = orders.select(F.lit("customer").alias("entity"), F.col("o_custkey").cast("string").alias("value"), F.lit("shop").alias("member"), F.col("o_orderkey").cast("string").alias("source"))
    return linkage.resolve(owners, referrers)


@query
def e12_identity_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _linked(spark, sf_dir)[1]


@query
def e13_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _linked(spark, sf_dir)[2]


@query
def e14_index_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = F.create_map(F.lit(0), F.lit("zero"), F.lit(2), F.lit("two"), F.lit(11), F.lit("eleven"))
    return tables.read(spark, sf_dir, "part").select("p_partkey", text.index_label((F.col("p_size") % 13).cast("int"), labels).alias("label"))


@query
def e18_left_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation, region = (tables.read(spark, sf_dir, n) for n in ("customer", "nation", "region"))
    some = region.where("r_regionkey <> 1")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(some, F.col("n_regionkey") == F.col("r_regionkey"), "left").groupBy("r_name").agg(F.count(F.lit(1)).alias("customers"))


@on_graph
def e19_mapped_aspects(g: Graph) -> DataFrame:
    return taxonomy.mapped(g, "aspect")


@on_graph
def e19_mapped_dimensions(g: Graph) -> DataFrame:
    return taxonomy.mapped(g, "dimension")


@query
def e20_stale_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = tables.read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("name"), "p_name", "p_partkey")
    old = F.when(F.col("p_partkey") % 4 == 0, F.lit("changed")).otherwise(F.col("p_name"))
    stored = part.where("p_partkey % 5 <> 0").select("name", text.text_hash(old).alias("hash"), F.when(F.col("p_partkey") % 7 != 0, F.array(F.lit(1.0))).alias("vector"))
    return search.stale(part.select("name", F.col("p_name").alias("text")), stored)[0].select("name", "hash")


# aggregates ----------------------------------------------------------------------------------------------------------


@on_graph
def f1_degrees(g: Graph) -> DataFrame:
    return metrics.degrees(g)


@on_graph
def f2_mention_counts(g: Graph) -> DataFrame:
    return metrics.mention_counts(g)


@on_graph
def f3_taxonomy_counts(g: Graph) -> DataFrame:
    return metrics.taxonomy_counts(g)


@on_graph
def f4_topic_weights(g: Graph) -> DataFrame:
    return metrics.topic_weights(g)


@on_graph
def f5_aspect_diversity(g: Graph) -> DataFrame:
    return metrics.diversity(g, "aspect")


@on_graph
def f5_dimension_diversity(g: Graph) -> DataFrame:
    return metrics.diversity(g, "dimension")


@on_graph
def f6_source_metrics(g: Graph) -> DataFrame:
    return metrics.source_metrics(g)


@on_graph
def f9_linked_topics(g: Graph) -> DataFrame:
    return taxonomy.linked_topics(g)


@on_graph
def f10_linked_topics_raw(g: Graph) -> DataFrame:
    return taxonomy.linked_topics_raw(g)


@on_graph
def f11_coverage(g: Graph) -> DataFrame:
    return view.coverage(g)


@on_graph
def f13_endpoint_degree(g: Graph) -> DataFrame:
    return view.endpoint_degree(g.chains)


@on_graph
def f14_edges(g: Graph) -> DataFrame:
    return view.edges(g)


@on_graph
def f15_legend(g: Graph) -> DataFrame:
    return view.legend(view.groups(g, view.kept(g, view.Scope())))


@on_graph
def f16_hyperedges(g: Graph) -> DataFrame:
    return view.hyperedges(g, view.kept(g, view.Scope()), 30)


@on_graph
def f18_neighbours(g: Graph) -> DataFrame:
    return projection.neighbours(g.chains)


@on_graph
def f19_grouped_edges(g: Graph) -> DataFrame:
    return view.grouped(g)


# implicit windows, order, sets ---------------------------------------------------------------------------------------


@on_graph
def g2_slugs(g: Graph) -> DataFrame:
    return view.slugs(g.concepts.select(F.concat_ws(" ", "search_name", F.substring("name", -1, 1)).alias("name")).unionByName(g.concepts.select(F.concat_ws("-", "search_name", F.substring("name", -1, 1)).alias("name"))))


@on_graph
def g3_first_sources(g: Graph) -> DataFrame:
    return view.first_sources(g)


@on_graph
def g4_evidence(g: Graph) -> DataFrame:
    return view.evidence(g).select("concept", "item_id", "place", "source", "type", "text")


@on_graph
def h1_top_nodes(g: Graph) -> DataFrame:
    return view.kept(g, view.Scope(max_nodes=50))


@on_graph
def h4_hierarchy_sorted(g: Graph) -> DataFrame:
    return taxonomy.hierarchy(g)


@query
def h8_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(100).limit(50)


@query
def i2_union_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, supplier = tables.read(spark, sf_dir, "customer"), tables.read(spark, sf_dir, "supplier")
    a = customer.select(F.regexp_replace("c_name", "[A-Za-z#]", "").alias("name"), F.lit("customer").alias("kind"))
    b = supplier.select(F.regexp_replace("s_name", "[A-Za-z#]", "").alias("name"), F.lit("supplier").alias("kind"))
    return linkage.union_concepts([b, a])


@on_graph
def i9_evidence_union(g: Graph) -> DataFrame:
    """What is said of either of two concepts."""
    return view.evidence(g).where(F.col("concept").isin("1", "2")).select("source", "type", "text").dropDuplicates()


@on_graph
def i7_lost_to_a_higher_bar(g: Graph) -> DataFrame:
    """Concepts that one threshold keeps and a higher one does not."""
    return view.kept(g, view.Scope(min_frequency=28)).exceptAll(view.kept(g, view.Scope(min_frequency=31)))


@on_graph
def i7_unmentioned(g: Graph) -> DataFrame:
    ends = g.chains.select(F.explode(F.array("source", "target")).alias("name")).distinct()
    return g.concepts.select("name").exceptAll(ends)


@query
def c10_qualified(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tables.read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("ref"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("@"), F.col("o_orderkey").cast("string"))).otherwise(F.col("o_orderkey").cast("string")).alias("bibtex"))
    return linkage.qualified(orders, "bibtex", "left", at=True)


# scalar functions ----------------------------------------------------------------------------------------------------


@query
def j_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = tables.read(spark, sf_dir, "part")
    name = F.concat_ws("_", "p_name", "p_brand")
    return part.select(
        "p_partkey", text.humanized(name).alias("human"), text.label(name).alias("label"), text.database_name(name).alias("database"), text.entity_label(name).alias("entity"),
        text.capitalized(F.upper("p_name")).alias("capital"), text.slug(name).alias("slug"), text.shortened(F.repeat(F.col("p_name"), 8)).alias("short"), text.text_hash(name).alias("hash"),
    )


@query
def j1_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = tables.read(spark, sf_dir, "part").select(F.concat(F.lit("  "), F.upper("p_name"), F.lit("  x ")).alias("name")).distinct()
    return names.select("name", text.identity(F.col("name")).alias("identity"))


@query
def j_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tables.read(spark, sf_dir, "conversations").where("turn is not null")
    item = F.when(F.col("turn") % 3 == 0, F.format_string("b%d_n%04d", "conv_id", "turn")).otherwise(F.format_string("b%d_x%04d", "conv_id", "turn"))
    note = F.concat(F.lit('anchor=" a'), F.col("turn").cast("string"), F.lit(' " analysis="'), F.col("role"), F.lit('"'))
    return c.select("conv_id", "turn", text.block_of(item).alias("block"), text.note_field(note, "anchor").alias("anchor"), text.note_field(note, "analysis").alias("analysis"))


@query
def j16_concept_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = tables.read(spark, sf_dir, "part")
    parts = [text.humanized(F.col("p_name")), F.concat(F.col("p_type"), F.lit("...")), F.when(F.col("p_size") > 25, F.lit("  large   part. ")).otherwise("")]
    return part.select("p_partkey", text.concept_text(parts).alias("text"))


@on_graph
def j14_edge_widths(g: Graph) -> DataFrame:
    return view.edges(g).groupBy("width").agg(F.count(F.lit(1)).alias("n"))


# graph algorithms ----------------------------------------------------------------------------------------------------


@on_graph
def k1_projection(g: Graph) -> DataFrame:
    return projection.projected(g)


@on_graph
def k2_pagerank(g: Graph) -> DataFrame:
    ranks = algorithms.pagerank(projection.relates_to(g), g.vertices())
    return ranks.select("name", F.round("pagerank", 6).alias("pagerank"))


@on_graph
def k3_betweenness(g: Graph) -> DataFrame:
    return algorithms.betweenness(projection.relates_to(g))


@on_graph
def k4_louvain(g: Graph) -> DataFrame:
    """Communities for a graph of any size."""
    return algorithms.louvain(algorithms.shared(projection.relates_to(g)))


@on_graph
def k4_louvain_in_one_task(g: Graph) -> DataFrame:
    """Communities for a graph that fits one task."""
    return algorithms.louvain_in_one_task(algorithms.shared(projection.relates_to(g)))


@on_graph
def k8_closure(g: Graph) -> DataFrame:
    return taxonomy.closure(g.hierarchy)


@query
def k8_subtree_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = tables.graph(spark, sf_dir)
    supplier = tables.read(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("concept"))
    located = tables.lines(spark, sf_dir).select("item_id", F.col("l_suppkey").alias("s_suppkey")).join(supplier, "s_suppkey")
    return taxonomy.subtree_evidence(g.hierarchy, located)


@on_graph
def k9_within_two(g: Graph) -> DataFrame:
    return projection.within_two(g.chains, PART).groupBy("related", "hops").agg(F.count(F.lit(1)).alias("paths"))


# the analyst's questions ---------------------------------------------------------------------------------------------


def _topics(g: Graph) -> DataFrame:
    return g.of_field(g.topic_field).select(F.col("concept").alias("name"), F.col("value").alias("community"))


def _metric_table(g: Graph, communities: Callable[[DataFrame], DataFrame] = algorithms.louvain) -> DataFrame:
    """What the questions are asked of."""
    edges = algorithms.shared(projection.relates_to(g))
    return metrics.mention_counts(g).join(metrics.degrees(g), "name").join(algorithms.pagerank(edges, g.vertices()), "name").join(communities(edges), "name", "left")


@on_graph
def l1_label_counts(g: Graph) -> DataFrame:
    return catalogue.label_counts(g)


@on_graph
def l2_schema(g: Graph) -> DataFrame:
    return catalogue.schema(g)


@on_graph
def l3_top_pagerank(g: Graph) -> DataFrame:
    ranks = algorithms.pagerank(projection.relates_to(g), g.vertices())
    return catalogue.top_pagerank(metrics.mention_counts(g).join(ranks, "name"))


@on_graph
def l4_bridges(g: Graph) -> DataFrame:
    return catalogue.bridges(algorithms.central(algorithms.shared(projection.relates_to(g))))


@on_graph
def l5_communities(g: Graph) -> DataFrame:
    return catalogue.communities(algorithms.louvain(algorithms.shared(projection.relates_to(g))))


@on_graph
def l5_topics(g: Graph) -> DataFrame:
    """The same question with the topic as community, which SQL can follow."""
    return catalogue.communities(_topics(g))


@on_graph
def l6_citations(g: Graph) -> DataFrame:
    return catalogue.citations(g, PART)


@on_graph
def l7_sources_of(g: Graph) -> DataFrame:
    return catalogue.sources_of(g, PART)


@on_graph
def l8_trace(g: Graph) -> DataFrame:
    return catalogue.trace(g, PART)


@on_graph
def l9_direct(g: Graph) -> DataFrame:
    return catalogue.direct(g, PART)


@on_graph
def l10_by_taxonomy(g: Graph) -> DataFrame:
    return catalogue.by_taxonomy(g, PART)


@on_graph
def l11_two_hops(g: Graph) -> DataFrame:
    return projection.within_two(g.chains, PART).orderBy("hops", "via", "related").limit(50)


@on_graph
def l12_topics(g: Graph) -> DataFrame:
    return catalogue.topics(g)


@on_graph
def l13_topic_members(g: Graph) -> DataFrame:
    return catalogue.topic_members(g)


@on_graph
def l14_topic_by_aspect(g: Graph) -> DataFrame:
    return catalogue.topic_by_aspect(g)


@on_graph
def l15_richest(g: Graph) -> DataFrame:
    return catalogue.richest(g)


@on_graph
def l16_concepts_of(g: Graph) -> DataFrame:
    return catalogue.concepts_of(g, ORDER)


@on_graph
def l17_covering(g: Graph) -> DataFrame:
    return catalogue.covering(g, BRAND)


@on_graph
def l18_compare_communities(g: Graph) -> DataFrame:
    return catalogue.compare_communities(_metric_table(g))


@on_graph
def l18_compare_topics(g: Graph) -> DataFrame:
    return catalogue.compare_communities(_metric_table(g, lambda _: _topics(g)))


@on_graph
def l19_widespread(g: Graph) -> DataFrame:
    return catalogue.widespread(metrics.mention_counts(g))


@on_graph
def l20_exclusive(g: Graph) -> DataFrame:
    return catalogue.exclusive(g, metrics.mention_counts(g))


@on_graph
def l21_isolated(g: Graph) -> DataFrame:
    return catalogue.isolated(metrics.degrees(g), metrics.mention_counts(g), below=30)


@on_graph
def l22_triangulated(g: Graph) -> DataFrame:
    return catalogue.triangulated(g)


@on_graph
def l23_saturation(g: Graph) -> DataFrame:
    return catalogue.saturation(g)


@on_graph
def l23_first_appearance(g: Graph) -> DataFrame:
    return catalogue.first_appearance(g)


@on_graph
def l24_central_of_community(g: Graph) -> DataFrame:
    """Of the community that holds PART."""
    m = algorithms.shared(_metric_table(g))
    return catalogue.top_pagerank(m.join(m.where(F.col("name") == PART).select("community"), "community"))


@on_graph
def l24_central_of_topic(g: Graph) -> DataFrame:
    return catalogue.top_pagerank(_metric_table(g, lambda _: _topics(g)).where(F.col("community") == BRAND))


@on_graph
def l26_paths(g: Graph) -> DataFrame:
    return catalogue.paths(g).groupBy("source").agg(F.count(F.lit(1)).alias("paths"))


# search --------------------------------------------------------------------------------------------------------------


@query
def m1_inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = search.inverted_index(tables.read(spark, sf_dir, "documents"), "doc_id", ["text"])
    return index.groupBy("term").agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df"))


@query
def m3_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.bm25(tables.read(spark, sf_dir, "documents"), "doc_id", ["text"], ["license", "token", "mit"], k=20)


@query
def m6_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = tables.read(spark, sf_dir, "embeddings")
    wanted = e.where("vec_id = 7").first().embedding
    return search.neighbours(e, wanted, 10)


@query
def m10_width_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = tables.read(spark, sf_dir, "embeddings").withColumn("embedding", F.when(F.col("vec_id") % 50 == 0, F.slice("embedding", 1, 10)).when(F.col("vec_id") % 50 == 1, F.lit(None)).otherwise(F.col("embedding")))
    return search.width_errors(e, 64).select("vec_id")


@query
def m1_field_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = tables.read(spark, sf_dir, "part")
    rows = fulltext.index(part, "p_partkey", ["p_name", "p_type", "p_name"], fulltext.analyzer("standard"))
    return rows.groupBy("field", "term").agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df"))


@query
def m2_stemmed_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of documents as an analyzer for English makes them."""
    rows = fulltext.index(tables.read(spark, sf_dir, "documents"), "doc_id", ["text"], fulltext.analyzer("org.example.EnglishAnalyzer"))
    return rows.groupBy("term").agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df"))


VECTOR_FIELDS = ("topic", "dimension")


@on_graph
def m7_vectors(g: Graph) -> DataFrame:
    """Unit vectors of the encoder that counts hashed words, a row for each place that is not zero."""
    rows = embeddings.encoded(embeddings.texts(g, VECTOR_FIELDS), embeddings.hashed(16))
    return rows.select("name", "hash", F.posexplode("vector").alias("place", "x")).where("x <> 0").select("name", "hash", "place", F.round("x", 6).alias("x"))


@on_graph
def m8_out_of_date(g: Graph) -> DataFrame:
    """How many vectors hold after some texts changed, and after the model or the fields did."""
    now = embeddings.texts(g, VECTOR_FIELDS)
    composition = embeddings.fields_hash(VECTOR_FIELDS)
    old = F.when(F.col("name").cast("long") % 4 == 0, F.lit("sha256:other")).otherwise(F.col("hash"))
    before = now.select("name", old.alias("hash"), F.array(F.lit(1.0)).alias("vector"), F.lit("m").alias("model"), F.lit(composition).alias("fields_hash"))
    out = None
    for case, model, fields in (("same", "m", composition), ("model", "n", composition), ("fields", "m", embeddings.fields_hash(VECTOR_FIELDS[::-1]))):
        one = embeddings.to_encode(now, before, model, fields)[0].agg(F.count(F.lit(1)).alias("stale")).select(F.lit(case).alias("changed"), "stale")
        out = one if out is None else out.unionByName(one)
    return out


@query
def m9_field_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which fields can tell concepts apart."""
    g = tables.graph(spark, sf_dir)
    kinds = {"topic": "TOPIC", "aspect": "ORDERED", "dimension": "TEXT", "same": "TEXT"}
    same = g.concepts.select(F.col("name").alias("concept"), F.lit("same").alias("field"), F.lit("one").alias("value"), F.lit(0).alias("ord"))
    g = replace(g, values=g.values.unionByName(same), field_specs={n: {"type": k, "scope": "ONTOLOGY"} for n, k in kinds.items()})
    kept, warnings = embeddings.checked(g, list(kinds))
    return spark.createDataFrame([(n, n in kept, sum(w.startswith(f"{n} ") for w in warnings)) for n in kinds], "field string, kept boolean, warnings int")


@on_graph
def h7_sidecar(g: Graph) -> DataFrame:
    """The sidecar's rows without their vectors, sorted by name."""
    return embeddings.sidecar(g, VECTOR_FIELDS, embeddings.hashed(16)).select("name", "hash", "dimensions", "fields_hash")


@on_graph
def j19_field_values(g: Graph) -> DataFrame:
    return embeddings.field_values(g, VECTOR_FIELDS)


@query
def j22_analyzers(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = tables.read(spark, sf_dir, "region").select("r_name").distinct().collect()  # five names that no analyzer has
    asked = ["brazilian", "Portuguese", "org.x.de.GermanAnalyzer", "standard-no-stop-words", "whitespace", "", *(r.r_name for r in names)]
    return spark.createDataFrame([(n, fulltext.analyzer(n).name, fulltext.analyzer(n).folds) for n in asked], "asked string, analyzer string, folds boolean")


@on_graph
def j23_estimates(g: Graph) -> DataFrame:
    """Expected seconds of each metric for this graph."""
    spark = g.concepts.sparkSession
    n, e = g.vertices().count(), projection.relates_to(g).count()
    return spark.createDataFrame([(m, round(estimates.seconds(n, [m], edges=e), 6)) for m in algorithms.METRICS], "metric string, seconds double")


# projects: context and linkage ---------------------------------------------------------------------------------------


def _context(g: Graph) -> context.Context:
    """Written to the shared folder, read back, and removed."""
    spark, root = g.concepts.sparkSession, f"{algorithms.shared_dir(g.concepts.sparkSession)}/loomgraph-{uuid.uuid4().hex}"
    about = context.with_vectors(context.with_search(context.build(g), ["search_name"], ["citation"], [], "english"), VECTOR_FIELDS, "hashed-16", 16)
    context.write(spark, context.with_metrics(about, "spark", "concepts"), root)
    try:
        return context.read(spark, root)
    finally:
        sinks.discard(spark, root)


@on_graph
def b12_project_context(g: Graph) -> DataFrame:
    c = _context(g)
    names = ("project_name", "concept_label", "source_count", "item_count", "concept_count", "embedding_fields", "embedding_dimensions", "fulltext_concept_fields", "fulltext_source_fields", "fulltext_analyzer", "metrics_backend")
    return g.concepts.sparkSession.createDataFrame([tuple(getattr(c, n) for n in names)], ", ".join(f"{n} {'long' if isinstance(getattr(c, n), int) else 'string'}" for n in names))


@on_graph
def l25_context_lines(g: Graph) -> DataFrame:
    """The lines that tell what the graph holds and how it is connected."""
    c = _context(g)
    lines = [x for x in (*c.template_doc.split("\n"), *c.project_summary.split("\n")) if x.startswith("- `(") or x.endswith((" sources", " items", " concepts"))]
    return g.concepts.sparkSession.createDataFrame([(x,) for x in lines], "line string")


@query
def b18_refused_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an update refuses: changed settings that both sides name."""
    old = context.Context(fulltext_analyzer="standard", embedding_model="a", embedding_fields="")
    cases = {"none": old, "analyzer": replace(old, fulltext_analyzer="english"), "blank": replace(old, embedding_model="", embedding_fields="x"), "both": replace(old, fulltext_analyzer="simple", embedding_model="b")}
    return spark.createDataFrame([(k, len(context.incompatible(old, c))) for k, c in cases.items()], "changed string, refused int")


@query
def c13_without_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields' specifications, with and without the places they come from."""
    names = ["region", "nation", "part"]
    specs = {n: {"type": "TOPIC", "location": {"file": "/x"}, "values": [{"label": "v", "location": 1}]} for n in names}
    return spark.createDataFrame([(n, json.dumps(s, sort_keys=True)) for n, s in context.without_locations(specs).items()], "name string, spec string")


@query
def c15_inferred_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The root of the first page whose address ends with an included path."""
    files = tables.read(spark, sf_dir, "pages").select(F.col("page_id").alias("b"), F.col("url").alias("file"))
    return spark.createDataFrame([(project_json.root_of(files, ["es/12", "/98", "fr/31"]),)], "root string")


@query
def c18_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _across(spark, sf_dir)[0].select("label", "entity_id", "member", "source_bibtex")


@query
def b10_identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities whose source is stored, by label."""
    entities = _across(spark, sf_dir)[0]
    sources = tables.read(spark, sf_dir, "customer").select(F.concat(F.lit("crm:@"), F.col("c_name")).alias("source_bibtex"))
    return entities.join(sources, "source_bibtex").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query
def b11_referring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _across(spark, sf_dir)[1].select("label", "entity_id", "member", "from_source")


@query
def e13_unresolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _across(spark, sf_dir)[2].select("label", "value", "from_source")


def _across(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, list[str]]:
    """Two members: customers identify account holders by nation and key, orders refer to them."""
    customer, orders = tables.read(spark, sf_dir, "customer"), tables.read(spark, sf_dir, "orders")
    own = customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_name").alias("bibtex"), F.lit("key").alias("field"), F.concat(F.lit(" "), F.col("c_custkey").cast("string")).alias("value"), F.col("c_custkey").cast("long").alias("ord"))
    refer = orders.select(F.concat(F.lit("@o"), F.col("o_orderkey").cast("string")).alias("bibtex"), F.lit("holder").alias("field"), F.col("o_custkey").cast("string").alias("value"), F.col("o_orderkey").cast("long").alias("ord"))
    return linkage.across([("crm", {"key": {"scope": "SOURCE", "identifies": "account_holder"}}, own), ("shop", {"holder": {"scope": "SOURCE", "refers_to": "account_holder"}}, refer)])


@on_graph
def k5_whole_graph(g: Graph) -> DataFrame:
    """PageRank over items, sources and concepts and all their relations; of concepts only."""
    node = lambda kind, c: F.concat(F.lit(f"{kind}:"), F.col(c))
    links = [
        g.from_source.select(node("item", "item_id").alias("source"), node("source", "ref").alias("target")),
        g.mentions.select(node("item", "item_id").alias("source"), node("concept", "concept").alias("target")),
        g.chains.select(node("concept", "source").alias("source"), node("concept", "target").alias("target")),
    ]
    ranks = algorithms.over_whole_graph(links, "fast")["pagerank"]
    return ranks.where("name LIKE 'concept:%'").select(F.substring("name", 9, 100).alias("name"), F.round("pagerank", 6).alias("pagerank"))


# extensions: event time ----------------------------------------------------------------------------------------------


@query
def n_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling(tables.read(spark, sf_dir, "events"), "1 hour")


@query
def n_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sliding(tables.read(spark, sf_dir, "events"), "6 hours", "3 hours")


@query
def n_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.sessions(tables.read(spark, sf_dir, "events"), "30 minutes")


@query
def n_event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = tables.read(spark, sf_dir, "events").select("event_type", F.from_json("props", T.StructType([T.StructField("k", T.LongType())])).alias("p"))
    return e.groupBy("event_type").agg(F.sum("p.k").alias("k"), F.count("p.k").alias("n"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
