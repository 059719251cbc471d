"""The queries as SQL over the same tables, independent of the DataFrame code."""

from __future__ import annotations

_ITEM = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice * 100)::BIGINT, strftime(l_shipdate, '%Y%m%d'))"

_GRAPH = f"""
WITH item AS (SELECT {_ITEM} AS item_id, l_orderkey::VARCHAR AS ref, l_partkey::VARCHAR AS concept, * FROM lineitem),
mention AS (SELECT item_id, concept, 1 AS mention_order FROM item),
chain AS (SELECT * FROM (
  SELECT item_id, ref, concept AS source, l_returnflag AS type,
         lead(concept) OVER (PARTITION BY ref ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS target FROM item)
  WHERE target IS NOT NULL),
edge AS (SELECT DISTINCT source, target, type FROM chain),
concept AS (SELECT p_partkey::VARCHAR AS name, p_name AS search_name, p_brand AS topic, p_type AS aspect, 'size ' || p_size AS dimension FROM part),
vertex AS (SELECT name FROM concept UNION SELECT source FROM chain UNION SELECT target FROM chain),
tax AS (SELECT 'topic' AS field, name AS concept, topic AS value FROM concept UNION SELECT 'aspect', name, aspect FROM concept UNION SELECT 'dimension', name, dimension FROM concept),
src AS (SELECT o_orderkey::VARCHAR AS bibtex, 'Order ' || o_orderkey AS title, year(o_orderdate)::VARCHAR AS year FROM orders),
hier AS (SELECT n_name AS child, r_name AS parent, 'PART_OF' AS type FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION SELECT s_name, n_name, 'INSTANCE_OF' FROM supplier JOIN nation ON s_nationkey = n_nationkey),
located AS (SELECT DISTINCT m.concept, m.item_id, i.ref FROM mention m LEFT JOIN item i USING (item_id)),
counts AS (SELECT v.name, count(DISTINCT item_id) AS mention_count, count(DISTINCT ref) AS source_count
  FROM vertex v LEFT JOIN located l ON v.name = l.concept GROUP BY v.name),
pairs AS (SELECT DISTINCT source, target FROM edge),
outs AS (SELECT source AS name, count(*) AS n FROM pairs GROUP BY 1), ins AS (SELECT target AS name, count(*) AS n FROM pairs GROUP BY 1),
degree AS (SELECT v.name, coalesce(o.n, 0) AS out_degree, coalesce(i.n, 0) AS in_degree, coalesce(o.n, 0) + coalesce(i.n, 0) AS degree
  FROM vertex v LEFT JOIN outs o USING (name) LEFT JOIN ins i USING (name)),
ends AS (SELECT source AS name FROM chain UNION ALL SELECT target FROM chain),
link AS (SELECT a.topic AS source, b.topic AS target, count(*) AS strength FROM edge e JOIN concept a ON a.name = e.source JOIN concept b ON b.name = e.target
  WHERE a.topic <> b.topic GROUP BY 1, 2)
"""

_RANKS = """,
share AS MATERIALIZED (SELECT source, target, count(*)::DOUBLE / (sum(count(*)) OVER (PARTITION BY source)) AS share FROM edge GROUP BY source, target),
r0 AS (SELECT name, 0.15::DOUBLE AS pr FROM vertex)
""" + "".join(
    f""",r{i} AS (SELECT v.name, 0.15 + 0.85 * coalesce(f.flow, 0) AS pr FROM vertex v LEFT JOIN
  (SELECT s.target AS name, sum(s.share * r.pr) AS flow FROM share s JOIN r{i - 1} r ON r.name = s.source GROUP BY 1) f USING (name))
"""
    for i in range(1, 21)
)

_METRICS = f"{_GRAPH}{_RANKS}, m AS (SELECT c.name, pr AS pagerank, mention_count, source_count, topic AS community FROM counts c JOIN r20 USING (name) LEFT JOIN concept USING (name))"

_EVIDENCE = """, typed AS (SELECT DISTINCT item_id, unnest([source, target]) AS concept, type FROM chain),
said AS (SELECT DISTINCT m.concept, m.item_id, coalesce(t.type, '') AS type FROM mention m LEFT JOIN typed t USING (concept, item_id)),
evidence AS (SELECT s.concept, s.item_id, row_number() OVER (PARTITION BY s.concept ORDER BY s.item_id, s.type) AS place, i.ref AS source, s.type,
  i.l_returnflag || ' ' || i.l_linestatus AS text FROM said s JOIN item i USING (item_id))"""

_TWO = """, step AS (SELECT source AS a, target AS b, source || '/' || target || '/' || type AS edge FROM edge
  UNION ALL SELECT target, source, source || '/' || target || '/' || type FROM edge WHERE source <> target),
one AS (SELECT b, edge FROM step WHERE a = '7'),
two AS (SELECT NULL AS via, b AS related, 1 AS hops FROM one UNION ALL SELECT one.b, step.b, 2 FROM one JOIN step ON one.b = step.a AND one.edge <> step.edge)"""

_OF_7 = "FROM mention m JOIN item i USING (item_id) JOIN src s ON s.bibtex = i.ref WHERE m.concept = '7'"

_VIEW = """, cov AS (SELECT m.concept AS name, count(*) AS frequency, count(DISTINCT i.ref) AS sources FROM mention m LEFT JOIN item i USING (item_id) GROUP BY 1)"""


def _g(body: str, more: str = "") -> str:
    return f"{_GRAPH}{more} {body}"


_WHOLE = """,
wl AS (SELECT DISTINCT 'item:' || item_id AS source, 'source:' || ref AS target FROM item
  UNION ALL SELECT DISTINCT 'item:' || item_id, 'concept:' || concept FROM item
  UNION ALL SELECT DISTINCT 'concept:' || source, 'concept:' || target FROM chain),
wv AS MATERIALIZED (SELECT source AS name FROM wl UNION SELECT target FROM wl),
ws AS MATERIALIZED (SELECT source, target, count(*)::DOUBLE / (sum(count(*)) OVER (PARTITION BY source)) AS share FROM wl GROUP BY source, target),
w0 AS (SELECT name, 0.15::DOUBLE AS pr FROM wv)
""" + "".join(
    f""",w{i} AS (SELECT v.name, 0.15 + 0.85 * coalesce(f.flow, 0) AS pr FROM wv v LEFT JOIN
  (SELECT s.target AS name, sum(s.share * r.pr) AS flow FROM ws s JOIN w{i - 1} r ON r.name = s.source GROUP BY 1) f USING (name))
"""
    for i in range(1, 21)
)

_TEXTS = """WITH texts AS (SELECT name, text, 'sha256:' || sha256(text) AS hash FROM (
  SELECT p_partkey::VARCHAR AS name, p_partkey::VARCHAR || '. ' || p_brand || '. ' || 'size ' || p_size AS text FROM part))"""


def _stemmed(words: str) -> str:
    """Words x of documents without the endings of English, taken off one after the other while five letters are left."""
    for ending, put in (("ies$", "y"), ("(?:sses)$", "ss"), ("([^su])s$", "\\1"), ("(?:ing|ed)$", "")):
        words = f"SELECT doc_id, CASE WHEN length(x) > 4 THEN regexp_replace(x, '{ending}', '{put}') ELSE x END AS x FROM ({words})"
    return words


_FIRST_NAMES = "SELECT {c} AS {o}, count(*) AS total, array_to_string(list_sort(list(name))[1:5], ',') AS examples FROM concept GROUP BY 1"

SQL = {
    "a14_counts": _g("SELECT (SELECT count(*) FROM src) AS sources, (SELECT count(DISTINCT (l_orderkey, l_linenumber)) FROM item) AS annotations, (SELECT count(*) FROM item) AS items, (SELECT count(*) FROM mention) AS mentions, (SELECT count(*) FROM vertex) AS concepts, (SELECT count(*) FROM edge) AS relations"),
    "b5_from_source": _g("SELECT ref, count(DISTINCT item_id) AS items FROM item JOIN src ON bibtex = ref GROUP BY ref"),
    "b6_relates_to": _g("SELECT source, target, type, max(item_id) AS item_id FROM chain GROUP BY ALL"),
    "b6_vertices": _g("SELECT name FROM vertex"),
    "b7_taxonomy_edges": _g("SELECT field, concept, value FROM tax"),
    "b8_mentions": _g("SELECT concept, mention_order, count(DISTINCT item_id) AS mentions FROM (SELECT * FROM mention UNION ALL SELECT item_id, 'S' || l_suppkey, 0 FROM item) JOIN vertex ON name = concept GROUP BY 1, 2"),
    "b9_hierarchy": _g("SELECT * FROM hier"),
    "b3_upsert_sources": "SELECT o_orderkey::VARCHAR AS bibtex, CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'Order ' || o_orderkey END AS title, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE year(o_orderdate)::VARCHAR END AS year FROM orders",
    "c4_description_dedup": "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_type END AS description FROM part",
    "c11_item_ids": "SELECT 'conv' || conv_id || '_n' || lpad((row_number() OVER (PARTITION BY conv_id ORDER BY turn))::VARCHAR, 4, '0') AS item_id, turn FROM conversations WHERE role = 'user'",
    "c12_relation_names": "SELECT upper(replace(replace(trim(o_orderpriority), ' ', '_'), '-', '_')) AS type, count(*) AS n FROM orders GROUP BY 1",
    "c14_relative_paths": "SELECT page_id, CASE WHEN starts_with(url, 'https:/') THEN url[8:] END AS path FROM pages",
    "c10_qualified": "SELECT o_orderkey::VARCHAR AS ref, 'left:@' || o_orderkey AS bibtex FROM orders",
    "d1_filtered_concepts": _g("SELECT name FROM concept JOIN cov USING (name) WHERE frequency >= 30 AND sources >= 30", _VIEW),
    "d2_connected_concepts": _g("SELECT name FROM concept WHERE name IN (SELECT name FROM ends)"),
    "d3_kept_chains": _g("SELECT item_id, source, target, type FROM chain WHERE source IN (SELECT name FROM cov WHERE frequency >= 32) AND target IN (SELECT name FROM cov WHERE frequency >= 32)", _VIEW),
    "d4_without_loops": _g("SELECT type, count(*) AS n FROM chain WHERE source <> target GROUP BY type"),
    "d6_valid_labels": "SELECT label, regexp_full_match(label, '[A-Za-z_][A-Za-z0-9_]*') AS valid FROM (SELECT event_type AS label FROM events UNION SELECT p_brand FROM part)",
    "d8_constant_fields": "SELECT 'p_brand' AS field, count(DISTINCT p_brand) AS values, count(DISTINCT p_brand) <= 1 AS constant FROM part UNION ALL SELECT 'p_type', count(DISTINCT p_type), count(DISTINCT p_type) <= 1 FROM part UNION ALL SELECT 'same', 1, true",
    "d10_visible_nodes": _g(
        """SELECT name, coalesce(cid, 0)::INT AS cid, cid IS NULL AS filtered
        FROM (SELECT name FROM kept UNION SELECT name FROM ends) LEFT JOIN kept_group USING (name) LEFT JOIN near USING (name)
        WHERE cid IS NULL OR (coalesce(n, 0) >= 40 AND cid NOT IN (0, 2))""",
        _VIEW + """, kept AS (SELECT name, topic FROM concept JOIN cov USING (name) WHERE frequency >= 30),
        leg AS (SELECT topic, row_number() OVER (ORDER BY count(*) DESC, topic) - 1 AS cid FROM kept GROUP BY topic),
        kept_group AS (SELECT name, cid FROM kept JOIN leg USING (topic)),
        near AS (SELECT name, count(DISTINCT other) AS n FROM (SELECT source AS name, target AS other FROM chain UNION ALL SELECT target, source FROM chain) GROUP BY 1)""",
    ),
    "d11_label_search": "SELECT DISTINCT p_name AS name FROM part WHERE contains(lower(p_name), 're') ORDER BY 1 LIMIT 20",
    "e2_located_mentions": _g("SELECT ref, count(DISTINCT concept) AS concepts FROM located GROUP BY ref"),
    "e6_co_taxonomy": _g("SELECT a.concept AS source, b.concept AS target, count(*) AS weight FROM tax a JOIN tax b ON a.field = b.field AND a.value = b.value AND a.concept <> b.concept GROUP BY 1, 2"),
    "e7_co_citation": _g("SELECT a.concept AS source, b.concept AS target, count(DISTINCT a.ref) AS weight FROM located a JOIN located b ON a.ref = b.ref AND a.concept <> b.concept AND a.item_id <> b.item_id GROUP BY 1, 2"),
    "e9_aliases": _g("SELECT coalesce(a.target, c.source) AS source, coalesce(b.target, c.target) AS target, count(*) AS n FROM chain c LEFT JOIN al a ON a.alias = c.source LEFT JOIN al b ON b.alias = c.target WHERE coalesce(a.target, c.source) <> coalesce(b.target, c.target) GROUP BY 1, 2", ", al AS (SELECT p_partkey::VARCHAR AS alias, low::VARCHAR AS target FROM (SELECT *, min(p_partkey) OVER (PARTITION BY p_name) AS low FROM part) WHERE p_partkey <> low)"),
    "e10_merged_origins": "SELECT bibref, coalesce(nullif(a.title, ''), nullif(b.title, '')) AS title, b.author FROM (SELECT o_orderkey::VARCHAR AS bibref, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE '' END AS title FROM orders WHERE o_orderkey % 3 <> 0) a FULL JOIN (SELECT o_orderkey::VARCHAR AS bibref, o_orderstatus AS title, o_custkey::VARCHAR AS author FROM orders WHERE o_orderkey % 5 <> 0) b USING (bibref)",
    "e11_tolerant_lookup": "SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN '@' || upper(c_name) ELSE '@' || lower(c_name) END AS ref, c_mktsegment FROM customer",
    "e12_identity_edges": "SELECT 'customer' AS entity, o_custkey::VARCHAR AS entity_id, 'shop' AS member, o_orderkey::VARCHAR AS from_source FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING'",
    "e13_orphans": "SELECT 'customer' AS entity, o_custkey::VARCHAR AS value, 'shop' AS member, o_orderkey::VARCHAR AS from_source FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
    "e14_index_labels": "SELECT p_partkey, CASE p_size % 13 WHEN 0 THEN 'zero' WHEN 2 THEN 'two' WHEN 11 THEN 'eleven' ELSE (p_size % 13)::VARCHAR END AS label FROM part",
    "e18_left_joins": "SELECT r_name, count(*) AS customers FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (SELECT * FROM region WHERE r_regionkey <> 1) ON n_regionkey = r_regionkey GROUP BY 1",
    "e19_mapped_aspects": _g("SELECT DISTINCT topic, aspect AS value FROM concept"),
    "e19_mapped_dimensions": _g("SELECT DISTINCT topic, dimension AS value FROM concept"),
    "e20_stale_vectors": "SELECT p_partkey::VARCHAR AS name, 'sha256:' || sha256(p_name) AS hash FROM part WHERE p_partkey % 5 = 0 OR p_partkey % 4 = 0 OR p_partkey % 7 = 0",
    "f1_degrees": _g("SELECT * FROM degree"),
    "f2_mention_counts": _g("SELECT * FROM counts"),
    "f3_taxonomy_counts": _g("SELECT field, value, count(*) AS concept_count FROM tax GROUP BY 1, 2"),
    "f4_topic_weights": _g("SELECT t.topic, coalesce(sum(strength), 0)::BIGINT AS weighted_degree FROM (SELECT DISTINCT topic FROM concept) t LEFT JOIN (SELECT source AS topic, strength FROM link UNION ALL SELECT target, strength FROM link) l USING (topic) GROUP BY 1"),
    "f5_aspect_diversity": _g("SELECT topic, count(DISTINCT aspect) AS aspect_diversity FROM concept GROUP BY 1"),
    "f5_dimension_diversity": _g("SELECT topic, count(DISTINCT dimension) AS dimension_diversity FROM concept GROUP BY 1"),
    "f6_source_metrics": _g("SELECT bibtex, count(DISTINCT item_id) AS item_count, count(DISTINCT concept) AS concept_count FROM src LEFT JOIN item ON ref = bibtex GROUP BY 1"),
    "f9_linked_topics": _g("SELECT source, target, strength FROM link"),
    "f10_linked_topics_raw": _g("SELECT a.topic AS source, b.topic AS target, count(*) AS strength FROM chain e JOIN concept a ON a.name = e.source JOIN concept b ON b.name = e.target WHERE a.topic <> b.topic GROUP BY 1, 2"),
    "f11_coverage": _g("SELECT * FROM cov", _VIEW),
    "f13_endpoint_degree": _g("SELECT name, count(*) AS degree FROM ends GROUP BY 1"),
    "f14_edges": _g("SELECT source, target, sum(n)::BIGINT AS total, first(type ORDER BY n DESC, ord, type) AS dominant, string_agg(type || ' x' || n, ' | ' ORDER BY n DESC, ord, type) AS relations, any_value(refs) AS sources, round(1 + least(sum(n), 40) * 0.35, 2)::DOUBLE AS width FROM (SELECT source, target, type, count(*) AS n, min(item_id) AS ord FROM chain GROUP BY ALL) JOIN (SELECT source, target, count(DISTINCT ref) AS refs FROM chain GROUP BY ALL) USING (source, target) GROUP BY 1, 2"),
    "f15_legend": _g('SELECT (row_number() OVER (ORDER BY count(*) DESC, topic) - 1)::INT AS cid, topic AS "group", count(*) AS count FROM concept GROUP BY topic'),
    "f16_hyperedges": _g("SELECT block, size, ref || ' - ' || block AS label, ref AS source FROM (SELECT block, count(DISTINCT name) AS size, any_value(ref) AS ref FROM (SELECT i.l_orderkey || '_' || i.l_linenumber AS block, unnest([c.source, c.target]) AS name, i.ref FROM chain c JOIN item i USING (item_id)) JOIN concept USING (name) GROUP BY block) WHERE size >= 3 ORDER BY size DESC, block LIMIT 30"),
    "f18_neighbours": _g("SELECT name, count(DISTINCT other) AS neighbor_count FROM (SELECT source AS name, target AS other FROM chain UNION ALL SELECT target, source FROM chain) GROUP BY 1"),
    "f19_grouped_edges": _g("SELECT source, target, CASE WHEN count(*) > 1 THEN 'many' ELSE min(type) END AS relation, string_agg(type, ', ' ORDER BY ord, type) AS types FROM (SELECT source, target, type, min(item_id) AS ord FROM chain GROUP BY ALL) GROUP BY 1, 2"),
    "g2_slugs": _g("SELECT name, CASE WHEN k = 1 THEN base ELSE base || '_' || k END AS slug FROM (SELECT name, base, row_number() OVER (PARTITION BY base ORDER BY name) AS k FROM (SELECT name, regexp_replace(regexp_replace(lower(name), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS base FROM (SELECT search_name || ' ' || name[-1:] AS name FROM concept UNION SELECT search_name || '-' || name[-1:] FROM concept)))"),
    "g3_first_sources": _g("SELECT concept, first(ref ORDER BY item_id, ref) AS source FROM item GROUP BY concept"),
    "g4_evidence": _g("SELECT concept, item_id, place::INT AS place, source, type, text FROM evidence WHERE place <= 60", _EVIDENCE),
    "h1_top_nodes": _g("SELECT name FROM concept LEFT JOIN (SELECT name, count(*) AS d FROM ends GROUP BY 1) USING (name) ORDER BY coalesce(d, 0) DESC, name LIMIT 50"),
    "h4_hierarchy_sorted": _g("SELECT child, parent, type FROM hier ORDER BY type, child, parent"),
    "h8_page": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100",
    "i2_union_concepts": "SELECT name, min(kind) FILTER (WHERE k = rank) AS kind FROM (SELECT *, min(rank) OVER (PARTITION BY name) AS k FROM (SELECT regexp_replace(s_name, '[A-Za-z#]', '', 'g') AS name, 'supplier' AS kind, 0 AS rank FROM supplier UNION ALL SELECT regexp_replace(c_name, '[A-Za-z#]', '', 'g'), 'customer', 1 FROM customer)) GROUP BY name",
    "i7_unmentioned": _g("SELECT name FROM concept WHERE name NOT IN (SELECT name FROM ends)"),
    "i7_lost_to_a_higher_bar": _g("SELECT name FROM cov JOIN concept USING (name) WHERE frequency BETWEEN 28 AND 30", _VIEW),
    "i9_evidence_union": _g("SELECT DISTINCT source, type, text FROM evidence WHERE place <= 60 AND concept IN ('1', '2')", _EVIDENCE),
    "j_names": "SELECT p_partkey, replace(n, '_', ' ') AS human, CASE WHEN regexp_matches(l, '^[0-9]') THEN '_' || l ELSE l END AS label, CASE WHEN regexp_matches(d, '^[a-z]') THEN d ELSE 'db' || d END AS database, regexp_replace(array_to_string(list_transform(list_filter(regexp_split_to_array(n, '[_-]'), lambda p: p <> ''), lambda p: upper(p[1]) || p[2:]), ''), '[^\\p{L}\\p{N}_]', '', 'g') AS entity, upper(p_name[1]) || lower(p_name[2:]) AS capital, regexp_replace(regexp_replace(lower(n), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug, CASE WHEN length(repeat(p_name, 8)) > 60 THEN repeat(p_name, 8)[1:57] || '...' ELSE repeat(p_name, 8) END AS short, 'sha256:' || sha256(n) AS hash FROM (SELECT *, p_name || '_' || p_brand AS n, regexp_replace(p_name || '_' || p_brand, '[^\\p{L}\\p{N}_]', '', 'g') AS l, lower(regexp_replace(replace(p_name || '_' || p_brand, '_', '-'), '[^A-Za-z0-9.-]', '', 'g')) AS d FROM part)",
    "j1_identity": "SELECT DISTINCT '  ' || upper(p_name) || '  x ' AS name, lower(regexp_replace(trim('  ' || upper(p_name) || '  x '), '\\s+', ' ', 'g')) AS identity FROM part",
    "j_items": "SELECT conv_id, turn, 'b' || conv_id || CASE WHEN turn % 3 = 0 THEN '' ELSE '_x' || lpad(turn::VARCHAR, 4, '0') END AS block, 'a' || turn AS anchor, role AS analysis FROM conversations WHERE turn IS NOT NULL",
    "j16_concept_text": "SELECT p_partkey, replace(p_name, '_', ' ') || '. ' || p_type || CASE WHEN p_size > 25 THEN '. large part' ELSE '' END AS text FROM part",
    "j14_edge_widths": _g("SELECT round(1 + least(t, 40) * 0.35, 2)::DOUBLE AS width, count(*) AS n FROM (SELECT count(*) AS t FROM chain GROUP BY source, target) GROUP BY 1"),
    "k1_projection": _g("SELECT source, target, count(*) AS weight FROM edge GROUP BY 1, 2"),
    "k2_pagerank": _g("SELECT name, round(pr, 6) AS pagerank FROM r20", _RANKS),
    "k8_closure": _g("SELECT n AS node, n AS ancestor, 0 AS depth FROM (SELECT child AS n FROM hier UNION SELECT parent FROM hier) UNION ALL SELECT child, parent, 1 FROM hier UNION ALL SELECT a.child, b.parent, 2 FROM hier a JOIN hier b ON a.parent = b.child"),
    "k8_subtree_evidence": _g("SELECT ancestor, count(DISTINCT item_id) AS items FROM (SELECT item_id, unnest([s_name, n_name, r_name]) AS ancestor FROM item JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey) GROUP BY 1"),
    "k9_within_two": _g("SELECT related, hops, count(*) AS paths FROM two GROUP BY 1, 2", _TWO),
    "l1_label_counts": _g("SELECT 'Source' AS label, count(*) AS count FROM src UNION ALL SELECT 'Item', count(*) FROM item UNION ALL SELECT 'Concept', count(*) FROM vertex UNION ALL SELECT upper(field[1]) || field[2:], count(DISTINCT value) FROM tax GROUP BY field"),
    "l2_schema": "SELECT * FROM (VALUES ('Item', 'FROM_SOURCE', 'Source'), ('Item', 'MENTIONS', 'Concept'), ('Concept', 'RELATES_TO', 'Concept'), ('Concept', 'GROUPED_BY', 'Topic'), ('Concept', 'QUALIFIED_BY', 'Aspect'), ('Concept', 'BELONGS_TO', 'Dimension')) t(source, relation, target)",
    "l3_top_pagerank": f"{_METRICS} SELECT name AS concept, round(pagerank, 4) AS pagerank, mention_count AS mentions, source_count AS sources FROM m ORDER BY 2 DESC, 1 LIMIT 10",
    "l5_topics": _g(_FIRST_NAMES.format(c="topic", o="community")),
    "l6_citations": _g(f"SELECT title AS source, l_returnflag || ' ' || l_linestatus AS citation, 'orders/' || ref AS file, l_linenumber AS line {_OF_7}"),
    "l7_sources_of": _g(f"SELECT title AS source, ref AS id, count(*) AS citations {_OF_7} GROUP BY 1, 2"),
    "l8_trace": _g(f"SELECT m.concept, l_returnflag || ' ' || l_linestatus AS citation, 'orders/' || ref AS file, l_linenumber AS line, title AS source {_OF_7} ORDER BY source, line, citation LIMIT 20"),
    "l9_direct": _g("SELECT '7' AS origin, 'RELATES_TO' AS relationship, type, CASE WHEN source = '7' THEN target ELSE source END AS target FROM edge WHERE source = '7' OR target = '7'"),
    "l10_by_taxonomy": _g("SELECT a.topic, string_agg(b.name, ',' ORDER BY b.name) AS related_concepts FROM concept a JOIN concept b ON a.topic = b.topic AND a.name <> b.name WHERE a.name = '7' GROUP BY 1"),
    "l11_two_hops": _g("SELECT via, related, hops FROM two ORDER BY hops, via NULLS FIRST, related LIMIT 50", _TWO),
    "l12_topics": _g("SELECT topic, any_value(n) AS total, sum(strength)::BIGINT AS weight, any_value(a) AS aspect_diversity FROM (SELECT topic, count(*) AS n, count(DISTINCT aspect) AS a FROM concept GROUP BY 1) JOIN (SELECT source AS topic, strength FROM link UNION ALL SELECT target, strength FROM link) USING (topic) GROUP BY 1"),
    "l13_topic_members": _g(_FIRST_NAMES.format(c="topic", o="topic")),
    "l14_topic_by_aspect": _g("SELECT topic, aspect, count(*) AS shared_concepts FROM concept GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20"),
    "l15_richest": _g("SELECT title AS source, bibtex AS id, count(DISTINCT item_id) AS citations, count(DISTINCT concept) AS concepts FROM src LEFT JOIN item ON ref = bibtex GROUP BY 1, 2 ORDER BY 4 DESC, 2 LIMIT 10"),
    "l16_concepts_of": _g("SELECT concept, count(*) AS mentions FROM item WHERE ref = '7' GROUP BY 1"),
    "l17_covering": _g("SELECT ref AS id, count(DISTINCT item.concept) AS topic_concepts FROM item JOIN concept c ON c.name = item.concept WHERE topic = 'Brand#23' GROUP BY 1"),
    "l18_compare_topics": f"{_METRICS} SELECT community, count(*) AS concepts, round(avg(pagerank), 4) AS average_pagerank, round(avg(mention_count), 1) AS average_mentions FROM m WHERE community IS NOT NULL GROUP BY 1",
    "l19_widespread": _g("SELECT name AS concept, source_count AS sources, mention_count AS mentions FROM counts WHERE source_count > 5 ORDER BY 2 DESC, 1 LIMIT 20"),
    "l20_exclusive": _g("SELECT concept, 'Order ' || min(ref) AS single_source, count(DISTINCT item_id) AS mentions FROM item GROUP BY 1 HAVING count(DISTINCT ref) = 1 ORDER BY 3 DESC, 1 LIMIT 20"),
    "l21_isolated": _g("SELECT name AS concept, degree AS relationships, mention_count AS mentions, source_count AS sources FROM degree JOIN counts USING (name) WHERE degree < 30 ORDER BY 3 DESC, 1 LIMIT 20"),
    "l22_triangulated": _g("SELECT concept, count(*) AS num_sources, array_to_string(list_sort(list(title))[1:3], ',') AS example_sources FROM (SELECT DISTINCT concept, 'Order ' || ref AS title FROM item) GROUP BY 1 HAVING count(*) >= 3"),
    "l23_saturation": _g("SELECT ref AS source, 'Order ' || ref AS title, count(DISTINCT concept) AS new_concepts FROM item GROUP BY 1"),
    "l23_first_appearance": _g("SELECT source, count(*) AS first_seen FROM (SELECT concept, min(ref) AS source FROM item GROUP BY 1) GROUP BY 1"),
    "l24_central_of_topic": f"{_METRICS} SELECT name AS concept, round(pagerank, 4) AS pagerank, mention_count AS mentions, source_count AS sources FROM m WHERE community = 'Brand#23' ORDER BY 2 DESC, 1 LIMIT 10",
    "l26_paths": _g("SELECT ref AS source, count(*) AS paths FROM item GROUP BY 1"),
    "m10_width_errors": "SELECT vec_id FROM embeddings WHERE vec_id % 50 IN (0, 1)",
    "m1_field_index": "SELECT field, term, count(*) AS tf, count(DISTINCT id) AS df FROM (SELECT p_partkey AS id, 'p_name' AS field, unnest(regexp_extract_all(lower(p_name), '[\\p{L}\\p{N}_]+')) AS term FROM part UNION ALL SELECT p_partkey, 'p_type', unnest(regexp_extract_all(lower(p_type), '[\\p{L}\\p{N}_]+')) FROM part) GROUP BY 1, 2",
    "m2_stemmed_terms": "SELECT x AS term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM (" + _stemmed("SELECT doc_id, unnest(regexp_extract_all(translate(lower(text), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[\\p{L}\\p{N}_]+')) AS x FROM documents") + ") GROUP BY 1",
    "m7_vectors": f"{_TEXTS}, word AS (SELECT name, hash, ('0x' || substr(md5(w), 1, 8))::BIGINT % 16 AS place FROM (SELECT name, hash, unnest(string_split(lower(text), ' ')) AS w FROM texts)), c AS (SELECT name, hash, place, count(*)::DOUBLE AS n FROM word GROUP BY ALL) SELECT name, hash, place::INT AS place, round(n / sqrt(sum(n * n) OVER (PARTITION BY name)), 6) AS x FROM c",
    "m8_out_of_date": "SELECT 'same' AS changed, count(*) FILTER (WHERE p_partkey % 4 = 0) AS stale FROM part UNION ALL SELECT 'model', count(*) FROM part UNION ALL SELECT 'fields', count(*) FROM part",
    "m9_field_checks": "SELECT 'topic' AS field, count(DISTINCT p_brand) > 1 AS kept, 1 AS warnings FROM part UNION ALL SELECT 'aspect', count(DISTINCT p_type) > 1, 1 FROM part UNION ALL SELECT 'dimension', count(DISTINCT p_size) > 1, 0 FROM part UNION ALL SELECT 'same', false, 1",
    "h7_sidecar": f"{_TEXTS} SELECT name, hash, 16 AS dimensions, 'sha256:' || sha256('topic' || chr(31) || 'dimension') AS fields_hash FROM texts",
    "j19_field_values": "SELECT p_partkey::VARCHAR AS name, p_brand AS topic, 'size ' || p_size AS dimension FROM part",
    "j22_analyzers": "SELECT * FROM (VALUES ('brazilian', 'portuguese', true), ('Portuguese', 'portuguese', true), ('org.x.de.GermanAnalyzer', 'german', true), ('standard-no-stop-words', 'simple', false), ('whitespace', 'whitespace', false), ('', 'standard', false)) t(asked, analyzer, folds) UNION ALL SELECT DISTINCT r_name, 'standard', false FROM region",
    "j23_estimates": _g("SELECT metric, round(rate * 2.75687 * pow(n / 820388.0, power), 6) AS seconds FROM (SELECT count(*)::DOUBLE AS n FROM pairs), (VALUES ('pagerank', 4.0::DOUBLE, 1.0::DOUBLE), ('betweenness', 45.0, 2.0), ('community', 232.0, 1.1)) t(metric, rate, power)"),
    "b12_project_context": _g("SELECT 'orders' AS project_name, 'Concept' AS concept_label, (SELECT count(*) FROM src) AS source_count, (SELECT count(*) FROM item) AS item_count, (SELECT count(*) FROM vertex) AS concept_count, 'topic,dimension' AS embedding_fields, 16 AS embedding_dimensions, 'search_name' AS fulltext_concept_fields, '' AS fulltext_source_fields, 'english' AS fulltext_analyzer, 'spark' AS metrics_backend"),
    "l25_context_lines": _g("SELECT '- ' || count(*) || ' sources' AS line FROM src UNION ALL SELECT '- ' || count(*) || ' items' FROM item UNION ALL SELECT '- ' || count(*) || ' concepts' FROM vertex UNION ALL SELECT unnest(['- `(Item)-[FROM_SOURCE]->(Source)`', '- `(Item)-[MENTIONS]->(Concept)`', '- `(Concept)-[RELATES_TO]->(Concept)`', '- `(Concept)-[GROUPED_BY]->(Topic)`', '- `(Concept)-[QUALIFIED_BY]->(Aspect)`', '- `(Concept)-[BELONGS_TO]->(Dimension)`'])"),
    "b18_refused_changes": "SELECT * FROM (VALUES ('none', 0), ('analyzer', 1), ('blank', 0), ('both', 2)) t(changed, refused)",
    "c13_without_locations": """SELECT n AS name, '{"type": "TOPIC", "values": [{"label": "v"}]}' AS spec FROM (VALUES ('region'), ('nation'), ('part')) t(n)""",
    "c15_inferred_root": "SELECT coalesce((SELECT rtrim(left(url, length(url) - length(i)), '/') FROM pages, (VALUES (1, 'es/12'), (2, '/98'), (3, 'fr/31')) t(k, i) WHERE ends_with(url, i) ORDER BY page_id, k LIMIT 1), '') AS root",
    "c18_entities": "SELECT 'AccountHolder' AS label, c_custkey::VARCHAR AS entity_id, 'crm' AS member, 'crm:@' || c_name AS source_bibtex FROM customer WHERE c_mktsegment = 'BUILDING'",
    "b10_identified": "SELECT 'AccountHolder' AS label, count(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING'",
    "b11_referring": "SELECT DISTINCT 'AccountHolder' AS label, o_custkey::VARCHAR AS entity_id, 'shop' AS member, 'shop:@o' || o_orderkey AS from_source FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'",
    "e13_unresolved": "SELECT DISTINCT 'AccountHolder' AS label, o_custkey::VARCHAR AS value, 'shop:@o' || o_orderkey AS from_source FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING' WHERE c_custkey IS NULL",
    "k5_whole_graph": _g("SELECT substr(name, 9) AS name, round(pr, 6) AS pagerank FROM w20 WHERE name LIKE 'concept:%'", _WHOLE),
    "m1_inverted_index": "SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(regexp_extract_all(translate(lower(text), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[\\p{L}\\p{N}_]+')) AS term FROM documents) GROUP BY 1",
    "m3_bm25": """WITH w AS (SELECT doc_id, regexp_extract_all(translate(lower(text), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[\\p{L}\\p{N}_]+') AS words FROM documents),
      f AS (SELECT count(*) AS n, avg(len(words)) AS mean FROM w),
      t AS (SELECT doc_id, len(words) AS length, unnest(words) AS term FROM w),
      c AS (SELECT doc_id, length, term, count(*) AS tf FROM t WHERE term IN ('license', 'token', 'mit') GROUP BY ALL),
      d AS (SELECT term, count(*) AS df FROM c GROUP BY 1)
      SELECT doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))), 6) AS score FROM c JOIN d USING (term), f GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    "m6_vector_search": "SELECT e.vec_id, round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS similarity FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 7) q ORDER BY 2 DESC, 1 LIMIT 10",
    "n_tumbling": "SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "n_sliding": "SELECT start, count(*) AS n, round(sum(value), 4) AS total FROM (SELECT value, unnest([time_bucket(INTERVAL '3 hours', ts, TIMESTAMP '1970-01-01'), time_bucket(INTERVAL '3 hours', ts, TIMESTAMP '1970-01-01') - INTERVAL '3 hours']) AS start FROM events) GROUP BY 1",
    "n_sessions": "SELECT user_id, min(ts) AS start, count(*) AS n FROM (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL '30 minutes' THEN 1 ELSE 0 END AS fresh FROM events)) GROUP BY user_id, s",
    "n_event_props": "SELECT event_type, sum((props->>'k')::BIGINT)::BIGINT AS k, count(props->>'k') AS n FROM events GROUP BY 1",
}
