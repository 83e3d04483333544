"""The trading tables as a graph.

Region CONTAINS Nation, Nation HOSTS Supplier, Supplier BASED_IN Nation,
Customer LOCATED_IN Nation, Supplier SUPPLIES Part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.catalog.base import table
from marlstone.functions import text as tx
from marlstone.operators import entities
from marlstone.operators import graph as g
from marlstone.plans.assistant import graph_context
from marlstone.session import dealt, stack


def nodes(spark, sf) -> DataFrame:
    t = lambda n: table(spark, sf, n)
    return stack(*[
        g.make_nodes(t("region"), "Region", "r_regionkey", "r_name"),
        g.make_nodes(t("nation"), "Nation", "n_nationkey", "n_name"),
        g.make_nodes(t("customer"), "Customer", "c_custkey", "c_name", ["c_mktsegment"]),
        g.make_nodes(t("supplier"), "Supplier", "s_suppkey", "s_name"),
        g.make_nodes(t("part"), "Part", "p_partkey", "p_name", ["p_brand", "p_size"]),
    ])


def _key(label: str, column: str) -> Column:
    return F.concat(F.lit(f"{label}:"), F.col(column).cast("string"))


def _edge(df: DataFrame, src: Column, rel: str, dst: Column) -> DataFrame:
    return df.select(src.alias("src"), F.lit(rel).alias("rel"), dst.alias("dst"))


def edges(spark, sf) -> DataFrame:
    t = lambda n: table(spark, sf, n)
    supplies = dealt(t("lineitem").select("l_suppkey", "l_partkey"), "l_suppkey", "l_partkey").distinct()
    return stack(*[
        _edge(t("nation"), _key("Region", "n_regionkey"), "CONTAINS", _key("Nation", "n_nationkey")),
        _edge(t("supplier"), _key("Nation", "s_nationkey"), "HOSTS", _key("Supplier", "s_suppkey")),
        _edge(t("supplier"), _key("Supplier", "s_suppkey"), "BASED_IN", _key("Nation", "s_nationkey")),
        _edge(t("customer"), _key("Customer", "c_custkey"), "LOCATED_IN", _key("Nation", "c_nationkey")),
        _edge(supplies, _key("Supplier", "l_suppkey"), "SUPPLIES", _key("Part", "l_partkey")),
    ])


def graph_related(spark, sf):
    return g.related_entities(nodes(spark, sf), edges(spark, sf), "nation_1")


def graph_related_all(spark, sf):
    return g.related_entities(nodes(spark, sf), edges(spark, sf), "BOLT", limit=None).drop("source_type")


def graph_articles(spark, sf):
    """Suppliers that point to parts of an exact name."""
    return g.articles_for_concept(nodes(spark, sf), edges(spark, sf), "blue bolt", rel="SUPPLIES")


def graph_articles_like(spark, sf):
    found = g.articles_for_concept(nodes(spark, sf), edges(spark, sf), "bolt", exact=False, rel="SUPPLIES")
    return found.groupBy("concept").agg(F.count("*").alias("n"), F.countDistinct("article_key").alias("sources"))


def graph_requirements(spark, sf):
    """Suppliers of a named part, and the nations that host them."""
    out = g.requirements_for_fund(nodes(spark, sf), edges(spark, sf), "blue bolt", applies="SUPPLIES", requires="HOSTS")
    return out.groupBy("requirement", "article_id").agg(F.count("*").alias("n"))


def graph_requirements_optional(spark, sf):
    """The same where only some suppliers have an article: those whose nation has customers."""
    e = edges(spark, sf)
    busy = e.filter(F.col("rel") == "LOCATED_IN").groupBy("dst").agg(F.count("*").alias("n")).filter(
        "n % 2 = 0").select(F.col("dst").alias("src"))
    some = stack(e.filter(F.col("rel") != "HOSTS"),
                 e.filter(F.col("rel") == "HOSTS").join(busy, "src", "left_semi").select("src", "rel", "dst"))
    out = g.requirements_for_fund(nodes(spark, sf), some, "blue bolt", optional_article=True, applies="SUPPLIES",
                                  requires="HOSTS")
    return out.groupBy("requirement", "article_id").agg(F.count("*").alias("n"))


def graph_chain(spark, sf):
    """Region to nation to supplier to the parts of one name."""
    ends = nodes(spark, sf).filter((F.col("label") == "Part") & (F.col("name") == "blue bolt"))
    return g.chain(edges(spark, sf), ["CONTAINS", "HOSTS", "SUPPLIES"], ends).select(
        "n0", "n1", "n2", "n3", F.array_join("path", ">").alias("path"))


def graph_subgraph(spark, sf):
    return g.chain(edges(spark, sf), ["CONTAINS", "HOSTS"]).select("n0", "n1", "n2").orderBy("n0", "n1", "n2").limit(50)


def graph_coref(spark, sf):
    """Other suppliers of the parts of suppliers based in one nation, per pair of suppliers."""
    found = g.co_references(edges(spark, sf), "Nation:7", "SUPPLIES", "BASED_IN")
    return found.groupBy("a1", "a2").agg(F.count("*").alias("shared"))


def graph_coref_counts(spark, sf):
    return g.co_reference_counts(edges(spark, sf), "SUPPLIES", "BASED_IN")


def graph_degree(spark, sf):
    return g.degrees(edges(spark, sf))


def graph_in_degree(spark, sf):
    return g.in_degree(edges(spark, sf), "SUPPLIES")


def graph_difference(spark, sf):
    return g.reachable_difference(edges(spark, sf), "Supplier:1", "Supplier:2", "SUPPLIES")


def graph_hops(spark, sf):
    """Distance of every node from one region."""
    return g.breadth_first(edges(spark, sf), "Region:0")


def graph_shortest_path(spark, sf):
    out = g.shortest_path(nodes(spark, sf), edges(spark, sf), "Region:0", "Region:1")
    return out.select("hops", F.array_join("path_nodes", ">").alias("path_nodes"))


def graph_requests(spark, sf):
    """Every nation asks for its neighbours."""
    asked = table(spark, sf, "nation").select(F.col("n_nationkey").alias("query_id"), F.col("n_name").alias("entity"))
    return g.related_for_requests(nodes(spark, sf), edges(spark, sf), asked)


def graph_unanswered(spark, sf):
    """Nations and market segments ask; nothing in the graph is named like a segment."""
    asked = stack(table(spark, sf, "nation").select(F.col("n_name").alias("entity")),
                  table(spark, sf, "customer").select(F.col("c_mktsegment").alias("entity"))).distinct()
    asked = asked.withColumn("query_id", F.concat(F.lit("ask "), "entity"))
    return g.unanswered_requests(asked, g.related_for_requests(nodes(spark, sf), edges(spark, sf), asked))


def graph_context_lines(spark, sf):
    asked = table(spark, sf, "region").select(F.col("r_regionkey").alias("query_id"), F.col("r_name").alias("entity"))
    return graph_context(asked, nodes(spark, sf), edges(spark, sf))


def graph_merge_nodes(spark, sf):
    """Customers meet a batch with one row per order, half of them under new keys: known keys are updated, unknown ones created."""
    old = g.make_nodes(table(spark, sf, "customer"), "Customer", "c_custkey", "c_name",
                       ["c_mktsegment", "c_acctbal"])
    batch = table(spark, sf, "orders").select(
        F.lit("Customer").alias("label"), (F.col("o_custkey") + F.col("o_custkey") % 2 * 1_000_000_000).cast("string").alias("id"),
        F.lit(None).cast("string").alias("name"), "o_orderkey",
        F.create_map(F.lit("status"), "o_orderstatus", F.lit("c_acctbal"), F.lit("0")).alias("props"))
    merged = g.merge_nodes(old, batch, order="o_orderkey")
    p = F.col("props")
    return merged.select("node_key", "label", "id", "name", p["c_mktsegment"].alias("segment"),
                         p["c_acctbal"].alias("acctbal"), p["status"].alias("status"))


def graph_merge_edges(spark, sf):
    """A batch of supplier-part edges against a graph that lacks some of the parts."""
    known = nodes(spark, sf).filter((F.col("label") != "Part") | (F.col("props")["p_size"].cast("int") > 25))
    old = edges(spark, sf).filter(F.col("rel") != "SUPPLIES")
    batch = _edge(table(spark, sf, "lineitem"), _key("Supplier", "l_suppkey"), "SUPPLIES", _key("Part", "l_partkey"))
    return g.merge_edges(old, batch, known)


def graph_link_each(spark, sf):
    """Two regions are linked with every supplier."""
    return g.link_each(nodes(spark, sf), "Supplier", "COVERS", ["Region:0", "Region:1"])


def graph_duplicate_keys(spark, sf):
    by_name = g.make_nodes(table(spark, sf, "part"), "Part", None, "p_name")
    return g.duplicate_keys(by_name)


def entity_nodes(spark, sf):
    """Licence phrases of the documents as graph nodes."""
    from marlstone.catalog.text import LICENCE_PHRASES

    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = entities.extract_entities(docs, phrases=LICENCE_PHRASES, patterns={})
    out = entities.entity_nodes(found, {"LICENCE": "Regulation"})
    return out.select("label", "name", F.col("props")["source"].alias("source"))


def named_like_lines(spark, sf):
    n = g.named_like(nodes(spark, sf), "#00000000")
    return n.select(tx.graph_line(F.col("name"), F.col("label"), F.lit(None).cast("string"), F.col("id")).alias("line"))


QUERIES = {f.__name__: f for f in (
    graph_related, graph_related_all, graph_articles, graph_articles_like, graph_requirements,
    graph_requirements_optional, graph_chain, graph_subgraph, graph_coref, graph_coref_counts, graph_degree,
    graph_in_degree, graph_difference, graph_hops, graph_shortest_path, graph_requests, graph_unanswered,
    graph_context_lines,
    graph_merge_nodes, graph_merge_edges, graph_link_each, graph_duplicate_keys, entity_nodes, named_like_lines)}

_NODES = """
nodes AS (
  SELECT 'Region:' || r_regionkey AS k, 'Region' AS label, r_regionkey::VARCHAR AS id, r_name AS name, 0 AS size FROM region
  UNION ALL SELECT 'Nation:' || n_nationkey, 'Nation', n_nationkey::VARCHAR, n_name, 0 FROM nation
  UNION ALL SELECT 'Customer:' || c_custkey, 'Customer', c_custkey::VARCHAR, c_name, 0 FROM customer
  UNION ALL SELECT 'Supplier:' || s_suppkey, 'Supplier', s_suppkey::VARCHAR, s_name, 0 FROM supplier
  UNION ALL SELECT 'Part:' || p_partkey, 'Part', p_partkey::VARCHAR, p_name, p_size FROM part)"""
_EDGES = """
edges AS (
  SELECT 'Region:' || n_regionkey AS src, 'CONTAINS' AS rel, 'Nation:' || n_nationkey AS dst FROM nation
  UNION ALL SELECT 'Nation:' || s_nationkey, 'HOSTS', 'Supplier:' || s_suppkey FROM supplier
  UNION ALL SELECT 'Supplier:' || s_suppkey, 'BASED_IN', 'Nation:' || s_nationkey FROM supplier
  UNION ALL SELECT 'Customer:' || c_custkey, 'LOCATED_IN', 'Nation:' || c_nationkey FROM customer
  UNION ALL SELECT DISTINCT 'Supplier:' || l_suppkey, 'SUPPLIES', 'Part:' || l_partkey FROM lineitem)"""
_WAYS = """
ways AS (
  SELECT src AS a, dst AS b, rel, 'outgoing' AS direction FROM edges
  UNION ALL SELECT dst, src, rel, 'incoming' FROM edges WHERE src <> dst)"""
_G = f"WITH {_NODES}, {_EDGES}, {_WAYS}"
_RELATED = lambda where: f"""
{_G},
near AS (SELECT n.name AS source, n.label AS source_type, rel AS relationship, m.name AS target, m.label AS target_type,
    direction, a AS source_key, b AS target_key
  FROM ways JOIN nodes n ON n.k = a JOIN nodes m ON m.k = b WHERE {where})"""  # noqa: E731
_REQ = """
SELECT s.name AS requirement, n.id AS article_id, count(*) AS n
FROM edges e JOIN nodes p ON p.k = e.dst AND p.name = 'blue bolt' JOIN nodes s ON s.k = e.src"""


def _hops_sql(depth: int) -> str:
    parts = ["ways2 AS (SELECT DISTINCT a, b FROM ways)",
             "h0 AS (SELECT 'Region:0' AS node_key, 0 AS hops, CAST(NULL AS VARCHAR) AS parent)",
             "s0 AS (SELECT * FROM h0)"]
    for i in range(1, depth + 1):
        parts.append(f"""
h{i} AS MATERIALIZED (SELECT b AS node_key, {i} AS hops, min(a) AS parent FROM ways2 JOIN h{i - 1} ON node_key = a
  WHERE b NOT IN (SELECT node_key FROM s{i - 1}) GROUP BY b)""")
        parts.append(f"s{i} AS MATERIALIZED (SELECT * FROM s{i - 1} UNION ALL SELECT * FROM h{i})")
    return f"{_G}, " + ", ".join(parts)


_ASKED = """
found AS (SELECT q.query_id, m.name, m.label AS type, rel AS relationship, direction, b AS target_key,
    row_number() OVER (PARTITION BY q.query_id ORDER BY rel, m.name NULLS LAST, b, a, direction) AS rank
  FROM asked q JOIN nodes n ON contains(lower(n.name), lower(q.entity)) OR contains(lower(n.id), lower(q.entity))
  JOIN ways ON a = n.k JOIN nodes m ON m.k = b QUALIFY rank <= 25)"""
_PHRASES = "GNU General Public License|Apache License|General Public License|MIT License|Licensed under|Released under|License"

SQL = {
    "graph_related": f"""
{_RELATED("contains(lower(n.name), 'nation_1') OR contains(lower(n.id), 'nation_1')")}
SELECT * FROM near ORDER BY relationship, target NULLS LAST, target_key, source_key, direction LIMIT 50""",
    "graph_related_all": f"""
{_RELATED("contains(lower(n.name), 'bolt') OR contains(lower(n.id), 'bolt')")}
SELECT source, relationship, target, target_type, direction, source_key, target_key FROM near""",
    "graph_articles": f"""
{_G} SELECT src AS article_key, name AS concept FROM edges JOIN nodes ON k = dst
WHERE rel = 'SUPPLIES' AND name = 'blue bolt'""",
    "graph_articles_like": f"""
{_G} SELECT name AS concept, count(*) AS n, count(DISTINCT src) AS sources FROM edges JOIN nodes ON k = dst
WHERE rel = 'SUPPLIES' AND contains(name, 'bolt') GROUP BY name""",
    "graph_requirements": f"""
{_G} {_REQ} JOIN edges h ON h.rel = 'HOSTS' AND h.dst = e.src JOIN nodes n ON n.k = h.src
WHERE e.rel = 'SUPPLIES' GROUP BY ALL""",
    "graph_requirements_optional": f"""
{_G},
busy AS (SELECT dst FROM edges WHERE rel = 'LOCATED_IN' GROUP BY dst HAVING count(*) % 2 = 0)
{_REQ} LEFT JOIN edges h ON h.rel = 'HOSTS' AND h.dst = e.src AND h.src IN (SELECT dst FROM busy)
LEFT JOIN nodes n ON n.k = h.src WHERE e.rel = 'SUPPLIES' GROUP BY ALL""",
    "graph_chain": f"""
{_G} SELECT c.src AS n0, h.src AS n1, s.src AS n2, s.dst AS n3,
  c.src || '>' || h.src || '>' || s.src || '>' || s.dst AS path
FROM edges c JOIN edges h ON h.src = c.dst AND h.rel = 'HOSTS' JOIN edges s ON s.src = h.dst AND s.rel = 'SUPPLIES'
JOIN nodes p ON p.k = s.dst AND p.name = 'blue bolt' WHERE c.rel = 'CONTAINS'""",
    "graph_subgraph": f"""
{_G} SELECT c.src AS n0, h.src AS n1, h.dst AS n2 FROM edges c JOIN edges h ON h.src = c.dst AND h.rel = 'HOSTS'
WHERE c.rel = 'CONTAINS' ORDER BY n0, n1, n2 LIMIT 50""",
    "graph_coref": f"""
{_G} SELECT x.src AS a1, y.src AS a2, count(*) AS shared
FROM edges b JOIN edges y ON y.src = b.src AND y.rel = 'SUPPLIES' JOIN edges x ON x.dst = y.dst AND x.rel = 'SUPPLIES'
WHERE b.rel = 'BASED_IN' AND b.dst = 'Nation:7' AND x.src <> y.src GROUP BY ALL""",
    "graph_coref_counts": f"""
{_G} SELECT y.dst AS c, b.dst AS r, count(*) AS pairs
FROM edges b JOIN edges y ON y.src = b.src AND y.rel = 'SUPPLIES' JOIN edges x ON x.dst = y.dst AND x.rel = 'SUPPLIES'
WHERE b.rel = 'BASED_IN' AND x.src <> y.src GROUP BY ALL""",
    "graph_degree": f"""
{_G} SELECT a AS node_key, count(*) FILTER (direction = 'outgoing') AS outgoing,
  count(*) FILTER (direction = 'incoming') AS incoming FROM ways GROUP BY a""",
    "graph_in_degree": f"{_G} SELECT dst AS node_key, count(*) AS n FROM edges WHERE rel = 'SUPPLIES' GROUP BY dst",
    "graph_difference": f"""
{_G} SELECT DISTINCT dst AS node_key FROM edges WHERE rel = 'SUPPLIES' AND src = 'Supplier:1'
AND dst NOT IN (SELECT dst FROM edges WHERE rel = 'SUPPLIES' AND src = 'Supplier:2')""",
    "graph_hops": f"{_hops_sql(8)} SELECT node_key, hops, parent FROM s8",
    "graph_shortest_path": f"""
{_hops_sql(8)},
back AS (
  SELECT node_key, hops, parent FROM s8 WHERE node_key = 'Region:1'),
p1 AS (SELECT s.* FROM s8 s JOIN back b ON s.node_key = b.parent), p2 AS (SELECT s.* FROM s8 s JOIN p1 b ON s.node_key = b.parent),
p3 AS (SELECT s.* FROM s8 s JOIN p2 b ON s.node_key = b.parent), p4 AS (SELECT s.* FROM s8 s JOIN p3 b ON s.node_key = b.parent),
p5 AS (SELECT s.* FROM s8 s JOIN p4 b ON s.node_key = b.parent), p6 AS (SELECT s.* FROM s8 s JOIN p5 b ON s.node_key = b.parent),
p7 AS (SELECT s.* FROM s8 s JOIN p6 b ON s.node_key = b.parent), p8 AS (SELECT s.* FROM s8 s JOIN p7 b ON s.node_key = b.parent),
path AS (SELECT * FROM back UNION ALL SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3
  UNION ALL SELECT * FROM p4 UNION ALL SELECT * FROM p5 UNION ALL SELECT * FROM p6 UNION ALL SELECT * FROM p7
  UNION ALL SELECT * FROM p8)
SELECT CAST(max(hops) AS INTEGER) AS hops, string_agg(name, '>' ORDER BY hops) AS path_nodes FROM path JOIN nodes ON k = node_key""",
    "graph_requests": f"""
{_G}, asked AS (SELECT n_nationkey AS query_id, n_name AS entity FROM nation), {_ASKED} SELECT * FROM found""",
    "graph_unanswered": f"""
{_G}, asked AS (SELECT DISTINCT 'ask ' || entity AS query_id, entity FROM (SELECT n_name AS entity FROM nation
  UNION ALL SELECT c_mktsegment FROM customer)), {_ASKED}
SELECT query_id, 'No entities related to ''' || entity || ''' found.' AS info FROM asked
WHERE query_id NOT IN (SELECT query_id FROM found)""",
    "graph_context_lines": f"""
{_G}, asked AS (SELECT r_regionkey AS query_id, r_name AS entity FROM region), {_ASKED}
SELECT q.query_id, coalesce(string_agg('- ' || coalesce(f.name, '?') || ' (' || f.type || ') [' || f.relationship
  || ' / ' || f.direction || ']', chr(10) ORDER BY f.rank), '- ? (?) [? / ?]') AS context
FROM asked q LEFT JOIN found f ON f.query_id = q.query_id GROUP BY q.query_id""",
    "graph_merge_nodes": """
WITH old AS (SELECT * FROM customer),
new AS (SELECT o_custkey + o_custkey % 2 * 1000000000 AS o_custkey, arg_max(o_orderstatus, o_orderkey) AS status
  FROM orders GROUP BY ALL)
SELECT 'Customer:' || coalesce(c_custkey, o_custkey) AS node_key, 'Customer' AS label,
  coalesce(c_custkey, o_custkey)::VARCHAR AS id, c_name AS name, c_mktsegment AS segment,
  CASE WHEN o_custkey IS NULL THEN c_acctbal::VARCHAR ELSE '0' END AS acctbal, status
FROM old FULL JOIN new ON o_custkey = c_custkey""",
    "graph_merge_edges": f"""
{_G} SELECT src, rel, dst FROM edges LEFT JOIN nodes ON k = dst WHERE rel <> 'SUPPLIES' OR size > 25""",
    "graph_link_each": """
SELECT r AS src, 'COVERS' AS rel, 'Supplier:' || s_suppkey AS dst
FROM supplier, (VALUES ('Region:0'), ('Region:1')) t(r)""",
    "graph_duplicate_keys": """
SELECT 'Part' AS label, p_name AS key, count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 1""",
    "entity_nodes": f"""
SELECT DISTINCT 'Regulation' AS label, e AS name, 'spacy_extract' AS source
FROM (SELECT unnest(regexp_extract_all(text, '\\b(?:{_PHRASES})\\b')) AS e FROM documents)
WHERE e NOT IN ('Licensed under', 'Released under', 'License')""",
    "named_like_lines": f"""
{_G} SELECT '- ' || coalesce(name, '?') || ' (' || label || ') [? / ' || id || ']' AS line FROM nodes
WHERE contains(lower(name), '#00000000')""",
}
