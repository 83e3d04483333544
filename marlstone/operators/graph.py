"""A property graph as two tables.

``nodes(node_key, label, id, name, props)`` with ``node_key = label:id`` (or
``label:name`` without an id) and ``edges(src, rel, dst)`` over node keys.
Patterns are equi-joins written from their selective end.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions import text as tx
from marlstone.operators.patterns import contained_lists
from marlstone.operators.ranking import top_k, without_late
from marlstone.session import looked_up, stack, staged

NODE_COLUMNS = ("node_key", "label", "id", "name", "props")
NODES = "node_key string, label string, id string, name string, props map<string,string>"
EDGES = "src string, rel string, dst string"


def node_key(label: Column, id_: Column, name: Column) -> Column:
    return F.concat(label, F.lit(":"), F.coalesce(id_, name))


def make_nodes(df: DataFrame, label: str, id_: str | None, name: str | None, props: list[str] = ()) -> DataFrame:
    """Rows of any table as nodes."""
    i = F.col(id_).cast("string") if id_ else F.lit(None).cast("string")
    n = F.col(name).cast("string") if name else F.lit(None).cast("string")
    pairs = [x for p in props for x in (F.lit(p), F.col(p).cast("string"))]
    bag = F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull()) if pairs else F.create_map()
    return df.select(node_key(F.lit(label), i, n).alias("node_key"), F.lit(label).alias("label"),
                     i.alias("id"), n.alias("name"), bag.cast("map<string,string>").alias("props"))


def empty_graph(spark) -> tuple[DataFrame, DataFrame]:
    return spark.createDataFrame([], NODES), spark.createDataFrame([], EDGES)


def merge_nodes(nodes: DataFrame, incoming: DataFrame, order: str | None = None) -> DataFrame:
    """Create nodes by key or update only the properties given.

    Repeated keys inside ``incoming`` are merged property by property, the last
    by ``order`` winning (without ``order``: the largest value), before anything
    is joined, so a key with very many rows is reduced in the tasks that read it.
    """
    if "node_key" not in incoming.columns:
        incoming = incoming.withColumn("node_key", node_key(F.col("label"), F.col("id"), F.col("name")))
    heads = incoming.groupBy("node_key").agg(F.max("label").alias("label"), F.max("id").alias("id"),
                                             F.max("name").alias("name"))
    last = F.col(order) if order else F.col("v")
    values = (
        incoming.select("node_key", *([order] if order else []), F.explode("props").alias("p", "v"))
        .groupBy("node_key", "p").agg(F.max_by("v", F.struct(last, F.col("v"))).alias("v"))
        .groupBy("node_key").agg(F.map_from_entries(F.collect_list(F.struct("p", "v"))).alias("new"))
    )
    fresh = heads.join(values, "node_key", "left")
    none = F.create_map().cast("map<string,string>")
    old = nodes.select("node_key", *[F.col(c).alias(f"old_{c}") for c in NODE_COLUMNS[1:]])
    both = old.join(fresh, "node_key", "full_outer")
    new = F.coalesce("new", none)
    kept = F.map_filter(F.coalesce("old_props", none), lambda k, v: ~F.map_contains_key(new, k))
    return both.select(
        "node_key",
        *[F.coalesce(f"old_{c}", c).alias(c) for c in ("label", "id", "name")],
        F.map_concat(kept, new).alias("props"))


def merge_edges(edges: DataFrame, incoming: DataFrame, nodes: DataFrame) -> DataFrame:
    """Add edges once each; an edge without both end nodes is left out."""
    keys = nodes.select("node_key")
    whole = (
        incoming.select("src", "rel", "dst").distinct()
        .join(keys.withColumnRenamed("node_key", "src"), "src", "left_semi")
        .join(keys.withColumnRenamed("node_key", "dst"), "dst", "left_semi")
        .select("src", "rel", "dst")
    )
    return stack(edges.select("src", "rel", "dst"), whole).distinct()


def link_each(nodes: DataFrame, label: str, rel: str, sources: list[str]) -> DataFrame:
    """An edge from each named source node to every node of a label.

    The sources are a short list given by the caller, so the work is one pass
    over the nodes; two open-ended labels are never multiplied with each other.
    """
    src = F.explode(F.array(*[F.lit(s) for s in sources]))
    return nodes.filter(F.col("label") == label).select(
        src.alias("src"), F.lit(rel).alias("rel"), F.col("node_key").alias("dst"))


def duplicate_keys(nodes: DataFrame) -> DataFrame:
    """``(label, key, n)`` for keys that more than one node row has."""
    return nodes.groupBy("label", F.coalesce("id", "name").alias("key")).agg(F.count("*").alias("n")).filter("n > 1")


def require_unique(nodes: DataFrame) -> None:
    """Raise when a key is not unique, naming some of the keys."""
    bad = [f"{r['label']}:{r['key']} ({r['n']})" for r in duplicate_keys(nodes).limit(10).collect()]
    if bad:
        raise ValueError(f"node keys are not unique: {', '.join(bad)}")


def both_ways(edges: DataFrame) -> DataFrame:
    """``(a, b, rel, direction)``: every edge seen from both ends, a loop once."""
    out = F.struct(F.col("src").alias("a"), F.col("dst").alias("b"), F.lit("outgoing").alias("direction"))
    back = F.struct(F.col("dst").alias("a"), F.col("src").alias("b"), F.lit("incoming").alias("direction"))
    ends = F.when(F.col("src") == F.col("dst"), F.array(out)).otherwise(F.array(out, back))
    return edges.select("rel", F.explode(ends).alias("e")).select("e.a", "e.b", "rel", "e.direction")


def _ends(nodes: DataFrame, key: str, prefix: str, *columns: str) -> DataFrame:
    return nodes.select(F.col("node_key").alias(key), *[F.col(c).alias(f"{prefix}{c}") for c in columns])


def named_like(nodes: DataFrame, text: str) -> DataFrame:
    """Nodes whose name or id contains a text in any case."""
    return nodes.filter(tx.contains_ignore_case("name", F.lit(text)) | tx.contains_ignore_case("id", F.lit(text)))


def neighbours(nodes: DataFrame, edges: DataFrame, start: DataFrame) -> DataFrame:
    """All edges of the ``start`` nodes, seen from them."""
    return (
        both_ways(edges)
        .join(_ends(start, "a", "source_", "name", "label"), "a")
        .join(_ends(nodes, "b", "target_", "name", "label"), "b")
        .select(F.col("source_name").alias("source"), F.col("source_label").alias("source_type"),
                F.col("rel").alias("relationship"), F.col("target_name").alias("target"),
                F.col("target_label").alias("target_type"), "direction",
                F.col("a").alias("source_key"), F.col("b").alias("target_key"))
    )


def related_entities(nodes: DataFrame, edges: DataFrame, text: str, limit: int | None = 50) -> DataFrame:
    """Neighbours of the nodes named like ``text``, ordered by relationship and target."""
    found = neighbours(nodes, edges, named_like(nodes, text)).orderBy(
        "relationship", F.asc_nulls_last("target"), "target_key", "source_key", "direction")
    return found if limit is None else found.limit(limit)


def _placed(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(node_key, place, asked)``: the keys numbered by name and key, and the texts ``_e`` that their names or ids contain.

    A key that comes more than once has the place of its first name; ``asked`` is null where no text is contained.
    """
    names = nodes.select("node_key", F.explode(F.array_compact(F.array(F.lower("name"), F.lower("id")))).alias("_t"))
    meant = contained_lists(names, ["node_key"], "_t", wanted, "_e")
    first = F.struct(F.col("name").isNull().alias("none"), "name")
    rows = stack(nodes.select("node_key", first.alias("first"), F.lit(None).cast("array<string>").alias("_e")),
                 meant.select("node_key", F.lit(None).cast("struct<none:boolean,name:string>").alias("first"), "_e"))
    keys = rows.filter(F.col("node_key").isNotNull()).groupBy("node_key").agg(
        F.min("first").alias("first"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("_e")))).alias("asked"))
    return keys.orderBy("first", "node_key").select(
        "node_key", F.monotonically_increasing_id().alias("place"), F.when(F.size("asked") > 0, F.col("asked")).alias("asked"))


def related_for_requests(nodes: DataFrame, edges: DataFrame, requests: DataFrame, entity: str = "entity",
                         key: str = "query_id", limit: int = 25) -> DataFrame:
    """For each request: up to ``limit`` neighbours ``name, type, relationship, direction`` with a rank.

    All distinct request texts are searched in each name and id at once. Nodes that contain the same texts are
    of one kind: an edge is ranked once for its kind, by numbers, and only a kind's first rows are given to each of its texts.
    """
    keys = staged(_placed(nodes, requests.select(F.lower(entity).alias("_e")).distinct()))
    kinds = staged(keys.filter(F.col("asked").isNotNull()).groupBy("asked").agg(F.min("place").alias("kind")))
    starts = staged(keys.join(kinds, "asked").select(F.col("node_key").alias("a"), F.col("place").alias("source"), "kind"))
    ends = keys.select(F.col("node_key").alias("b"), F.col("place").alias("target"))
    near = both_ways(edges).join(looked_up(starts), "a").join(looked_up(ends), "b").select(
        "kind", F.col("rel").alias("relationship"), "target", "source", "direction")
    # All rows of the target that fills a kind's list are kept: among them the order of the sources decides.
    near = without_late(near, limit, "kind", "relationship", "target")
    few = staged(near.withColumn("_r", F.rank().over(Window.partitionBy("kind").orderBy("relationship", "target"))).filter(
        F.col("_r") <= limit).drop("_r"))
    named = lambda place, c: keys.select(F.col("place").alias(place), F.col("node_key").alias(c))
    rows = few.join(named("target", "target_key"), "target").join(named("source", "source_key"), "source").join(
        _ends(nodes, "target_key", "", "name", "label"), "target_key")
    order = (F.col("relationship"), F.asc_nulls_last("name"), F.col("target_key"), F.col("source_key"), F.col("direction"))
    rows = top_k(rows, limit, *order, per=("kind",)).join(kinds, "kind").select(
        F.explode("asked").alias("_e"), "name", F.col("label").alias("type"), "relationship", "direction", "target_key", "source_key")
    few = top_k(rows, limit, *order, per=("_e",))
    return requests.select(key, F.lower(entity).alias("_e")).join(few, "_e").drop("_e", "source_key")


def unanswered_requests(requests: DataFrame, found: DataFrame, entity: str = "entity", key: str = "query_id") -> DataFrame:
    """``key, info`` of every request that ``related_for_requests`` found nothing for."""
    info = F.concat(F.lit("No entities related to '"), F.coalesce(entity, F.lit("")), F.lit("' found."))
    return requests.join(found.select(key), key, "left_anti").select(key, info.alias("info"))


def articles_for_concept(nodes: DataFrame, edges: DataFrame, concept: str, exact: bool = True,
                         rel: str = "REFERENCES") -> DataFrame:
    """``(article_key, concept)`` of nodes that point to a concept by exact name or by substring."""
    name = F.col("name")
    meant = nodes.filter(name == concept) if exact else nodes.filter(F.contains(name, F.lit(concept)))
    return edges.filter(F.col("rel") == rel).join(
        meant.select(F.col("node_key").alias("dst"), name.alias("concept")), "dst").select(
        F.col("src").alias("article_key"), "concept")


def article_rows(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """Article properties of ``articles_for_concept``, by number."""
    props = F.col("props")
    return found.join(nodes.withColumnRenamed("node_key", "article_key"), "article_key").select(
        F.col("id").alias("article_id"), props["number"].cast("int").alias("number"),
        props["title"].alias("title"), props["summary"].alias("summary"), "concept").orderBy("number", "article_id")


def requirements_for_fund(nodes: DataFrame, edges: DataFrame, fund: str, optional_article: bool = False,
                          applies: str = "APPLIES_TO", requires: str = "REQUIRES") -> DataFrame:
    """Requirements that apply to a fund and the articles that require them."""
    fund_key = nodes.filter(F.col("name") == fund).select(F.col("node_key").alias("dst"))
    req = edges.filter(F.col("rel") == applies).join(fund_key, "dst").select(F.col("src").alias("req"))
    by = edges.filter(F.col("rel") == requires).select(F.col("src").alias("article"), F.col("dst").alias("req"))
    with_article = req.join(by, "req", "left" if optional_article else "inner")
    props = F.col("props")
    return (
        with_article.join(nodes.withColumnRenamed("node_key", "req"), "req")
        .select(F.col("name").alias("requirement"), props["description"].alias("description"),
                props["mandatory"].alias("mandatory"), "article")
        .join(_ends(nodes, "article", "article_", "id"), "article", "left")
        .select("requirement", "description", "mandatory", "article_id")
        .orderBy("requirement", "article_id")
    )


def co_references(edges: DataFrame, requirement_key: str, refers: str = "REFERENCES",
                  requires: str = "REQUIRES") -> DataFrame:
    """``(a1, c, a2, r)``: other sources that point to a concept of a source that requires ``r``.

    Starts from the one requirement, so only its own sources and their concepts
    are widened; every returned row is an answer row. Those concepts are looked up
    by hash, so the edges that meet them are not sorted.
    """
    ref = edges.filter(F.col("rel") == refers)
    a2 = edges.filter((F.col("rel") == requires) & (F.col("dst") == requirement_key)).select(
        F.col("src").alias("a2"), F.col("dst").alias("r"))
    concepts = ref.join(a2, ref.src == a2.a2).select("a2", "r", F.col("dst").alias("c")).hint("shuffle_hash")
    return ref.select(F.col("src").alias("a1"), F.col("dst").alias("c")).join(concepts, "c").filter(
        F.col("a1") != F.col("a2")).select("a1", "c", "a2", "r")


def co_reference_counts(edges: DataFrame, refers: str = "REFERENCES", requires: str = "REQUIRES") -> DataFrame:
    """``(c, r, pairs)``: how many ``(a1, a2)`` the co-reference pattern has, without building the pairs.

    A source ``a2`` of concept ``c`` that requires ``r`` meets every other source of ``c``.
    """
    ref = edges.filter(F.col("rel") == refers).select(F.col("src").alias("a"), F.col("dst").alias("c"))
    req = edges.filter(F.col("rel") == requires).select(F.col("src").alias("a"), F.col("dst").alias("r"))
    sources = ref.groupBy("c").agg(F.count("*").alias("sources"))
    both = ref.join(req, "a").groupBy("c", "r").agg(F.count("*").alias("a2s"))
    return both.join(sources, "c").select("c", "r", (F.col("a2s") * (F.col("sources") - 1)).alias("pairs")).filter(
        "pairs > 0")


def chain(edges: DataFrame, rels: list[str], ends: DataFrame | None = None) -> DataFrame:
    """All paths along a fixed list of relationships: columns ``n0 .. nk`` and ``path``.

    ``ends`` (a ``node_key`` table) restricts the last node; the joins then run
    from that end backwards.
    """
    last = len(rels)
    step = lambda i: edges.filter(F.col("rel") == rels[i]).select(
        F.col("src").alias(f"n{i}"), F.col("dst").alias(f"n{i + 1}"))
    out = step(last - 1)
    if ends is not None:
        out = out.join(ends.select(F.col("node_key").alias(f"n{last}")), f"n{last}", "left_semi")
    for i in range(last - 2, -1, -1):
        out = out.join(step(i), f"n{i + 1}")
    names = [f"n{i}" for i in range(last + 1)]
    return out.select(*names, F.array(*names).alias("path"))


def degrees(edges: DataFrame) -> DataFrame:
    """``(node_key, outgoing, incoming)`` for every node that has an edge."""
    return both_ways(edges).groupBy(F.col("a").alias("node_key")).agg(
        F.count_if(F.col("direction") == "outgoing").alias("outgoing"),
        F.count_if(F.col("direction") == "incoming").alias("incoming"))


def in_degree(edges: DataFrame, rel: str) -> DataFrame:
    """``(node_key, n)``: how often a node is the target of a relationship."""
    return edges.filter(F.col("rel") == rel).groupBy(F.col("dst").alias("node_key")).agg(F.count("*").alias("n"))


def reachable_difference(edges: DataFrame, a: str, b: str, rel: str) -> DataFrame:
    """``(node_key)`` that ``a`` points to and ``b`` does not."""
    of = lambda k: edges.filter((F.col("rel") == rel) & (F.col("src") == k)).select(
        F.col("dst").alias("node_key"))
    return of(a).join(of(b), "node_key", "left_anti").distinct()


def breadth_first(edges: DataFrame, source: str, max_hops: int | None = None, target: str | None = None) -> DataFrame:
    """``(node_key, hops, parent)`` of every node that ``source`` reaches, edges taken both ways.

    ``parent`` is the smallest neighbour that is one hop nearer. Each hop is one
    join of the frontier (one row per node) with the edges, written to shared
    storage before the next. Stops when ``target`` is reached or nothing is new, or
    after ``max_hops`` if the caller sets a bound.
    """
    spark = edges.sparkSession
    ways = staged(both_ways(edges).select("a", "b"))
    seen = staged(spark.createDataFrame([(source, 0, None)], "node_key string, hops int, parent string"))
    frontier = seen
    for hop in count(1) if max_hops is None else range(1, max_hops + 1):
        new = (
            ways.join(frontier.select(F.col("node_key").alias("a")), "a")
            .groupBy(F.col("b").alias("node_key")).agg(F.min("a").alias("parent"))
            .join(seen.select("node_key"), "node_key", "left_anti")
            .select("node_key", F.lit(hop).alias("hops"), "parent")
        )
        frontier = staged(new)
        if frontier.isEmpty():
            break
        seen = stack(seen, frontier)
        if target is not None and not frontier.filter(F.col("node_key") == target).isEmpty():
            break
    return seen


def shortest_path(nodes: DataFrame, edges: DataFrame, source: str, target: str, max_hops: int | None = None) -> DataFrame:
    """One row ``(hops, path_nodes)`` of names (ids where a node has no name); empty when not connected."""
    spark = nodes.sparkSession
    seen = breadth_first(edges, source, max_hops, target)
    path = [target]
    row = seen.filter(F.col("node_key") == target).first()
    if row is None:
        return spark.createDataFrame([], "hops int, path_nodes array<string>")
    while row["parent"] is not None:
        path.append(row["parent"])
        row = seen.filter((F.col("node_key") == row["parent"]) & (F.col("hops") == row["hops"] - 1)).first()
    steps = spark.createDataFrame(list(enumerate(reversed(path))), "pos int, node_key string")
    named = steps.join(nodes, "node_key").select("pos", F.coalesce("name", "id").alias("n"))
    return named.agg((F.count("*") - 1).cast("int").alias("hops"), F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "n"))), lambda s: s["n"]).alias("path_nodes"))
