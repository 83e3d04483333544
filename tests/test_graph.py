import random

import pytest

from marlstone.operators import entities as en
from marlstone.operators import graph as g
from marlstone.plans.knowledge_graph import load_graph
from marlstone.session import staged


@pytest.fixture(scope="module")
def graph(spark):
    make = spark.createDataFrame
    parts = dict(
        regulations=make([("R1", "Rule one", "EU", 2020), ("R2", "Rule two", "NL", 2021)],
                         "name string, full_name string, jurisdiction string, year int"),
        articles=make([("A2", 2, "R1", "Two", "second"), ("A1", 1, "R1", "One", "first"), ("A9", 9, "R9", "Nine", "lost")],
                      "id string, number int, regulation string, title string, summary string"),
        concepts=make([("cover", "d1"), ("cover plan", "d2"), ("lone", None)], "name string, definition string"),
        references=make([("A1", "cover"), ("A2", "cover"), ("A2", "cover"), ("A2", "cover plan"), ("A1", "missing")],
                        "article_id string, concept_name string"),
        funds=make([("F1", "NL", "industry", 10), ("F2", "NL", "industry", 20)],
                   "name string, country string, type string, aum_eur_bn int"),
        requirements=make([("q1", "do it", True, "A1"), ("q2", "do more", False, "A7")],
                          "name string, description string, mandatory boolean, article string"),
        applying=["q1", "q2"], defining=["R1"])
    nodes, edges = load_graph(*g.empty_graph(spark), **parts)
    return staged(nodes), staged(edges), parts


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_load_is_idempotent(graph):
    nodes, edges, parts = graph
    assert nodes.count() == 12
    kinds = dict(edges.groupBy("rel").count().collect())
    assert kinds == {"CONTAINS": 2, "REFERENCES": 3, "REQUIRES": 1, "APPLIES_TO": 4, "DEFINES": 3}
    again = load_graph(nodes, edges, **parts)
    assert again[0].count() == 12 and again[1].count() == 13
    g.require_unique(again[0])


def test_merge_updates_only_given_properties(spark, graph):
    nodes, _, _ = graph
    new = spark.createDataFrame([("PensionFund", None, "F1", {"country": "BE"}, 1), ("PensionFund", None, "F1", {"x": "1"}, 2),
                                 ("PensionFund", None, "F1", {"x": "2"}, 3)],
                                "label string, id string, name string, props map<string,string>, seq int")
    merged = g.merge_nodes(nodes, new, order="seq").filter("name = 'F1'").first()
    assert merged["props"] == {"country": "BE", "type": "industry", "aum_eur_bn": "10", "x": "2"}


def test_unique_check(spark, graph):
    nodes, _, _ = graph
    with pytest.raises(ValueError, match="F1"):
        g.require_unique(nodes.unionByName(nodes.filter("name = 'F1'")))


def test_neighbours_and_articles(graph):
    nodes, edges, _ = graph
    got = rows(g.related_entities(nodes, edges, "COVER"), "source", "relationship", "target", "direction")
    assert ("cover", "DEFINES", "R1", "incoming") in got and ("cover", "REFERENCES", None, "incoming") in got
    assert len(got) == 5
    found = g.article_rows(nodes, g.articles_for_concept(nodes, edges, "cover"))
    assert rows(found, "article_id", "number", "title") == [("A1", 1, "One"), ("A2", 2, "Two")]
    assert g.articles_for_concept(nodes, edges, "cover", exact=False).count() == 3


def test_requirements(graph):
    nodes, edges, _ = graph
    inner = rows(g.requirements_for_fund(nodes, edges, "F1"), "requirement", "mandatory", "article_id")
    assert inner == [("q1", "true", "A1")]
    outer = rows(g.requirements_for_fund(nodes, edges, "F1", optional_article=True), "requirement", "article_id")
    assert outer == [("q1", "A1"), ("q2", None)]


def test_co_references_and_their_count(graph):
    _, edges, _ = graph
    assert rows(g.co_references(edges, "Requirement:q1"), "a1", "c", "a2") == [("Article:A2", "Concept:cover", "Article:A1")]
    assert rows(g.co_reference_counts(edges), "c", "r", "pairs") == [("Concept:cover", "Requirement:q1", 1)]


def test_paths(graph):
    nodes, edges, _ = graph
    path = g.shortest_path(nodes, edges, "Concept:cover plan", "PensionFund:F1").first()
    assert (path["hops"], path["path_nodes"]) == (4, ["cover plan", "R1", "A1", "q1", "F1"])
    assert g.shortest_path(nodes, edges, "Concept:cover", "Concept:cover").first()["hops"] == 0
    assert g.shortest_path(nodes, edges, "Concept:cover", "Article:A9").count() == 0
    assert g.shortest_path(nodes, edges, "Concept:cover plan", "PensionFund:F1", max_hops=3).count() == 0
    funds = nodes.filter("label = 'PensionFund'")
    chains = g.chain(edges, ["CONTAINS", "REQUIRES", "APPLIES_TO"], funds)
    assert sorted(r["path"][-1] for r in chains.collect()) == ["PensionFund:F1", "PensionFund:F2"]


def test_loop_counts_once(spark):
    loop = spark.createDataFrame([("a", "R", "a"), ("a", "R", "b")], g.EDGES)
    assert sorted(rows(g.both_ways(loop), "a", "b", "direction")) == [
        ("a", "a", "outgoing"), ("a", "b", "outgoing"), ("b", "a", "incoming")]


def test_entities(spark):
    text = ("ABP and PFZW follow IORP III. The 105% Coverage Ratio and coverage ratios matter! "
            "An annual ORSA or a fit-and-proper test of each pension fund, not IORPs.")
    docs = spark.createDataFrame([(1, text), (2, "nothing here"), (3, None)], "doc_id long, text string")
    found = en.extract_entities(docs)
    got = [(r["text"], r["label"]) for r in found.orderBy("start_char").collect()]
    assert got == [("ABP", "PENSION_FUND"), ("PFZW", "PENSION_FUND"), ("IORP III", "REGULATION"),
                   ("105% Coverage Ratio", "METRIC"), ("coverage ratios", "METRIC"), ("annual ORSA", "REQUIREMENT"),
                   ("fit-and-proper", "REQUIREMENT"), ("pension fund", "PENSION_FUND")]
    for r in found.collect():
        assert text[r["start_char"]:r["end_char"]] == r["text"] and r["text"] in r["sentence"]
    assert found.filter("text = 'ABP'").first()["sentence"] == "ABP and PFZW follow IORP III."
    assert en.extract_entities(docs, labels=["METRIC"]).count() == 2
    assert en.entity_nodes(found).groupBy("label").count().count() == 4
    batch = {r["doc_id"]: r for r in en.batch_extract(docs.filter("text is not null")).collect()}
    assert batch[1]["preview"].endswith("...") and len(batch[1]["entities"]) == 8 and batch[2]["entities"] == []


def test_longest_match_wins_over_first():
    picked = en.find_entities("a b c d", en.Phrases([("a b", "X"), ("b c d", "Y"), ("c", "Z")]), [])
    assert picked == [(2, 7, "Y")]


def test_path_of_forty_hops(spark):
    nodes = spark.createDataFrame([(f"n{i}", "N", f"n{i}", f"n{i}", {}) for i in range(41)],
                                  "node_key string, label string, id string, name string, props map<string,string>")
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}", "R") for i in range(40)], "src string, dst string, rel string")
    assert g.shortest_path(nodes, edges, "n0", "n40").first()["hops"] == 40


def test_pairs_are_dealt_to_tasks_of_bounded_size(spark):
    from marlstone.session import dealt
    pairs = spark.range(0, 6000, 1, 2).selectExpr("id % 50 as a", "if(id % 7 = 0, null, id % 1000) as b")
    out = dealt(pairs, "a", "b", rows=100)
    assert out.rdd.getNumPartitions() == 60
    assert sorted(map(repr, out.distinct().collect())) == sorted(map(repr, pairs.distinct().collect()))


def test_coreferences_are_not_sorted(graph):
    plan = g.co_references(graph[1], "Requirement:q1")._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan


def test_requests_rank_an_edge_once_for_all_texts(spark, monkeypatch):
    """Every text is in every name: the nodes are of one kind. Keys repeat or are null, names are null, an edge is a loop, one has no end."""
    rng = random.Random(5)
    nodes = [(f"L:{i}", "L", str(i), None if i % 7 == 0 else f"xyz abcdefgh {i % 5}", {}) for i in range(60)]
    nodes += [("L:3", "M", "3", "Abc", {}), (None, "L", None, None, {}), ("L:77", "L", "77", "other", {})]
    edges = [(f"L:{rng.randrange(60)}", rng.choice("RST"), f"L:{rng.randrange(60)}") for _ in range(500)]
    edges += [("L:1", "A", "L:1"), ("L:2", "A", "L:404"), (None, "A", "L:2"), ("L:77", "R", "L:5"), ("L:77", "R", "L:5")]
    texts = [f"{a}{b}".strip() for a in ("Ab", "bc", "cd") for b in ("", "c", "d", "de")] + ["xyz ABC", "oth", "nothing", "", None, "5"]
    asked = [(i, t) for i, t in enumerate(texts)]
    written, keep = [], g.staged
    monkeypatch.setattr(g, "staged", lambda df: written.append(keep(df)) or written[-1])
    got = g.related_for_requests(
        spark.createDataFrame(nodes, g.NODES), spark.createDataFrame(edges, g.EDGES),
        spark.createDataFrame(asked, "query_id int, entity string"))
    got = sorted(rows(got, "query_id", "rank", "name", "type", "relationship", "direction", "target_key"))
    ways = [(s, d, r, "outgoing") for s, r, d in edges] + [(d, s, r, "incoming") for s, r, d in edges if s != d]
    want = []
    for q, text in asked:
        meant = {n[0] for n in nodes if n[0] and text and any(t and text.lower() in t.lower() for t in (n[3], n[2]))}
        near = [(r, n[3] is None, n[3] or "", b, a, way, n[1]) for a, b, r, way in ways if a in meant for n in nodes if n[0] and n[0] == b]
        want += [(q, i + 1, None if none else name, label, r, way, b)
                 for i, (r, none, name, b, a, way, label) in enumerate(sorted(near)[:25])]
    assert got == sorted(want)
    assert written and max(df.count() for df in written) <= 400  # 58 nodes hold up to 14 texts each


def test_messages_are_routed_once(spark):
    from marlstone.catalog.conversations import assistant_answers
    plan = assistant_answers(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "RLIKE" not in plan
