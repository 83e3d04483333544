"""Loading the regulation graph in its order: nodes first, then the edges between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.operators import graph as g
from marlstone.session import stack


def load_graph(nodes: DataFrame, edges: DataFrame, *, regulations: DataFrame, articles: DataFrame,
               concepts: DataFrame, references: DataFrame, funds: DataFrame, requirements: DataFrame,
               applying: list[str] | None = None, defining: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Merge a batch into the graph; loading the same batch again changes nothing.

    ``articles`` names its ``regulation``, ``requirements`` its ``article``,
    ``references`` has ``article_id, concept_name``. Every requirement named in
    ``applying`` applies to every fund, and every regulation in ``defining``
    defines every concept.
    """
    reg = g.make_nodes(regulations, "Regulation", None, "name", ["full_name", "jurisdiction", "year"])
    art = g.make_nodes(articles, "Article", "id", None, ["number", "title", "summary"])
    con = g.make_nodes(concepts, "Concept", None, "name", ["definition"])
    fund = g.make_nodes(funds, "PensionFund", None, "name", ["country", "type", "aum_eur_bn"])
    req = g.make_nodes(requirements, "Requirement", None, "name", ["description", "mandatory"])
    nodes = g.merge_nodes(nodes, stack(reg, art, con, fund, req))

    def key(label: str, column: str):
        return F.concat(F.lit(f"{label}:"), F.col(column).cast("string"))

    def edge(df: DataFrame, src, rel: str, dst) -> DataFrame:
        return df.select(src.alias("src"), F.lit(rel).alias("rel"), dst.alias("dst"))

    incoming = [
        edge(articles, key("Regulation", "regulation"), "CONTAINS", key("Article", "id")),
        edge(references, key("Article", "article_id"), "REFERENCES", key("Concept", "concept_name")),
        edge(requirements, key("Article", "article"), "REQUIRES", key("Requirement", "name")),
    ]
    if applying:
        incoming.append(g.link_each(nodes, "PensionFund", "APPLIES_TO", [f"Requirement:{r}" for r in applying]))
    if defining:
        incoming.append(g.link_each(nodes, "Concept", "DEFINES", [f"Regulation:{r}" for r in defining]))
    return nodes, g.merge_edges(edges, stack(*incoming), nodes)
