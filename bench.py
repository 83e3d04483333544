"""Wall time per query on the test tables; prints one JSON line.

``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (cores), ``BENCH_QUERIES`` (names,
comma-separated; default: the headline queries below, ``all`` for every one).
Each query runs once to warm up and once for the figure, its rows fully computed
and counted by a ``noop`` write.
"""

import json
import os
import sys
import time

from marlstone import catalog
from marlstone.session import local_session

HEADLINE = (
    "chunk_fixed", "chunk_sentence", "chunk_recursive", "chunk_semantic", "parent_child", "dedup_passages",
    "token_budget", "bm25_topk", "chunk_search", "keyword_topk", "vector_topk", "cosine_topk", "rrf_fusion",
    "hybrid_retrieve", "ranker_compare", "context_text", "recall_at_5", "mrr_gain", "score_histogram",
    "latency_summary", "stg_funds", "fund_year_metrics", "dim_funds", "fact_transactions", "fund_lookup",
    "graph_related", "graph_chain", "graph_coref_counts", "graph_degree", "graph_hops", "graph_merge_edges",
    "pii_findings", "pii_redact", "pii_text_findings", "entity_extract", "conversation_state", "prompt_assembly",
    "assistant_answers", "conversation_stream", "incremental_index", "score_gap", "recall_exact", "bm25_stored",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    queries = catalog.all_queries()
    names = list(queries) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    spark = local_session(cpus, "bench")
    seconds, failed = {}, {}
    for name in names:
        try:
            for _ in range(2):
                start = time.perf_counter()
                queries[name](spark, folder).write.format("noop").mode("overwrite").save()
                seconds[name] = round(time.perf_counter() - start, 3)
        except Exception as error:  # a broken query must not hide the others
            failed[name] = str(error)[:200]
            seconds.pop(name, None)
        print(name, seconds.get(name, "failed"), file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "failed": failed, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": cpus, "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
