"""The registered queries of the operators, one each, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from marlstone.llm import (
    contamination, extraction, language, mixing, periods, perspectives, quality, revisits, rules, simhash, tokens, urls,
    whitening)
from marlstone.llm.common import fold, table

TOKENIZER = "word_bpe_49k.json"


def op1_quality(spark, folder):
    docs = table(spark, folder, "documents")
    scored = quality.score(docs, quality.train(docs, table(spark, folder, "labels")))
    held = fold(F.col("doc_id"), quality.FOLDS) == quality.HELD_OUT_FOLD
    return scored.select("doc_id", held.alias("held_out"), "score",
                         (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op2_perspectives(spark, folder):
    return perspectives.rotate(table(spark, folder, "conversations"))


def op3_rules(spark, folder):
    return rules.judge(table(spark, folder, "documents"))


def op4_revisits(spark, folder):
    return revisits.resolve(revisits.capture_log(table(spark, folder, "pages")))


def op5_simhash(spark, folder):
    return simhash.simhash_components(table(spark, folder, "documents"))


def op6_rans(spark, folder):
    return tokens.write_and_read(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


def op7_urls(spark, folder):
    return urls.judge(table(spark, folder, "pages"))


def op8_mixture(spark, folder):
    return mixing.mixture(table(spark, folder, "documents"))


def op9_language(spark, folder):
    docs = table(spark, folder, "documents")
    found = language.identify(docs, language.train(docs))
    held = fold(F.col("doc_id"), language.FOLDS) == language.HELD_OUT_FOLD
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op10_contamination(spark, folder):
    return contamination.find_overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_whitening(spark, folder):
    return whitening.whiten(table(spark, folder, "embeddings"))


def op12_periods(spark, folder):
    return periods.digest(periods.find_runs(periods.with_planted_periods(table(spark, folder, "documents"))))


def op13_main_text(spark, folder):
    return extraction.extract(table(spark, folder, "pages"))


QUERIES = {f.__name__: f for f in (
    op1_quality, op2_perspectives, op3_rules, op4_revisits, op5_simhash, op6_rans, op7_urls, op8_mixture, op9_language,
    op10_contamination, op11_whitening, op12_periods, op13_main_text)}
SQL = {"op3_rules": rules.judge_sql()}
