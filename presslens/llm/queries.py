"""The queries of the operators of this package, each over its whole table, with its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from presslens.llm import (
    conversation_repair,
    decontamination,
    fill_in_middle,
    html_extraction,
    jaccard_join,
    language_model,
    mixing,
    quality_rules,
    rule_ensemble,
    secrets,
    substring_dedup,
    toxicity,
    warc,
)
from presslens.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, directory) -> DataFrame with its equivalent SQL."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_language_model")
def op1_language_model(spark, directory):
    return language_model.score_report(table(spark, directory, "documents"))


@query("op2_substring_dedup")
def op2_substring_dedup(spark, directory):
    return substring_dedup.dedup_report(table(spark, directory, "documents"))


@query("op3_html_extraction")
def op3_html_extraction(spark, directory):
    return html_extraction.extract_pages(table(spark, directory, "pages"))


@query("op4_mixing", mixing.MIX_SQL)
def op4_mixing(spark, directory):
    return mixing.mix_report(table(spark, directory, "documents"))


@query("op5_toxicity")
def op5_toxicity(spark, directory):
    return toxicity.toxicity_report(table(spark, directory, "documents"), table(spark, directory, "labels"))


@query("op6_quality_rules")
def op6_quality_rules(spark, directory):
    return quality_rules.quality_report(table(spark, directory, "documents"), table(spark, directory, "labels"))


@query("op7_jaccard_join")
def op7_jaccard_join(spark, directory):
    return jaccard_join.join_report(table(spark, directory, "documents"))


@query("op8_decontamination")
def op8_decontamination(spark, directory):
    return decontamination.overlaps(table(spark, directory, "documents"), table(spark, directory, "benchmark"))


@query("op9_warc", warc.ARCHIVE_SQL)
def op9_warc(spark, directory):
    return warc.archive(spark, table(spark, directory, "pages"))


@query("op10_secrets", secrets.SECRETS_SQL)
def op10_secrets(spark, directory):
    return secrets.secrets_report(table(spark, directory, "documents"))


@query("op11_conversation_repair", conversation_repair.REPAIR_SQL)
def op11_conversation_repair(spark, directory):
    return conversation_repair.repair_report(conversation_repair.damaged(table(spark, directory, "conversations")))


@query("op12_rule_ensemble")
def op12_rule_ensemble(spark, directory):
    return rule_ensemble.quality_report(table(spark, directory, "documents"), table(spark, directory, "labels"))


@query("op13_fill_in_middle", fill_in_middle.DIGEST_SQL)
def op13_fill_in_middle(spark, directory):
    return fill_in_middle.digest_report(table(spark, directory, "documents"))
