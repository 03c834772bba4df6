"""The registered queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

from . import chat, decontam, html_extract, langid, licenses, merkle, packing, phrases, pitman_yor, quality, repair, simhash, suffix_dedup
from .common import table


def op1_html_extraction(spark, sf_dir):
    return html_extract.extracted(table(spark, sf_dir, "pages"))


def op2_license_scans(spark, sf_dir):
    return licenses.scanned(table(spark, sf_dir, "documents"))


def op3_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return langid.identified(docs, langid.train(docs))


def op4_chat_formatting(spark, sf_dir):
    return chat.chat_report(table(spark, sf_dir, "conversations"))


def op5_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup.dedup_report(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op7_benchmark_decontamination(spark, sf_dir):
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_document_fingerprints(spark, sf_dir):
    return merkle.edit_report(table(spark, sf_dir, "documents"))


def op10_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark, sf_dir):
    return repair.repair_report(table(spark, sf_dir, "conversations"))


def op13_lm_scoring(spark, sf_dir):
    return pitman_yor.scores(table(spark, sf_dir, "documents"))


_ALL = (
    op1_html_extraction,
    op2_license_scans,
    op3_language_id,
    op4_chat_formatting,
    op5_suffix_array_dedup,
    op6_quality_classifier,
    op7_benchmark_decontamination,
    op8_best_fit_packing,
    op9_document_fingerprints,
    op10_simhash_near_dedup,
    op11_phrase_collocations,
    op12_conversation_repair,
    op13_lm_scoring,
)
QUERIES = {f.__name__: f for f in _ALL}
ORACLE_SQL: dict[str, str] = {"op4_chat_formatting": chat.ORACLE, "op11_phrase_collocations": phrases.ORACLE, "op12_conversation_repair": repair.ORACLE}
