"""The registered queries of the corpus operators, with production parameters."""

from __future__ import annotations

from . import decontaminate, fingerprints, jaccard_join, licenses, linededup, packing, quality, secrets, substrings, token_files
from .common import table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark, sf_dir):
    return decontaminate.find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


def op2_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), capacity=4096, end_id=1)


def op3_line_dedup(spark, sf_dir):
    return linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), removed_col="n_removed")


def op4_secret_scan(spark, sf_dir):
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark, sf_dir):
    return substrings.repeated_passages(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model, threshold=0.3)


def op7_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"), n=5, threshold=0.8, recall=0.99)


def op9_token_files(spark, sf_dir):
    root = token_files.write_token_files(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), end_id=0)
    return token_files.read_token_files(spark, root)


def op10_license_scan(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


_QUERIES = (op1_decontamination, op2_best_fit_packing, op3_line_dedup, op4_secret_scan, op5_substring_dedup, op6_quality_classifier, op7_fingerprints, op8_jaccard_join, op9_token_files, op10_license_scan)


def queries():
    return {f.__name__: f for f in _QUERIES}


def oracle_sql():
    return {}
