"""The registered queries of these operators."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers

from . import (
    decontam,
    factorisation,
    html_text,
    importance,
    line_dedup,
    ngram_join,
    pieces,
    pii,
    quality,
    secret_scan,
    token_records,
    toxicity,
    whitening,
)
from .common import table


def op1_token_records(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return token_records.op1(spark, docs, public_tokenizers.path("word_bpe_49k.json"))


def op2_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.train(docs, labels))


def op3_pieces(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op4_secret_scan(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op5_ngram_join(spark, sf_dir):
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op6_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.score(docs, quality.train(docs, labels))


def op7_pii(spark, sf_dir):
    return pii.scan(table(spark, sf_dir, "documents"))


def op8_decontam(spark, sf_dir):
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_line_dedup(spark, sf_dir):
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op11_importance(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_factorisation(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return factorisation.score(docs, factorisation.train(docs, labels))


def op13_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_token_records": op1_token_records,
    "op2_toxicity": op2_toxicity,
    "op3_pieces": op3_pieces,
    "op4_secret_scan": op4_secret_scan,
    "op5_ngram_join": op5_ngram_join,
    "op6_quality": op6_quality,
    "op7_pii": op7_pii,
    "op8_decontam": op8_decontam,
    "op9_html_text": op9_html_text,
    "op10_line_dedup": op10_line_dedup,
    "op11_importance": op11_importance,
    "op12_factorisation": op12_factorisation,
    "op13_whitening": op13_whitening,
}
ORACLE_SQL: dict[str, str] = {}
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
