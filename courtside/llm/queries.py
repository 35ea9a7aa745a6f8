"""The registered queries of the operators, and SQL that gives the same rows where SQL can."""

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from courtside.llm import (
    bpe,
    embedding_dedup,
    exact_dedup,
    fim,
    jaccard_join,
    language_id,
    merkle,
    mixing,
    neighbours,
    quality,
    token_files,
    toxicity,
    warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": jaccard_join.op1_ngram_jaccard_join,
    "op2_warc_records": warc.op2_warc_records,
    "op3_bpe_encode_decode": bpe.op3_bpe_encode_decode,
    "op4_mix_sources": mixing.op4_mix_sources,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_embedding_dedup": embedding_dedup.op6_embedding_dedup,
    "op7_quality_classifier": quality.op7_quality_classifier,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_token_id_files": token_files.op9_token_id_files,
    "op10_language_id": language_id.op10_language_id,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_fill_in_middle": fim.op12_fill_in_middle,
    "op13_nearest_neighbours": neighbours.op13_nearest_neighbours,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": jaccard_join.ORACLE,
    "op2_warc_records": warc.ORACLE,
    "op4_mix_sources": mixing.ORACLE,
    "op8_exact_dedup": exact_dedup.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
    "op12_fill_in_middle": fim.ORACLE,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
