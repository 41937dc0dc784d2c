"""Queries of this package: name -> (spark, input folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pacelake.llm import decontamination
from pacelake.llm.conversations import op11_conversation_repair
from pacelake.llm.fingerprint import op2_fingerprint
from pacelake.llm.flatfiles import op8_token_counts
from pacelake.llm.jaccard import op5_jaccard_join
from pacelake.llm.language import op1_language_id
from pacelake.llm.manifest import op13_merkle_manifest
from pacelake.llm.mixing import op9_mixing
from pacelake.llm.pieces import op3_sentencepiece
from pacelake.llm.quality import op10_quality_rules
from pacelake.llm.substring import op7_substring_dedup
from pacelake.llm.tokens import op4_token_output
from pacelake.llm.toxicity import op6_toxicity

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_fingerprint": op2_fingerprint,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_token_output": op4_token_output,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_toxicity": op6_toxicity,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_mixing": op9_mixing,
    "op10_quality_rules": op10_quality_rules,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_decontamination": decontamination.op12_decontamination,
    "op13_merkle_manifest": op13_merkle_manifest,
}

#: The other contracts are not expressible in plain SQL over whole tables; the
#: tests hold their queries against brute force, a round trip or held-out rows.
ORACLE_SQL: dict[str, str] = {"op12_decontamination": decontamination.ORACLE_SQL}
