"""The registered queries of the text operators, and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import exact_dedup, lexical_search, quality, secret_scan
from starloom.llm.alignment import op13_alignment
from starloom.llm.chat import op1_chat_format
from starloom.llm.exact_dedup import op2_exact_dedup
from starloom.llm.html_text import op9_html_text
from starloom.llm.lexical_search import op12_ranked_search
from starloom.llm.lm_scores import op11_lm_scores
from starloom.llm.mixing import op10_mixing
from starloom.llm.packing import op5_packing
from starloom.llm.quality import op8_quality_rules
from starloom.llm.secret_scan import op7_secrets
from starloom.llm.simhash import op4_simhash
from starloom.llm.token_counts import op3_token_counts
from starloom.llm.token_files import op6_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_simhash": op4_simhash,
    "op5_packing": op5_packing,
    "op6_token_files": op6_token_files,
    "op7_secrets": op7_secrets,
    "op8_quality_rules": op8_quality_rules,
    "op9_html_text": op9_html_text,
    "op10_mixing": op10_mixing,
    "op11_lm_scores": op11_lm_scores,
    "op12_ranked_search": op12_ranked_search,
    "op13_alignment": op13_alignment,
}

# The others need a tokenizer, XXH64, a parser or a dynamic program, which SQL has not; they
# are tested against brute force or the library itself.
ORACLES: dict[str, str] = {
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op7_secrets": secret_scan.ORACLE,
    "op8_quality_rules": quality.ORACLE,
    "op12_ranked_search": lexical_search.ORACLE,
}
