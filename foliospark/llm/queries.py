"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat_format import OP3_SQL, op3_chat_format
from .conversation_repair import OP12_SQL, op12_conversation_repair
from .decontaminate import op8_benchmark_decontamination
from .hard_negatives import OP11_SQL, op11_hard_negatives
from .language_id import op4_language_id
from .line_dedup import OP6_SQL, op6_line_dedup
from .packing import op10_packed_tokens
from .sentencepiece_codec import op9_sentencepiece
from .simhash import op5_simhash_near_dedup
from .token_counts import op1_token_counts
from .topk import OP7_SQL, op7_exact_top_k
from .toxicity import op2_toxicity
from .tree_search import op13_tree_search

QUERIES = (
    op1_token_counts, op2_toxicity, op3_chat_format, op4_language_id, op5_simhash_near_dedup,
    op6_line_dedup, op7_exact_top_k, op8_benchmark_decontamination, op9_sentencepiece, op10_packed_tokens,
    op11_hard_negatives, op12_conversation_repair, op13_tree_search,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op3_chat_format": OP3_SQL, "op6_line_dedup": OP6_SQL, "op7_exact_top_k": OP7_SQL, "op11_hard_negatives": OP11_SQL, "op12_conversation_repair": OP12_SQL}
