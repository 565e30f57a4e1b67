"""The training-data queries and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from docloom.llm.best_fit_packing import op5_best_fit_packing
from docloom.llm.bpe_codec import op10_bpe_codec
from docloom.llm.embedding_dedup import op4_embedding_dedup
from docloom.llm.ngram_join import op8_ngram_join
from docloom.llm.passage_dedup import op7_passage_dedup
from docloom.llm.quality_rules import op1_quality_rules
from docloom.llm.suffix_dedup import op2_suffix_dedup
from docloom.llm.token_counts import op6_token_counts
from docloom.llm.toxicity import op9_toxicity
from docloom.llm.url_filter import op3_url_filter, url_filter_sql

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_url_filter": op3_url_filter,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_token_counts": op6_token_counts,
    "op7_passage_dedup": op7_passage_dedup,
    "op8_ngram_join": op8_ngram_join,
    "op9_toxicity": op9_toxicity,
    "op10_bpe_codec": op10_bpe_codec,
}

ORACLE_SQL = {"op3_url_filter": url_filter_sql()}
