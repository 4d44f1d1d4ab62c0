"""Queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from sievemill.llm.byte_bpe import op11_byte_bpe
from sievemill.llm.language_model import op10_language_model
from sievemill.llm.lexical import OP13_SQL, op13_lexical_search
from sievemill.llm.line_dedup import OP5_SQL, op5_line_dedup
from sievemill.llm.mixing import OP1_SQL, op1_mixing
from sievemill.llm.nearest import op3_nearest
from sievemill.llm.ngram_join import op6_ngram_join
from sievemill.llm.packing import op9_packing
from sievemill.llm.quality import OP7_SQL, op7_quality
from sievemill.llm.runs import op12_runs
from sievemill.llm.secrets import OP8_SQL, op8_secrets

from sievemill.llm.tokens import op2_token_counts
from sievemill.llm.substrings import op4_substrings

QUERIES = {f.__name__: f for f in (op1_mixing, op2_token_counts, op3_nearest, op4_substrings, op5_line_dedup, op6_ngram_join, op7_quality, op8_secrets, op9_packing, op10_language_model, op11_byte_bpe, op12_runs, op13_lexical_search)}
ORACLE_SQL: dict[str, str] = {"op1_mixing": OP1_SQL, "op5_line_dedup": OP5_SQL, "op7_quality": OP7_SQL, "op8_secrets": OP8_SQL, "op13_lexical_search": OP13_SQL}
