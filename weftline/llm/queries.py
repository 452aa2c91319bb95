"""The corpus operators as queries over the test tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from weftline.llm.html_text import op12_main_text
from weftline.llm.infill import OP13_SQL, op13_fill_in_middle
from weftline.llm.jaccard import op1_jaccard_join
from weftline.llm.language import op4_language_id
from weftline.llm.mixing import OP7_SQL, op7_mix_sources
from weftline.llm.pieces import op10_piece_codes
from weftline.llm.pivots import op3_pivot_near_duplicates
from weftline.llm.ranking import OP11_SQL, op11_ranked_search
from weftline.llm.repeats import op8_repetition
from weftline.llm.resample import op5_importance_resampling
from weftline.llm.secrets import OP9_SQL, op9_secret_scan
from weftline.llm.surrogates import op6_surrogates
from weftline.llm.token_counts import op2_token_counts

QUERIES = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_token_counts": op2_token_counts,
    "op3_pivot_near_duplicates": op3_pivot_near_duplicates,
    "op4_language_id": op4_language_id,
    "op5_importance_resampling": op5_importance_resampling,
    "op6_surrogates": op6_surrogates,
    "op7_mix_sources": op7_mix_sources,
    "op8_repetition": op8_repetition,
    "op9_secret_scan": op9_secret_scan,
    "op10_piece_codes": op10_piece_codes,
    "op11_ranked_search": op11_ranked_search,
    "op12_main_text": op12_main_text,
    "op13_fill_in_middle": op13_fill_in_middle,
}
ORACLES = {
    "op7_mix_sources": OP7_SQL,
    "op9_secret_scan": OP9_SQL,
    "op11_ranked_search": OP11_SQL,
    "op13_fill_in_middle": OP13_SQL,
}
