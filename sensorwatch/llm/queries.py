"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from .block_dedup import OP4_SQL, op4_block_dedup
from .brown_lm import op6_brown_lm
from .chat_format import OP7_SQL, op7_chat_format
from .graph_search import op13_graph_search
from .mixing import op3_entropy_mix
from .near_dedup import op8_near_dedup
from .pii_crf import op1_pii_crf
from .quality_rules import op9_quality_rules
from .resampling import OP12_SQL, op12_importance_resampling
from .secret_scan import op2_secret_scan
from .sentencepiece_bpe import op5_sentencepiece
from .token_files import op10_token_files
from .whitening import op11_whitening

QUERIES = {
    "op1_pii_crf": op1_pii_crf,
    "op2_secret_scan": op2_secret_scan,
    "op3_entropy_mix": op3_entropy_mix,
    "op4_block_dedup": op4_block_dedup,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_brown_lm": op6_brown_lm,
    "op7_chat_format": op7_chat_format,
    "op8_near_dedup": op8_near_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_token_files": op10_token_files,
    "op11_whitening": op11_whitening,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_graph_search": op13_graph_search,
}

ORACLE = {"op4_block_dedup": OP4_SQL, "op7_chat_format": OP7_SQL, "op12_importance_resampling": OP12_SQL}
