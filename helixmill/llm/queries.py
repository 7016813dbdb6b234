"""The subpackage's queries and the SQL that gives the same rows."""

from __future__ import annotations

from .chat_format import OP3_SQL, op3_chat_format
from .decontaminate import op6_decontaminate
from .exact_dedup import OP5_SQL, op5_exact_dedup
from .license_scan import OP4_SQL, op4_license_scan
from .quality_knn import op10_quality_knn
from .sentencepiece_scan import op2_sentencepiece
from .setsketch import op9_setsketch
from .token_counts import op8_token_counts
from .toxicity import op1_toxicity
from .url_filter import OP7_SQL, op7_url_filter

QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_sentencepiece, op3_chat_format, op4_license_scan, op5_exact_dedup,
        op6_decontaminate, op7_url_filter, op8_token_counts, op9_setsketch, op10_quality_knn,
    )
}
ORACLES = {"op3_chat_format": OP3_SQL, "op4_license_scan": OP4_SQL, "op5_exact_dedup": OP5_SQL, "op7_url_filter": OP7_SQL}
