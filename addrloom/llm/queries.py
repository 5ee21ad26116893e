"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from .bytecnn import op3_quality_cnn
from .chat import OP1_SQL, op1_chat_format
from .exact_dedup import OP6_SQL, op6_exact_dedup
from .language import op10_language_id
from .mixing import OP8_SQL, op8_mixing
from .packing import op5_packing
from .personal import op12_personal_data
from .rules import op9_quality_rules
from .runs import op11_periodic_runs
from .search import OP13_SQL, op13_treap_search
from .simhash import op7_simhash_dedup
from .toxicity import op2_toxicity
from .warc import op4_warc_zip

QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_toxicity": op2_toxicity,
    "op3_quality_cnn": op3_quality_cnn,
    "op4_warc_zip": op4_warc_zip,
    "op5_packing": op5_packing,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_mixing": op8_mixing,
    "op9_quality_rules": op9_quality_rules,
    "op10_language_id": op10_language_id,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_personal_data": op12_personal_data,
    "op13_treap_search": op13_treap_search,
}
SQL = {"op1_chat_format": OP1_SQL, "op6_exact_dedup": OP6_SQL, "op8_mixing": OP8_SQL, "op13_treap_search": OP13_SQL}
