"""The queries of this subpackage and their checks in SQL, for `__spark_entry__.py`."""

from __future__ import annotations

from tickloom.llm.decontamination import op3_decontamination
from tickloom.llm.html_labeller import op5_html_extraction
from tickloom.llm.importance import OP11_SQL, op11_importance_resampling
from tickloom.llm.jaccard_groups import op8_ngram_jaccard
from tickloom.llm.jaccard_sql import OP8_SQL, OP12_SQL
from tickloom.llm.licences import op7_licence_scan
from tickloom.llm.minhash_bayes import op12_minhash_bayes
from tickloom.llm.packing import op2_packing
from tickloom.llm.ppm import op9_ppm_score
from tickloom.llm.quality_pu import op10_quality_pu
from tickloom.llm.quality_rules import OP4_SQL, op4_quality_rules
from tickloom.llm.token_records import op1_token_records
from tickloom.llm.url_reputation import OP6_SQL, op6_url_reputation
from tickloom.llm.vector_codes import OP13_SQL, op13_vector_codes

QUERIES = {
    "op1_token_records": op1_token_records,
    "op2_packing": op2_packing,
    "op3_decontamination": op3_decontamination,
    "op4_quality_rules": op4_quality_rules,
    "op5_html_extraction": op5_html_extraction,
    "op6_url_reputation": op6_url_reputation,
    "op7_licence_scan": op7_licence_scan,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_ppm_score": op9_ppm_score,
    "op10_quality_pu": op10_quality_pu,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_minhash_bayes": op12_minhash_bayes,
    "op13_vector_codes": op13_vector_codes,
}
ORACLE_SQL = {
    "op4_quality_rules": OP4_SQL,
    "op6_url_reputation": OP6_SQL,
    "op8_ngram_jaccard": OP8_SQL,
    "op11_importance_resampling": OP11_SQL,
    "op12_minhash_bayes": OP12_SQL,
    "op13_vector_codes": OP13_SQL,
}
