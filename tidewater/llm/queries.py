"""Queries of the corpus operators and the SQL that gives the same rows."""

from __future__ import annotations

from tidewater.llm.bpe import op13_bpe
from tidewater.llm.chat_format import OP8_SQL, op8_chat_format
from tidewater.llm.decontaminate import OP6_SQL, op6_decontaminate
from tidewater.llm.divergence import OP11_SQL, op11_divergence
from tidewater.llm.jaccard_join import op2_jaccard_join
from tidewater.llm.license_scan import OP1_SQL, op1_license_scan
from tidewater.llm.lm_score import op5_lm_score
from tidewater.llm.merkle import OP12_SQL, op12_merkle
from tidewater.llm.mixing import OP3_SQL, op3_mix_sources
from tidewater.llm.oracles import OP2_SQL, OP9_SQL
from tidewater.llm.quality_classifier import op10_quality_classifier
from tidewater.llm.quality_rules import op4_quality_rules
from tidewater.llm.suffix_dedup import op9_suffix_dedup
from tidewater.llm.toxicity import op7_toxicity

QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_jaccard_join, op3_mix_sources, op4_quality_rules, op5_lm_score,
    op6_decontaminate, op7_toxicity, op8_chat_format, op9_suffix_dedup, op10_quality_classifier,
    op11_divergence, op12_merkle, op13_bpe)}

ORACLES = {"op1_license_scan": OP1_SQL, "op2_jaccard_join": OP2_SQL, "op3_mix_sources": OP3_SQL,
           "op6_decontaminate": OP6_SQL, "op8_chat_format": OP8_SQL, "op9_suffix_dedup": OP9_SQL,
           "op11_divergence": OP11_SQL, "op12_merkle": OP12_SQL}
