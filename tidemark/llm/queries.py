"""Registered queries of this subpackage and the SQL restatements of those that SQL can express."""

from __future__ import annotations

from tidemark.llm.bpe import op13_bpe
from tidemark.llm.decontam import OP2_SQL, op2_decontam
from tidemark.llm.negatives import OP11_SQL, op11_negatives
from tidemark.llm.ordinal import op10_ordinal
from tidemark.llm.packing import op9_packing
from tidemark.llm.periodic import op12_runs
from tidemark.llm.privacy import op7_privacy
from tidemark.llm.recompression import op1_recompression
from tidemark.llm.rules import op8_rules
from tidemark.llm.simhash import op6_simhash
from tidemark.llm.suffixes import op3_suffixes
from tidemark.llm.toxicity import op5_toxicity
from tidemark.llm.warc import OP4_SQL, op4_warc

QUERIES = {
    "op1_recompression": op1_recompression,
    "op2_decontam": op2_decontam,
    "op3_suffixes": op3_suffixes,
    "op4_warc": op4_warc,
    "op5_toxicity": op5_toxicity,
    "op6_simhash": op6_simhash,
    "op7_privacy": op7_privacy,
    "op8_rules": op8_rules,
    "op9_packing": op9_packing,
    "op10_ordinal": op10_ordinal,
    "op11_negatives": op11_negatives,
    "op12_runs": op12_runs,
    "op13_bpe": op13_bpe,
}

ORACLES: dict[str, str] = {
    "op2_decontam": OP2_SQL,
    "op4_warc": OP4_SQL,
    "op11_negatives": OP11_SQL,
}
