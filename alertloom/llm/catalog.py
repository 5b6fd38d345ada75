"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from alertloom.llm.chat import OP2_SQL, op2_chat
from alertloom.llm.collocations import OP11_SQL, op11_collocations
from alertloom.llm.dac import op4_token_codes
from alertloom.llm.decontaminate import OP12_SQL, op12_decontaminate
from alertloom.llm.langid import op10_language
from alertloom.llm.minhash import op3_near_dedup
from alertloom.llm.mixing import OP5_SQL, op5_mixing
from alertloom.llm.order_minhash import op1_fingerprints
from alertloom.llm.packing import op6_packing
from alertloom.llm.prefix_trie import OP13_SQL, op13_prefix_trie
from alertloom.llm.quality import op7_quality
from alertloom.llm.toxicity import op8_toxicity
from alertloom.llm.warc import OP9_SQL, op9_warc

QUERIES = {
    f.__name__: f
    for f in (
        op1_fingerprints,
        op2_chat,
        op3_near_dedup,
        op4_token_codes,
        op5_mixing,
        op6_packing,
        op7_quality,
        op8_toxicity,
        op9_warc,
        op10_language,
        op11_collocations,
        op12_decontaminate,
        op13_prefix_trie,
    )
}

ORACLES = {
    "op2_chat": OP2_SQL,
    "op5_mixing": OP5_SQL,
    "op9_warc": OP9_SQL,
    "op11_collocations": OP11_SQL,
    "op12_decontaminate": OP12_SQL,
    "op13_prefix_trie": OP13_SQL,
}
