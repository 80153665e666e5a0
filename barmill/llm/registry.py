"""The queries of this package and their SQL."""

from __future__ import annotations

from barmill.llm.decontamination import OP12_SQL, op12_decontamination
from barmill.llm.exact_dedup import OP7_SQL, op7_exact_dedup
from barmill.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from barmill.llm.near_dedup import OP4_SQL, op4_near_dedup
from barmill.llm.packing import op8_packing
from barmill.llm.personal_data import op10_personal_data
from barmill.llm.prefix_trie import OP11_SQL, op11_prefix_trie
from barmill.llm.quality import op2_quality
from barmill.llm.repeated_passages import OP1_SQL, op1_repeated_passages
from barmill.llm.sentencepiece_codec import op3_sentencepiece
from barmill.llm.topk_search import OP9_SQL, op9_topk_search
from barmill.llm.toxicity import op5_toxicity
from barmill.llm.warc import OP6_SQL, op6_warc

QUERIES = {
    "op1_repeated_passages": op1_repeated_passages,
    "op2_quality": op2_quality,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_near_dedup": op4_near_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_warc": op6_warc,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_packing": op8_packing,
    "op9_topk_search": op9_topk_search,
    "op10_personal_data": op10_personal_data,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_decontamination": op12_decontamination,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE = {
    "op1_repeated_passages": OP1_SQL,
    "op4_near_dedup": OP4_SQL,
    "op6_warc": OP6_SQL,
    "op7_exact_dedup": OP7_SQL,
    "op9_topk_search": OP9_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_decontamination": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
