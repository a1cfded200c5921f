"""One query for each operator, and SQL where it can express the result."""

from __future__ import annotations

from stratagauge.llm import (
    ann,
    conversations,
    fim,
    htmltext,
    licences,
    linededup,
    mixing,
    neardup,
    pieces,
    quality,
    tokencount,
    toxicity,
    vectordup,
)

QUERIES = {
    "op1_mix": mixing.op1_mix,
    "op2_sentencepiece": pieces.op2_sentencepiece,
    "op3_quality": quality.op3_quality,
    "op4_line_dedup": linededup.op4_line_dedup,
    "op5_minhash_near_dedup": neardup.op5_minhash_near_dedup,
    "op6_html_text": htmltext.op6_html_text,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_license_scan": licences.op8_license_scan,
    "op9_embedding_near_dedup": vectordup.op9_embedding_near_dedup,
    "op10_ann": ann.op10_ann,
    "op11_fill_in_middle": fim.op11_fill_in_middle,
    "op12_conversation_repair": conversations.op12_conversation_repair,
    "op13_token_counts": tokencount.op13_token_counts,
}

SQL = {"op1_mix": mixing.OP1_SQL, "op8_license_scan": licences.OP8_SQL, "op11_fill_in_middle": fim.OP11_SQL}
