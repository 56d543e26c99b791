"""The opN queries and their SQL."""

from __future__ import annotations

from foliate.llm import decontaminate, exact_dedup, htmltext, langid, lexical, linededup, media_gif, mixing, neardup, packing, periodic, quality, tokencount

QUERIES = {
    "op1_media_gif": media_gif.op1_media_gif,
    "op2_packing": packing.op2_packing,
    "op3_language_id": langid.op3_language_id,
    "op4_mixing": mixing.op4_mixing,
    "op5_token_counts": tokencount.op5_token_counts,
    "op6_quality": quality.op6_quality,
    "op7_html_text": htmltext.op7_html_text,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_near_dedup": neardup.op9_near_dedup,
    "op10_line_dedup": linededup.op10_line_dedup,
    "op11_decontamination": decontaminate.op11_decontamination,
    "op12_lexical_search": lexical.op12_lexical_search,
    "op13_periodic_runs": periodic.op13_periodic_runs,
}
ORACLES = {
    "op8_exact_dedup": exact_dedup.ORACLE,
    "op10_line_dedup": linededup.ORACLE,
    "op11_decontamination": decontaminate.ORACLE,
    "op12_lexical_search": lexical.ORACLE,
}
