"""The queries of the training-data operators and their SQL, for __spark_entry__."""

from __future__ import annotations

from . import html_text, jaccard, langid, packing, pieces, quality, sharding, token_file, topk, warc

QUERIES = {
    "op1_token_file": token_file.op1_token_file,
    "op2_warc": warc.op2_warc,
    "op3_sentence_pieces": pieces.op3_sentence_pieces,
    "op4_language_id": langid.op4_language_id,
    "op5_quality_rules": quality.op5_quality_rules,
    "op6_packing": packing.op6_packing,
    "op7_html_text": html_text.op7_html_text,
    "op8_exact_top_k": topk.op8_exact_top_k,
    "op9_sharding": sharding.op9_sharding,
    "op10_ngram_jaccard": jaccard.op10_ngram_jaccard,
}
ORACLE_SQL = {"op2_warc": warc.OP2_SQL, "op5_quality_rules": quality.OP5_SQL, "op8_exact_top_k": topk.OP8_SQL, "op9_sharding": sharding.OP9_SQL}
