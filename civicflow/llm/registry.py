"""Registered queries of the training-data operators and their SQL oracles."""

from __future__ import annotations

from . import (bpe, conversations, edit_counts, exact, fim, neardup, pack, pii, pitman_yor, quality, simhash, urls,
               warc)

QUERIES = {
    "op1_bpe": bpe.query,
    "op2_urls": urls.query,
    "op3_quality": quality.query,
    "op4_near_dedup": neardup.query,
    "op5_language_model": pitman_yor.query,
    "op6_edit_counts": edit_counts.query,
    "op7_pack": pack.query,
    "op8_warc": warc.query,
    "op9_surrogates": pii.query,
    "op10_exact_dedup": exact.query,
    "op11_fim": fim.query,
    "op12_conversations": conversations.query,
    "op13_simhash": simhash.query,
}

#: The others have no SQL form that is exact and practical; their tests compare with brute force.
SQL = {"op2_urls": urls.SQL, "op10_exact_dedup": exact.SQL, "op11_fim": fim.SQL,
       "op12_conversations": conversations.SQL}
