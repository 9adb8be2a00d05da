"""The queries of this package and, where SQL can say it, their DuckDB SQL."""

from __future__ import annotations

from feedkit.llm import bpe, chat, exact_dedup, host_rules, langid, line_templates, mixing, near_dedup, ranked_search, secrets, signature_trees, warc, whitening

QUERIES = {
    "op1_secrets": secrets.op1_secrets,
    "op2_host_rules": host_rules.op2_host_rules,
    "op3_warc": warc.op3_warc,
    "op4_chat": chat.op4_chat,
    "op5_bpe": bpe.op5_bpe,
    "op6_mixing": mixing.op6_mixing,
    "op7_line_templates": line_templates.op7_line_templates,
    "op8_langid": langid.op8_langid,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_near_dedup": near_dedup.op10_near_dedup,
    "op11_whitening": whitening.op11_whitening,
    "op12_ranked_search": ranked_search.op12_ranked_search,
    "op13_signature_trees": signature_trees.op13_signature_trees,
}

SQL = {
    "op2_host_rules": host_rules.SQL,
    "op3_warc": warc.SQL,
    "op4_chat": chat.SQL,
    "op9_exact_dedup": exact_dedup.SQL,
    "op12_ranked_search": ranked_search.SQL,
}
