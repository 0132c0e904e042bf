"""The registered queries of this subpackage, with SQL where SQL can tell."""

from __future__ import annotations

from tidegate.llm import chat, decontam, embedding, html, lm, merkle, minhash, mixing, pii, quality, rules, search, sharding

QUERIES = {
    "op1_embedding": embedding.query,
    "op2_quality": quality.query,
    "op3_sharding": sharding.query,
    "op4_pii": pii.query,
    "op5_lm": lm.query,
    "op6_decontam": decontam.query,
    "op7_html": html.query,
    "op8_mixing": mixing.query,
    "op9_chat": chat.query,
    "op10_minhash": minhash.query,
    "op11_rules": rules.query,
    "op12_merkle": merkle.query,
    "op13_search": search.query,
}

ORACLES = {
    "op1_embedding": embedding.ORACLE,
    "op3_sharding": sharding.ORACLE,
    "op6_decontam": decontam.ORACLE,
    "op7_html": html.ORACLE,
    "op9_chat": chat.ORACLE,
    "op10_minhash": minhash.ORACLE,
    "op11_rules": rules.ORACLE,
    "op12_merkle": merkle.ORACLE,
    "op13_search": search.ORACLE,
}
