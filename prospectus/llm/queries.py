"""The registered query of each operator, with its DuckDB SQL where one can be given."""

from __future__ import annotations

from . import bpe, centroids, chat, decontaminate, langid, minhash, mixing, pii, pq, prefix_trie, quality, suffix_dedup, token_output

QUERIES = {
    "op1_mix": mixing.op1_mix,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_chat": chat.op3_chat,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_minhash": minhash.op5_minhash,
    "op6_tokens": token_output.op6_tokens,
    "op7_quality": quality.op7_quality,
    "op8_pii": pii.op8_pii,
    "op9_langid": langid.op9_langid,
    "op10_vectors": pq.op10_vectors,
    "op11_bpe": bpe.op11_bpe,
    "op12_centroids": centroids.op12_centroids,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

ORACLE_SQL = {
    "op1_mix": mixing.ORACLE_SQL,
    "op3_chat": chat.ORACLE_SQL,
    "op12_centroids": centroids.ORACLE_SQL,
    "op13_prefix_trie": prefix_trie.ORACLE_SQL,
}
