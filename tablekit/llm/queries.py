"""Registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from tablekit.llm import (
    bestfit_pack,
    compress_quality,
    hash_tree_shards,
    kd_topk,
    license_scan,
    line_dedup,
    pivot_kmeans,
    ppm_langid,
    prefix_trie,
    quality_llr,
    signature_join,
    span_dedup,
    temperature_mix,
)

QUERIES = {
    "op1_quality_llr": quality_llr.op1,
    "op2_kd_topk": kd_topk.op2,
    "op3_bestfit_pack": bestfit_pack.op3,
    "op4_signature_join": signature_join.op4,
    "op5_temperature_mix": temperature_mix.op5,
    "op6_compress_quality": compress_quality.op6,
    "op7_license_scan": license_scan.op7,
    "op8_span_dedup": span_dedup.op8,
    "op9_line_dedup": line_dedup.op9,
    "op10_ppm_langid": ppm_langid.op10,
    "op11_prefix_trie": prefix_trie.op11,
    "op12_hash_tree_shards": hash_tree_shards.op12,
    "op13_pivot_kmeans": pivot_kmeans.op13,
}


def oracle() -> dict[str, str]:
    """DuckDB SQL where it can express the operator."""
    return {
        "op2_kd_topk": kd_topk.OP2_SQL,
        "op7_license_scan": license_scan.op7_sql(),
        "op9_line_dedup": line_dedup.OP9_SQL,
        "op11_prefix_trie": prefix_trie.OP11_SQL,
        "op12_hash_tree_shards": hash_tree_shards.OP12_SQL,
        "op13_pivot_kmeans": pivot_kmeans.OP13_SQL,
    }
