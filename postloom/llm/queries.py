"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from postloom.llm import exact_dedup, language_id, license_scan, mixing, near_dedup, packing, prefix_trie, quality_rules, ranked_search, repeated_bytes, sharding, toxicity, warc

QUERIES = {
    f.__name__: f
    for f in (
        exact_dedup.op1_exact_dedup,
        license_scan.op2_license_scan,
        quality_rules.op3_quality_rules,
        sharding.op4_sharding,
        warc.op5_warc,
        packing.op6_packing,
        near_dedup.op7_near_dedup,
        mixing.op8_mixing,
        language_id.op9_language_id,
        toxicity.op10_toxicity,
        ranked_search.op11_ranked_search,
        repeated_bytes.op12_repeated_bytes,
        prefix_trie.op13_prefix_trie,
    )
}


def sql() -> dict[str, str]:
    """SQL that gives the same rows, for the queries that SQL can express."""
    return {
        "op1_exact_dedup": exact_dedup.SQL,
        "op2_license_scan": license_scan.oracle(),
        "op3_quality_rules": quality_rules.SQL,
        "op5_warc": warc.SQL,
        "op7_near_dedup": near_dedup.SQL,
        "op11_ranked_search": ranked_search.SQL,
        "op12_repeated_bytes": repeated_bytes.SQL,
        "op13_prefix_trie": prefix_trie.SQL,
    }
