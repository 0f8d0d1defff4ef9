"""Which training-data queries have SQL, and that all thirteen and the pipeline are registered."""

import re

import __spark_entry__ as entry


def test_registered_queries():
    names = set(entry.LLM_QUERIES)
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names - {"pipeline"}} == set(range(1, 14)) and "pipeline" in names
    assert names <= set(entry.queries())
    assert set(entry.LLM_ORACLE_SQL) == {"op6_suffix_dedup", "op8_tool_calls", "op9_near_duplicates", "op12_prefix_trie"}
