"""Training-data operators (token store, language id, PII, quality rules, LM
scoring, suffix dedup, packing, tool-call linking, near-dedup, decontamination).

Nothing else in the library imports this subpackage; it may use the general
helpers of the library.
"""
