"""Training-data operators: mixing, quality, tokenising, deduplication, archive and URL filters.

Nothing else in the package imports this subpackage; its queries and oracle SQL are in
``recurra.llm.queries``.
"""
