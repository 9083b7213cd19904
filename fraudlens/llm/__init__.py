"""Training-data operators (tokens, decontamination, dedup, filters).

Nothing outside this package, ``corpus_pipeline.py`` and ``tests/llm``
imports it; the rest of the library works without it.
"""
