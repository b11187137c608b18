"""Training-data pipeline operators (WARC, packing, dedup, classifiers, tokens, search).

Nothing outside this package, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
