"""Operations on training text: classifiers, fingerprints, near duplicates, tokens, language model, packing.

Nothing outside this subpackage, ``corpus_pipeline.py`` and ``tests/llm`` imports it.
"""
