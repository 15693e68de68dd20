"""Operators of a training-data pipeline: decontamination, extraction,
deduplication, packing, toxicity scoring, WARC archives, language identification,
lexical search and periodic runs.

Nothing outside this package imports it.  Each module holds one operator with
its own general interface; :mod:`recoengine.llm.queries` registers the
``opN_*`` queries over the given tables.
"""
