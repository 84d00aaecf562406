"""Operators for large-scale text corpora: de-duplication, quality rules,
secret and licence scans, source mixing, packing and token-ID output.

Each module holds one operator with a general interface on DataFrames;
``queries.py`` holds the thin registered queries over the driver's tables.
Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
