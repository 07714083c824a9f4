"""Operators of a large-scale training-data pipeline.

Nothing outside this package (but the driver contract and ``corpus_pipeline.py``)
imports it; it imports only general helpers of the library.
"""
