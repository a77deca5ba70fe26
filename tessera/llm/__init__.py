"""Training-data operators: token files, WARC, decontamination, de-duplication, packing, quality, PII.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
