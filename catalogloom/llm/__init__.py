"""Training-data operators (token counts, licence scans, dedup, packing, classifiers).

Nothing outside this folder (but for ``corpus_pipeline.py``) imports it.
"""
