"""Training-data operators: dedup, scans, classifiers, tokenizing, sharding, archives.

Each module holds one operator; ``queries.py`` registers them.  Nothing outside this
folder (and ``corpus_pipeline.py``) imports it.
"""
