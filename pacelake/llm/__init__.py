"""Training-data operators: one module per operator, queries in ``catalog``.

Nothing outside this package (but ``corpus_pipeline.py`` and the guarded
import of ``__spark_entry__.py``) imports it.
"""
