"""Operators for preparing training data at scale. Nothing outside this
subpackage imports it; ``corpus_pipeline.py`` at the repository top and
``__spark_entry__.py`` use it."""
