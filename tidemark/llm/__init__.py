"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage; deleting it together with
``corpus_pipeline.py`` leaves the snapshot engine untouched.
"""
