"""Operators that prepare text for language-model training.

Nothing else in the library imports this subpackage. ``queries`` registers one query per
operator; ``corpus_pipeline.py`` at the top of the repository chains five of them.
"""
