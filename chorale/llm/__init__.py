"""Operators of a training-data pipeline over text, vectors and conversations.

Nothing outside this subpackage imports it. ``queries`` registers one query per
operator; ``corpus_pipeline`` at the top of the repository chains five of them.
"""
