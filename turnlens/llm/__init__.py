"""Operators for preparing language-model training data.

Nothing outside this folder imports it.  Queries are registered in
:mod:`turnlens.llm.queries`.
"""
