"""Operators for preparing training corpora, each built by one named method.

Nothing outside this folder imports it; ``__spark_entry__.py`` registers its
queries only when the folder is present.
"""
