"""Training-data operators: quality, PII, search, language, tokens, packing, URLs, joins, licences.

Self-contained: nothing else in the library imports this package.
"""
