"""Training-data operators: filters, extraction, fingerprints, tokens, mixing.

Nothing else in the library imports this subpackage; it imports general
helpers (``rillflow.session``) only.
"""
