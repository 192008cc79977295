"""Training-data operators: near-duplicates, tokens, classifiers, scans.

Nothing else in the package imports this subpackage; it can be removed whole.
"""
