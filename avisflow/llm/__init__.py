"""Training-data operators: extraction, de-duplication, tokenisation, scans, scoring, mixing.

Nothing else in the library imports this subpackage; it imports general helpers only.
"""
