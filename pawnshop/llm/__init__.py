"""Training-data operators for large text corpora (near-duplicates, decontamination, ...).

Nothing outside this package imports it; ``catalog`` holds its registered queries.
"""
