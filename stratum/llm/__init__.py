"""Training-data operators (quality, dedup, search, secrets, decontamination, WARC, URLs, licenses, packing).

Nothing else in ``stratum`` imports this subpackage; ``queries.py`` holds the registered queries.
"""
