"""Training-data operators: tokenised records, URL reputation, toxicity, main text, exact and near
deduplication, source mixing, packing, fingerprints and line deduplication.

Each module holds one operator; ``queries`` registers them. Nothing outside this package imports it.
"""
