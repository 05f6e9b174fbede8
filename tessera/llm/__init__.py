"""Operators of a training-data pipeline (URL filter, source mixing, PII,
near-duplicate joins, toxicity, nearest neighbours, quality, sharding, BPE,
language-model scores, spelling variants, conversation trie). Nothing else in the library imports this package."""
