"""Operators of a training-data pipeline: packing, near-duplicates, search,
toxicity, sharding, mixing, language identification, line deduplication and
language-model scoring.  Nothing else in the library imports this package."""
