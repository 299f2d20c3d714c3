"""Operators of a training-data pipeline: token counts, language-model
scoring, classifiers, secret scans, near and exact duplicates, mixing and
packing. Nothing else in the library imports this subpackage."""
