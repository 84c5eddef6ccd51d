"""Operators for large text corpora: tokens, rules, classifiers, duplicates, scoring, packing."""
