"""Operators that prepare text for training: cleaning, duplicates, scoring, packing, search."""
