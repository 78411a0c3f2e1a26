"""Operators for training-data corpora: language, packing, scoring, near copies, repeats, leaks, licences, pages, quality."""
