"""Operators for preparing training text: scans, filters, near-duplicate search, scoring and mixing.

Nothing outside this package and ``corpus_pipeline.py`` imports it.

Meanings shared by all operators here:

* A null text counts as an empty text, a null key is a key of its own (joins are null-safe).
* Rows are never merged on the way: a table with repeated rows gives one result row per input row,
  and equal rows get equal results.
* Columns an operator does not know are carried along untouched. Its own working columns start with
  two underscores; result columns replace input columns of the same name.
* Empty tables give empty results with the full set of columns.
"""
