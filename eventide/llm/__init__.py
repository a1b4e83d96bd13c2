"""Operators of a training-data pipeline over text corpora: quality scoring,
benchmark decontamination, archives, license and secret scans, packing,
language identification, exact search, URL filters, near-duplicates, sharding,
conversation tries and tokenizer alignment.

Nothing outside this package imports it.  In-task Python is shipped by value
(see ``eventide/__init__.py``), so executors do not need the package."""
