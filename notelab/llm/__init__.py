"""Training-data operators: quality rules, near-duplicate joins, chunk and
line deduplication, URL filters, decontamination, sharding, packing,
toxicity scoring and secret scans.  Nothing else in the library imports
this subpackage."""
