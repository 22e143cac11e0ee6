"""Training-data operators: mixing, scans, decontamination, near-dedup, counts,
filters and extraction.  One module per operator; ``catalog`` registers them."""
