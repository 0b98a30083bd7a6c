"""Training-data operators: search, dedup, filtering, mixing, formatting and packing."""
