"""User-level operators: DataFrame(s) in, DataFrame out."""
