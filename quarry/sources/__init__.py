"""Inputs: pruned parquet table scans, feature extraction queries, and the
comma / space / tab text readers and writers."""
