"""Writers: CSV, vocabulary artifacts, keyed document tables."""
