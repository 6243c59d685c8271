"""Column functions: decoding, time, rule predicates, messages."""
