"""Training-data operators (chat formatting, filtering, deduplication,
tokenization, sharding, PII); nothing outside this subpackage imports it."""
