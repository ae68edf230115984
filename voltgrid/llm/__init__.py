"""Training-data operators on Spark: mixing, near-duplicates, sharding, token
files, chat formatting, language id, decontamination, repeated substrings,
personal data and quality rules. Nothing outside this subpackage imports it."""
