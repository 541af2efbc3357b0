"""Training-data operators: formatting, extraction, scans, deduplication, decontamination, encoding."""
