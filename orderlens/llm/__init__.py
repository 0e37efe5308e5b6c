"""Training-data operators: tokenising, extraction, archives, near duplicates, scans and scoring."""
