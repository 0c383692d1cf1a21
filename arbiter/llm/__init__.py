"""Training-data operators: cleaning, de-duplication, extraction, scoring, mixing, encoding."""
