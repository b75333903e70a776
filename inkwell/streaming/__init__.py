"""Structured Streaming forms: crawl-log intake, windowed counts, the answer cache as keyed state."""
