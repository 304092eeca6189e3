"""Document analytics on Spark: spans, vocabularies, links, scores."""
