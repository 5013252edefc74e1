"""Analytics over atomistic datasets, and operators for text corpora, on Spark."""
