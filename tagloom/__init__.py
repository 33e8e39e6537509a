"""Analytics over annotated text corpora, on Spark: spans, tags, documents, labels and statistics as DataFrame operations."""
