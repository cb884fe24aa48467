"""Document intake on Spark: match, place and version documents by content."""
