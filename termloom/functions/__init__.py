"""Column-level building blocks: text analysis, document metadata, term weights."""
