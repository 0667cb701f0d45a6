"""threadloom: discussion text to an evidence-grounded knowledge graph, on Spark DataFrames."""
