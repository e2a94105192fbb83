"""Document chunking, incremental indexing and hybrid retrieval as Spark DataFrame plans."""
