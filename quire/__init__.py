"""quire: structure, chunk, check and search large collections of paged documents on Spark."""
