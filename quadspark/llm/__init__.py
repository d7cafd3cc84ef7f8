"""Training-data operators: archives, extraction, deduplication, safety, mixing and tokenisation as Spark jobs."""
