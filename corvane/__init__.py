"""Spark-native retrieval-corpus engine: crawl frontier, chunking, BM25 and dense search, rank fusion, prompts."""
