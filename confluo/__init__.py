"""Catalogue search, score fusion and entity resolution as Spark jobs."""
