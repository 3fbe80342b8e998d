"""Labelled multi-sensor well series on Spark: read, clean, fill, summarise, learn, score."""
