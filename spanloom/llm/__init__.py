"""Operators for training-data pipelines: text, URL, page and embedding tables in, decisions out."""
