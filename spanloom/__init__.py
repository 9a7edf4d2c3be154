"""Call-trace analytics on Spark: trace text to a fact table, and latency reports over it."""
