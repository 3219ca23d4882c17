"""Training-data operators: near-duplicates, decontamination, formatting,
archives, privacy, toxicity, mixing and page extraction, each a Spark job.

Nothing outside this subpackage imports it.
"""
