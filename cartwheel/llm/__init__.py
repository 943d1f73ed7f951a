"""Training-data operators: dedup, packing, scoring, tokenising and vector search as Spark jobs.

``registry.queries()`` holds one thin query per operator; ``corpus_pipeline.py`` at the
repository top chains five of them.
"""
