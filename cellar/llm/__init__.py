"""Operators of a large-scale training-data pipeline (corpus cleaning, search,
scoring, packing and sharding), each a Spark job over the ``documents`` table."""
