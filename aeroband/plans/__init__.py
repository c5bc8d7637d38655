"""The models of the pipeline, its checks, and the queries that serve its results."""
