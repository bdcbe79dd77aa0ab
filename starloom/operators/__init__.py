"""DataFrame-level operators the reference needs and Spark lacks as one call."""
