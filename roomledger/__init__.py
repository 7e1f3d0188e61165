"""Short-term-rental listings and nightly availability as Spark jobs."""
