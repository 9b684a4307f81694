"""Named queries, their SQL oracles, and whole pipelines."""
