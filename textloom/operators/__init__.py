"""DataFrame to DataFrame operators; all take column names and keep other columns unless they say otherwise."""
