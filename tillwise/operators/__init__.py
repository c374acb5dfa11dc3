"""DataFrame to DataFrame steps of the warehouse."""
