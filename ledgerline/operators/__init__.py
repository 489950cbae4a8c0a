"""DataFrame -> DataFrame steps of the warehouse."""
