"""DataFrame operators (DataFrame -> DataFrame)."""
