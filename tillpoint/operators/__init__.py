"""DataFrame -> DataFrame operators of the sales domain."""
