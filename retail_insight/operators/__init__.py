"""DataFrame -> DataFrame operators of the six products."""
