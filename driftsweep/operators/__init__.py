"""DataFrame -> DataFrame operators of the sweep."""
