"""DataFrame -> DataFrame operators. Column names are arguments everywhere."""
