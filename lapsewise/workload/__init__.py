"""The registered queries: the operators over the given star-schema tables."""
