"""DataFrame -> DataFrame operators, composed with ``df.transform``."""
