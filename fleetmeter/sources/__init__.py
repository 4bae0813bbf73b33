"""Raw streams, message decoding and the example streams derived from the ``events`` table."""
