"""DataFrame -> DataFrame operators (lazy; no actions inside, no UDFs)."""
