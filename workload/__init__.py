"""The registered queries: market inputs derived from the driver's tables, and their SQL."""
