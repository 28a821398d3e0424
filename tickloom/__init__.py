"""Market-data analytics as plain ``DataFrame -> DataFrame`` functions."""
