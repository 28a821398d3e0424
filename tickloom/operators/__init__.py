"""Windows, facts, indicators, detectors and keyed inserts."""
