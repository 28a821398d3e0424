"""Topics, exchange envelopes, dimensions and the fact catalog."""
