"""Tables to read from and places to write to."""
