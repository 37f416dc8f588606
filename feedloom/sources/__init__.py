"""Sources, and the log writers that go with them."""
