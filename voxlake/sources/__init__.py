"""Reading, writing and registering tables."""
