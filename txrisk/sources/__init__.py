"""Reading, writing and staging transaction tables."""
