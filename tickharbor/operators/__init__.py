"""DataFrame operators on market events."""
