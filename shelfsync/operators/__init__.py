"""DataFrame operators of the sync."""
