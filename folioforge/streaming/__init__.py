"""The page stages over a stream of manifest rows."""
