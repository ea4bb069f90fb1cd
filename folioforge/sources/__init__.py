"""Text files and JSON lines in; JSON lines, JSON and text out."""
