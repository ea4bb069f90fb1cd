"""Runnable jobs over tables of texts: each has a command line and a small config file."""
