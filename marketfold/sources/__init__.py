"""Readers and writers: the given tables, feed frames, file layouts, ledgers."""
