"""DataFrame -> DataFrame operators (batch and streaming share them)."""
