"""Incremental forms of the batch statistics over a growing folder of interaction files."""
