"""Streaming counterparts; an extension, the batch operators are the specification."""
