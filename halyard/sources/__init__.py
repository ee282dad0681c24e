"""Readers, landed-payload flattening and sinks."""
