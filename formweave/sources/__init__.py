"""Readers and writers: dictionary, export dump, file listings, sinks."""
