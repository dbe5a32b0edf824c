"""Readers and writers: rasters, vector layers, tables, metadata text and models."""
