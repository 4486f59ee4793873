"""Readers and writers: files in, tables out."""
