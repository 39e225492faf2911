"""Readers that turn saved inputs into paper rows, and the export sinks."""
