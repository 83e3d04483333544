"""Compositions of operators: retrieval, marts, graph load, scan, assistant."""
