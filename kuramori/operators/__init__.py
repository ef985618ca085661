"""Relational, spatial and structural operators; each takes and returns DataFrames."""
