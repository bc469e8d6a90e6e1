"""Inputs: fixture tables derived from the supplied test tables, landing of
raw files, and file listings."""
