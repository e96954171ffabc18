"""Distributed data jobs: each takes DataFrames and returns DataFrames."""
