"""Composite jobs: artist identity, dimensions, fact, marts, profiling, warehouse build."""
