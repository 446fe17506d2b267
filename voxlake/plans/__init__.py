"""Composed jobs: voxel build, ingest / resume against a store, registered queries and their oracle SQL."""
