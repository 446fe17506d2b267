"""Point sources and the Parquet voxel store."""
