"""voxlake: 3-D point tables -> per-chunk cleaned voxel tables, on Spark DataFrames.

Layers: ``sources`` (point views, the Parquet voxel store), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame steps), ``plans`` (composed jobs: the
voxel build, ingest / resume against a store, the registered query catalog).
"""

from voxlake.plans.build import VoxelConfig, chunk_voxels, profile_voxels, voxelize_points
from voxlake.plans.ingest import RunResult, ingest, resume, summary
from voxlake.sources.points import read_points
from voxlake.sources.store import VoxelStore

__all__ = ["VoxelConfig", "chunk_voxels", "profile_voxels", "voxelize_points", "RunResult", "ingest", "resume",
           "summary", "read_points", "VoxelStore"]
