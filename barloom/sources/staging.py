"""Staging of frames that several passes read."""

from __future__ import annotations

from barloom.sources.shared import discard, keep_checkpoints, shared_folder, stage, stage_buckets, stage_table, work_path, write_shared

__all__ = ["discard", "keep_checkpoints", "shared_folder", "stage", "stage_buckets", "stage_table", "work_path", "write_shared"]
