"""Whole flows, from dropped files to keyed tables."""

from landfold.plans.dropzone import DropZone, Feed

__all__ = ["DropZone", "Feed"]
