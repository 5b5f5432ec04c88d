"""Cubes over streams: an extension, since the engine's own tables are batch tables."""

from .cube_stream import maintain, rollup_stream

__all__ = ["maintain", "rollup_stream"]
