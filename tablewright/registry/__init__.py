"""Registered queries over the driver tables, each with its SQL counterpart where one exists."""

from tablewright.registry import analyses, checks, composed, ingest, joins, models, panels, profile, programs, repair  # noqa: F401
from tablewright.registry.common import REGISTRY

__all__ = ["REGISTRY"]
