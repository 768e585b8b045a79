"""One base for what a user can put right; anything else that is raised is a fault of this package."""

from __future__ import annotations


class StrandlakeError(Exception):
    """A mistake in inputs, configuration or folders."""
