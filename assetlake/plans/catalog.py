"""All registered queries; importing this module fills the registry."""

from __future__ import annotations

from assetlake.plans import q_assets, q_eval, q_images, q_ingest, q_quality, q_scoring, q_state  # noqa: F401
from assetlake.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
