"""All checked queries (importing a family module registers its queries)."""

from voxtab.plans import q_curate, q_files, q_io, q_quality, q_segments, q_signal, q_slicing, q_speakers, q_stats, q_stream, q_text  # noqa: F401
from voxtab.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
