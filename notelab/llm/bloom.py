"""The Bloom filters of ``notelab.functions.bloom``."""

from notelab.functions.bloom import KEY_BITS, PROBES, SEGMENT_BITS, Bloom, Members, segments_for

__all__ = ["KEY_BITS", "PROBES", "SEGMENT_BITS", "Bloom", "Members", "segments_for"]
