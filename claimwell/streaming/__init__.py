"""Streams: arriving files, record rules on a stream, deduplication with a watermark."""
