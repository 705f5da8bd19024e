"""Running streams: append to a layer, wait for several queries."""

from stratum.streaming.queries import append_stream, start_batches, wait_all

__all__ = ["append_stream", "start_batches", "wait_all"]
