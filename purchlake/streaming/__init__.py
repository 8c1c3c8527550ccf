from .silver_stream import merge_batch, start

__all__ = ["merge_batch", "start"]
