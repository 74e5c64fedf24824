from .drops import stream_drops

__all__ = ["stream_drops"]
