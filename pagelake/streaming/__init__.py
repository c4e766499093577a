from .pages_stream import batch_params, process_batch, start_pages_stream

__all__ = ["batch_params", "process_batch", "start_pages_stream"]
