"""The batch operators applied to each micro-batch of a line stream."""

from cartsight.streaming.lines import keyed, parse_stream, parsed_sink
from cartsight.streaming.online import online_batch, online_stream
from cartsight.streaming.progress import run_logged, stop_after_batch
from cartsight.streaming.tables import batch_files, read_batch, read_batches, run, write_batch
from cartsight.streaming.tree import tree_batch, tree_stream

__all__ = [
    "batch_files", "keyed", "online_batch", "online_stream", "parse_stream", "parsed_sink", "read_batch",
    "read_batches", "run", "run_logged", "stop_after_batch", "tree_batch", "tree_stream", "write_batch",
]
