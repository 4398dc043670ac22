from cartsight.sources.files import (
    line_stream, read_sessions, read_texts, register, repartitioned, union_slices, with_key,
    write_slices,
)
from cartsight.sources.records import damaged_lines, session_lines, session_texts
from cartsight.sources.shop import shop_sessions

__all__ = [
    "damaged_lines", "line_stream", "read_sessions", "read_texts", "register", "repartitioned",
    "session_lines", "session_texts", "shop_sessions", "union_slices", "with_key", "write_slices",
]
