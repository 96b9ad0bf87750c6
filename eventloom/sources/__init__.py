from eventloom.sources.generated import keyword_rows, keyword_stream
from eventloom.sources.text import read_folder, read_lines, read_positions, socket_lines, stream_lines

__all__ = [
    "keyword_rows",
    "keyword_stream",
    "read_folder",
    "read_lines",
    "read_positions",
    "socket_lines",
    "stream_lines",
]
