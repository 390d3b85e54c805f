from .hooks import IngestHooks, ProgressCollector  # noqa: F401
from .ingest_stream import (ingest_into_table, run_ingest_stream, start_ingest_stream,  # noqa: F401
                            stream_progress)
from .run_state import read_left_out, stream_flushes  # noqa: F401

ingest_stream = start_ingest_stream  # O27 under its inventory name
