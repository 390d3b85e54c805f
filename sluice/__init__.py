"""sluice: event-page ingestion and event-table operators on Spark DataFrames.

Typical use::

    from sluice import scan_pages, ingest_batch, run_ingest_stream
    pages = scan_pages(spark, "s3://.../landed/")            # O1
    new_rows = ingest_batch(pages, target=spark.read.parquet(table))   # O27b
"""

from .functions.scalars import (build_payload, coerce_bool, epoch_to_instant,  # noqa: F401
                                js_date_parse, resolve_event_id, with_occurred_at)
from .operators.dedupe import first_by_key, insert_if_absent, pending  # noqa: F401
from .operators.envelope import (check_page_chain, explode_events, invalid_events,  # noqa: F401
                                 parse_envelope, require_valid, to_event_rows, unnest_columns)
from .operators.flush import assign_flush_batches, flush_rollup  # noqa: F401
from .operators.ledger import (advance_state, count_events, ingest_progress,  # noqa: F401
                               latest_state, lifetime_total, read_ledger, run_summary,
                               running_sums, state_of)
from .operators.paging import (decode_cursor, encode_cursor, keyset_chunks, keyset_page,  # noqa: F401
                               page_table, paginate, row_index, serve_page)
from .operators.profile import field_profile, page_shape  # noqa: F401
from .plans.ingest import chain_breaks, decode_pages, event_rows, ingest_batch, page_events, split_pages  # noqa: F401
from .session import checkpoint_root, ensure_semantics, local_session  # noqa: F401
from .sources.generate import generate_events, mock_pages  # noqa: F401
from .sources.key_index import KeyIndex  # noqa: F401
from .sources.ordered import export_ordered, serve_stored_keys, serve_stored_page, write_ordered  # noqa: F401
from .sources.pages import land_pages, land_pages_in_order, scan_pages  # noqa: F401
from .sources.sinks import (batch_key, compact_partitions, export_keys,  # noqa: F401
                           read_committed, write_event_partition)
from .streaming import (IngestHooks, ProgressCollector, ingest_into_table,  # noqa: F401
                        read_left_out, run_ingest_stream, start_ingest_stream, stream_flushes, stream_progress)
