from .batches import (csv_row_bytes, greedy_batches, read_load_chunks, size_bounded_batches,  # noqa: F401
                      write_load_chunks)
from .files import (append_checkpoint, commit_manifest, current_snapshot,  # noqa: F401
                    write_daily_counts, write_load_csv, write_report)
from .log import read_version  # noqa: F401
from .upsert import (clean_table, commit_load, compact_table, known_keys, read_table, side_folders,  # noqa: F401
                     stage_load, upsert, upsert_table)
