from .files import require_files, scan_files, with_digest  # noqa: F401
from .landing import scan_workbooks, stream_changed_files  # noqa: F401
from .tables import (read_checkpoint, read_load_csv, read_logs, read_summaries,  # noqa: F401
                     read_target)
from .workbooks import (audit_workbooks, parse_workbooks, read_workbooks,  # noqa: F401
                        resolve_formulas, unreadable_formulas)
