"""Column -> Column expressions. All built-in Spark functions, no Python UDFs."""

from .keys import (assignment_key, composite_key, content_hash, fingerprint,  # noqa: F401
                   legacy_identity, message_id, source_key, valid_key)
from .labels import (classify_stage, count_value, region_rank, run_status)  # noqa: F401
from .text import (clean, displayed_count, fits_or_blank, hyperlink_text,  # noqa: F401
                   is_blank, labelled_counts, last_error_line, order_ledger, title_fallback,
                   truncate)
from .values import parse_amount, parse_day, quantize_half_up, unparsed_amount  # noqa: F401
from .verdicts import (parse_verdict, prompt_input, validate_verdict)  # noqa: F401
