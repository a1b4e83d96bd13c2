from eventide.functions.columns import (  # noqa: F401
    epoch_ms, interval_ms, ms_to_ntz, not_blank, require_columns, window_start)
