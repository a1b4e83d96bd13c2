"""Batch forms of the keyed stream operators (DataFrame -> DataFrame)."""

from eventide.operators.anomaly import anomaly_alerts  # noqa: F401
from eventide.operators.cdc import cdc_changelog, cdc_transactions  # noqa: F401
from eventide.operators.changelog import (changelog_audit, latest_by_key,  # noqa: F401
                                          latest_changelog, materialize_changelog,
                                          scd2_from_changelog)
from eventide.operators.first_match import first_match_join  # noqa: F401
from eventide.operators.pricing import dynamic_pricing  # noqa: F401
from eventide.operators.quality import quality_score  # noqa: F401
from eventide.operators.row_format import row_formatter  # noqa: F401
from eventide.operators.sessions import session_summary, sessions  # noqa: F401
from eventide.operators.spend import spend_threshold  # noqa: F401
from eventide.operators.windows import early_fire_window, hybrid_window  # noqa: F401
