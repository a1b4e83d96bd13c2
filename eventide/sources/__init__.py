from eventide.sources.cdc_json import SCHEMAS, read_cdc, read_cdc_stream  # noqa: F401
from eventide.sources.datagen import generate, generate_stream  # noqa: F401
from eventide.sources.sinks import with_file_time, write_stream, write_table  # noqa: F401
from eventide.sources.tables import TABLES, register_views, table  # noqa: F401
