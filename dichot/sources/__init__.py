"""Sources and sinks."""
from dichot.sources.io import (read_csv_blank_null, read_csv_keep_blank, read_delimited,  # noqa: F401
                               read_table, write_predictions, write_table)
