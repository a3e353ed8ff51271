"""Column names of the control-plane tables. Inference is never used.

CSV inputs with a header whose full column list we do not own (the storage
portal's export) are read with every column as text (``inferSchema`` off) and
then projected by name, so no 21-column schema has to be declared here.
"""

from __future__ import annotations

# Columns the validation phase requires to be present.
CONTROL_REQUIRED = (
    "icdsTableName", "BANNER_NAME", "dataSensitivity",
    "dlSchemaName", "dlTableName", "tableLoadType",
)

# The two columns of the storage portal export that the mapping uses.
MAPPING_SOURCE_KEY = "tableName"
MAPPING_SOURCE_VALUE = "bucket_name"

# Key of a storage request: one request per (schema, table).
REQUEST_KEY = ("databaseName", "tableName")

# Optional control columns that say which slice of the source an item takes.
EXTRACT_COLUMNS = ("extract_filter", "watermark")
