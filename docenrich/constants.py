"""Names, defaults and declared schemas shared by every module."""

from pyspark.sql import types as T

# Result texts and tuning constants that callers rely on.
# (Two are ours: FILES_PER_TASK, the most files a lost task can cost, and
# READ_AHEAD_BYTES, what a task holds of files it has yet to work on.)
DEFAULT_TYPE = "Unknown Type"
DEFAULT_JURISDICTION = "Unknown Jurisdiction"
PDF_SUFFIX = ".pdf"
DOCX_SUFFIX = ".docx"
PDF_PLACEHOLDER = "Extracted text from PDF"
DOCX_PLACEHOLDER = "Extracted text from DOCX"
EXTRACTION_MESSAGE = "Extraction failed for file: "
API_MESSAGE = "API call failed for file: "
ERROR_MESSAGE = "Unexpected error processing file "
NO_OBJECT = "the reply is not a JSON object"
UNSUPPORTED = "Unsupported file format"
PAGE_HEADING = ("Page ", " - Text Section:\n\n")
BUSY_MESSAGE = ("Rate limit exceeded. Retrying in ", " seconds...")
RETRY_MESSAGE = ("API request failed. Retrying ", "...")
MAX_ATTEMPTS = 5
BACKOFF_BASE = 1.5
WORKERS_PER_PARTITION = 10
NUM_PARTITIONS = 200
FILES_PER_TASK = 2000
READ_AHEAD_BYTES = 64 << 20
PREVIEW_ROWS = 20
PREVIEW_WIDTH = 20

# Outcomes of one file. Every result layout is a projection of this column.
SUCCESS = "success"
EXTRACTION_FAILURE = "extraction_failure"
API_FAILURE = "api_failure"
ERROR = "error"
# An attempt log may end before its call is decided.
OPEN = "open"

PATH_SCHEMA = T.StructType([T.StructField("file_path", T.StringType(), False)])

BYTES_SCHEMA = T.StructType(
    [
        T.StructField("file_path", T.StringType(), False),
        T.StructField("content", T.BinaryType(), True),
    ]
)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("filepath", T.StringType(), True),
        T.StructField("type", T.StringType(), True),
        T.StructField("jurisdiction", T.StringType(), True),
        T.StructField("status", T.StringType(), True),
    ]
)

# The ledger table keeps, beside the persisted layout, what the other layouts
# and the failure log need, and the run that wrote the row.
LEDGER_TABLE_SCHEMA = T.StructType(
    LEDGER_SCHEMA.fields
    + [
        T.StructField("outcome", T.StringType(), True),
        T.StructField("error", T.StringType(), True),
        T.StructField("run_seq", T.LongType(), True),
        T.StructField("run_id", T.StringType(), True),
    ]
)
