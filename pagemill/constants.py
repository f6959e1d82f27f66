"""Limits, names and formats shared by every stage."""

# --- Fixed values: message, object and payload formats other systems rely on ---

# A message body names its work under the first of these that is not empty.
MESSAGE_KEY_FIELDS = ["s3_keys", "s3_key", "key", "s3Uri", "s3_uri"]

RECEIVE_COUNT_ATTRIBUTE = "ApproximateReceiveCount"
DEFAULT_RECEIVE_COUNT = "1"

BUCKET_SCHEME = "s3://"
PARQUET_PREFIX = "parquets"
JSONL_PREFIX = "jsonl"
RESPONSE_PREFIX = "ocr"
JSONL_SUFFIX = ".jsonl"
RESPONSE_SUFFIX = "_ocr_pages.jsonl"

DOCUMENT_TYPE = "image_url"
DATA_URL_MARK = "data:image"
DATA_URL_PREFIX = "data:image/jpeg;base64,"
INCLUDE_IMAGE_BASE64 = True
GZIP_MAGIC_HEX = "1F8B"
PDF_MARK = "%PDF-"

STATUS_ENQUEUED = "enqueued"
STATUS_PROCESSING = "processing"
STATUS_DONE = "done"
STATUS_FAILED = "failed"
PENDING_STATUSES = [STATUS_ENQUEUED, STATUS_PROCESSING]

RESULT_SKIPPED = "skipped"
RESULT_SUCCESS = "success"
REASON_ALREADY_DONE = "already_done"
REASON_WORKER = "worker_processing_failed"
REASON_OCR = "ocr_processing_failed"

OUTCOME_PROCESSED = "processed"
OUTCOME_DEAD_LETTER = "forwarded_to_dlq"
ACKNOWLEDGED_OUTCOMES = [OUTCOME_PROCESSED, OUTCOME_DEAD_LETTER]

LAST_ERROR_CHARS = 1024

MAX_BATCH_BYTES = 40 * 1024 * 1024
MAX_BATCH_PAGES = 950
MAX_MESSAGES_PER_POLL = 10
MAX_RECEIVE_COUNT = 3
MAX_ATTEMPTS = 4

# --- Names of our own ---

STAGE_PAGES = "pages"
STAGE_OCR = "ocr"
STAGE_RESPONSES = "responses"

EVENT_REGISTERED = "registered"
EVENT_STARTED = "started"
EVENT_PAGE = "page"
EVENT_FINISHED = "finished"
EVENT_FAILED = "failed"
EVENT_SNAPSHOT = "snapshot"

OUTCOME_FAILED = "failed"
OUTCOME_WRITE_FAILED = "write_failed"
