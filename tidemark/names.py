"""Names and marker values shared by every layer."""

# Tables written by one layer are read by the next under these names.

# change feed
CHANGE_TYPE = "_change_type"
COMMIT_VERSION = "_commit_version"
COMMIT_TIMESTAMP = "_commit_timestamp"
INSERT = "insert"
UPDATE = "update"
UPDATE_PREIMAGE = "update_preimage"
UPDATE_POSTIMAGE = "update_postimage"
DELETE = "delete"

# raw history
RAW_CHANGE_TYPE = "_raw_change_type"
RAW_COMMIT_VERSION = "_raw_commit_version"
RAW_COMMIT_TIMESTAMP = "_raw_commit_timestamp"
SOURCE_SYSTEM = "_source_system"
PROCESSING_TIMESTAMP = "_processing_timestamp"
PROCESSING_DATE = "_processing_date"

# bronze lineage
RAW_FILE_PATH = "_raw_file_path"
RAW_FILE_MODIFICATION_TIME = "_raw_file_modification_time"

# silver
BUSINESS_KEY = "business_key"
SILVER_TIMESTAMP = "_silver_timestamp"
RAW_FILE_TIMESTAMP = "_raw_file_timestamp"

# slowly changing dimensions
START_AT = "__START_AT"
END_AT = "__END_AT"
ROW_VALID_FROM = "_row_valid_from"
ROW_VALID_TO = "_row_valid_to"
IS_CURRENT = "is_current"
IS_DELETED = "is_deleted"
FIRST_START = "1900-01-01 00:00:00"
OPEN_END = "9999-12-31 23:59:59"

# unknown members
UNKNOWN_KEY = -1
UNKNOWN_TEXT = "Unknown"

# commit history: property that switches the change feed on
FEED_PROPERTY = "delta.enableChangeDataFeed"
