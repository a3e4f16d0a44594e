"""Constants whose values must equal the behaviour this
library re-expresses (file types, thresholds, labels, formats), stated once
and in the order that behaviour uses them. Modules import them from here.
"""

# --- Fixed values ---------------------------------------------------------------

# Labelling a folder tree
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".bmp", ".tiff", ".tif",
                    ".webp", ".gif", ".heic", ".heif", ".svg")
FIXED_HEADERS = ("image_name", "relative_path", "license_type", "crop_type", "quality")
DEFAULT_OUTPUT_STEM = "dataset"
SPEC_FILE = "dataset_config.json"
SAMPLE_IMAGES_PER_FOLDER = 3
TOTAL_LABEL = "Total images"
SEP_SPEC = "  =  "          # "header  =  value" (any-depth labeller)
SEP_FIXED = " = "           # "header = value" (fixed-depth labeller)
NONE_VALUE = "(none)"
WIDTH_PADDING = 4
WIDTH_MAX = 60

# Converting documents
CONVERTED_DIR = "Converted"
TARGET_ROOT_SIBLING = "Papers_Converted"
MARKDOWN_SUFFIX = ".md"
REFERENCE_HEADINGS = ("references", "bibliography", "works cited")
REFERENCE_TEXT_LIMIT = 8000
CONVERT_STATUSES = ("ok", "skipped", "error")

# Planning downloads
BAD_FILENAME_CHARS = '\\/:*?"<>|'   # \ / : * ? " < > |
DATA_SUFFIXES = (".parquet", ".arrow", ".json", ".jsonl", ".csv")
README_MARK = "README"
SHARD_MIN_BYTES = 1_000_000
DATA_FILE_MIN_BYTES = 100_000
FETCH_STATUSES = ("success", "skip", "fail")
DOWNLOAD_STATUSES = ("success", "skip", "unavailable", "fail")
PROGRESS_EVERY = 10

# --- end of fixed values -----------------------------------------------------------
