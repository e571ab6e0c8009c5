"""Default parameters of the operators. Every operator takes them as keyword arguments."""

# --- fixed values: column names and their separators -------------------------------------------
QUESTION_PREFIX = "question"
QUESTION_DELIMITER = "__"
MAIN_QUESTION = "species"
EMPTY_ANSWER = "blank"
MAIN_COLUMN = QUESTION_PREFIX + QUESTION_DELIMITER + MAIN_QUESTION
CHECK_PREFIX = "image_check__"
TAG_PREFIX = "exif__"
GROUP_KEYS = ("season", "site", "roll")

# --- fixed values: image checks ----------------------------------------------------------------
IMAGE_CHECKS = (
    "all_black", "all_white", "corrupt_file", "corrupt_exif", "empty_exif",
    "time_lapse", "time_too_new", "time_too_old", "captures_with_too_many_images",
)
CHECKS_INVALIDATE = ("all_black", "all_white", "corrupt_exif", "empty_exif")
CHECKS_DELETE = ("corrupt_file",)
CHECKS_TIME = ("time_lapse", "time_too_new", "time_too_old", "captures_with_too_many_images")
CAPTURE_GAP_SECONDS = 5
MAX_DAYS_WITHOUT_IMAGE = 30
MIN_YEAR, MAX_YEAR = 1970, 9999
MAX_IMAGES_PER_CAPTURE = 3
BLACK_THRESHOLD, BLACK_SHARE = 30, 0.8
WHITE_THRESHOLD, WHITE_SHARE = 200, 0.8

# --- fixed values: actions ---------------------------------------------------------------------
ALLOWED_ACTIONS = ("delete", "invalidate", "timechange", "mark_no_upload", "mark_datetime_uncertain", "ok")
IMAGE_FLAGS = ("image_was_deleted", "image_is_invalid", "image_no_upload", "image_datetime_uncertain")
ACTION_FLAGS = {
    "delete": ("image_was_deleted", "image_no_upload"),
    "invalidate": ("image_is_invalid", "image_no_upload"),
    "mark_no_upload": ("image_no_upload",),
    "mark_datetime_uncertain": ("image_datetime_uncertain",),
}
FLAGS_REMOVED_FROM_CLEANED = {"image_was_deleted": ("1",)}
FLAGS_REMOVED_FROM_UPLOAD = {"image_no_upload": ("1",)}
FLAGS_REMOVED_FROM_REPORT = {
    "image_was_deleted": ("1",),
    "image_is_invalid": ("1",),
    "image_datetime_uncertain": ("1",),
    "invalid": ("1", "2"),
}

# --- fixed values: time and EXIF ---------------------------------------------------------------
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
EXIF_DATETIME_FORMAT = "yyyy:MM:dd HH:mm:ss"
DATETIME_FORMATS = (EXIF_DATETIME_FORMAT, DATETIME_FORMAT, "yyyy-MM-dd HH:mm:ss'Z'")
DEFAULT_TIMEZONE = "Africa/Johannesburg"
EXIF_TIMESTAMP_TAGS = ("DateTime", "DateTimeOriginal", "EXIF:DateTime", "EXIF:DateTimeOriginal")
EXIF_GROUPS = ("EXIF", "MakerNotes", "Composite")
EXIF_EXCLUDED_TAGS = ("EXIF:ThumbnailImage", "MakerNotes:PreviewImage")

# --- fixed values: columns of the cleaned capture file -----------------------------------------
CLEANED_FIRST_COLUMNS = (
    "capture_id", "season", "site", "roll", "capture", "image_rank_in_capture", "image_name",
    "image_path_rel", "datetime", "datetime_exif", "datetime_file_creation", "image_is_invalid",
    "image_datetime_uncertain", "image_no_upload", "image_was_deleted", "action_taken",
    "action_taken_reason",
)
CLEANED_EXCLUDED_COLUMNS = (
    "seconds_to_next_image_taken", "seconds_to_last_image_taken", "days_to_last_image_taken",
    "days_to_next_image_taken", "image_rank_in_roll", "image_path", "image_name_original",
    "image_path_original_rel", "image_path_original", "date", "time",
)

# --- fixed values: answers of the classification exports ---------------------------------------
QUESTION_NAMES = {
    "arethereanyyoungpresent": "young_present",
    "choice": "species",
    "doyouseeanyantlers": "antlers_visible",
    "doyouseeanyhorns": "horns_visible",
    "howmany": "count",
    "howmanyanimalscanyouseethathavehorns": "horns_count",
    "question": "species",
}
QUESTIONS_IGNORED = ("dontcare",)
ANSWERS_BY_QUESTION = {
    "species": {
        "no animals present": "blank",
        "noanimalspresent": "blank",
        "nothing": "blank",
        "nothinghere": "blank",
        "nothingthere": "blank",
    },
    "count": {"1150": "11-50", "51": "51+"},
    "horns_count": {"1150": "11-50", "51": "51+"},
}
ANSWERS = {"n": "0", "no": "0", "y": "1", "yes": "1"}
CLASSIFICATION_COLUMNS = (
    "user_name", "user_id", "created_at", "subject_ids", "workflow_id", "workflow_version",
    "classification_id",
)
REQUIRED_CLASSIFICATION_COLUMNS = (
    "user_name", "subject_ids", "subject_data", "annotations", "workflow_id", "workflow_version",
    "created_at", "classification_id",
)
QUESTION_ORDER = (
    "species", "count", "standing", "resting", "moving", "eating", "interacting", "young_present",
    "horns_count", "antlers_visible",
)
COUNT_QUESTIONS = ("count", "horns_count")
COUNT_ORDINALS = {"": 0, "11-50": 11, "51+": 12}
COUNT_MODES = ("median", "min", "max")
HUMAN_LABELS = ("human",)
SUBJECT_METADATA = ("#season", "#roll", "#site", "#capture", "#capture_id")

# --- fixed values: legacy export ---------------------------------------------------------------
LEGACY_HEADER = {
    "babies": "young_present",
    "id": "classification_id",
    "retire_reason": "retirement_reason",
    "species_count": "count",
}
LEGACY_QUESTIONS = ("species", "count", "standing", "resting", "moving", "eating", "interacting", "young_present")
LEGACY_FLAG_QUESTIONS = ("standing", "resting", "moving", "eating", "interacting", "young_present")
LEGACY_SEASON_PREFIX = "SER_S"

# --- fixed values: report column groups --------------------------------------------------------
PLURALITY_COLUMNS_EXTENDED = (
    "n_users_classified_this_subject", "n_users_identified_this_species",
    "n_species_ids_per_user_median", "n_species_ids_per_user_max", "n_users_saw_a_species",
    "n_users_saw_no_species", "p_users_saw_a_species", "species_is_plurality_consensus",
)

# Groups above this many rows are never put into one window task; see operators.ordering.
HOT_GROUP_ROWS = 2_000_000

# Values found in the data that become columns (answers, prediction labels); more are an error.
MAX_COLUMNS = 5_000
