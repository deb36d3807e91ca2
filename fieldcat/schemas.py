"""Declared schemas, status domain and the fixed key lists."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the instrument file layout the ingest targets).
# Catalogue keys, scientific keys (the source list names blur_limit twice),
# and the array keys that are down-sampled into the data sample.
# ---------------------------------------------------------------------------
CATALOGUE_KEYS = [
    "/measurement/instrument/instrument_name",
    "/measurement/sample/experiment/beamline",
    "/measurement/sample/experiment/experiment_lead",
    "/measurement/sample/experiment/pi",
    "/measurement/sample/experiment/proposal",
    "/measurement/sample/experimenter/email",
    "/measurement/sample/experimenter/name",
    "/measurement/sample/file_name",
]

SCIENTIFIC_KEYS = [
    "/measurement/instrument/attenuator/setup/filter_y",
    "/measurement/instrument/camera_motor_stack/setup/tilt_motor",
    "/measurement/instrument/detection_system/objective/camera_objective",
    "/measurement/instrument/detection_system/scintillator/scintillator_type",
    "/measurement/instrument/detector/binning_x",
    "/measurement/instrument/detector/binning_y",
    "/measurement/instrument/detector/dark_field_value",
    "/measurement/instrument/detector/delay_time",
    "/measurement/instrument/detector/dimension_x",
    "/measurement/instrument/detector/dimension_y",
    "/measurement/instrument/detector/model",
    "/measurement/instrument/detector/pixel_size",
    "/measurement/instrument/detector/temperature",
    "/measurement/instrument/monochromator/setup/Z2",
    "/measurement/instrument/monochromator/setup/temperature_tc2",
    "/measurement/instrument/monochromator/setup/temperature_tc3",
    "/measurement/instrument/slits/setup/hslits_A_Door",
    "/measurement/instrument/slits/setup/hslits_A_Wall",
    "/measurement/instrument/slits/setup/hslits_center",
    "/measurement/instrument/slits/setup/hslits_size",
    "/measurement/instrument/slits/setup/vslits_Lead_Flag",
    "/measurement/instrument/source/source_name",
    "/process/acquisition/dark_fields/dark_num_avg_of",
    "/process/acquisition/dark_fields/num_dark_fields",
    "/process/acquisition/flat_fields/i0_move_x",
    "/process/acquisition/flat_fields/i0_move_y",
    "/process/acquisition/flat_fields/i0cycle",
    "/process/acquisition/flat_fields/num_flat_fields",
    "/process/acquisition/flat_fields/usebrightexpose",
    "/process/acquisition/mosaic/tile_xmovedist",
    "/process/acquisition/mosaic/tile_xnumimg",
    "/process/acquisition/mosaic/tile_xorig",
    "/process/acquisition/mosaic/tile_xoverlap",
    "/process/acquisition/mosaic/tile_ymovedist",
    "/process/acquisition/mosaic/tile_ynumimg",
    "/process/acquisition/mosaic/tile_yorig",
    "/process/acquisition/mosaic/tile_yoverlap",
    "/process/acquisition/name",
    "/process/acquisition/rotation/blur_limit",
    "/process/acquisition/rotation/blur_limit",
    "/process/acquisition/rotation/multiRev",
    "/process/acquisition/rotation/nhalfCir",
    "/process/acquisition/rotation/num_angles",
    "/process/acquisition/rotation/range",
]

SAMPLED_KEYS = [
    "/measurement/instrument/sample_motor_stack/setup/axis1pos",
    "/measurement/instrument/sample_motor_stack/setup/axis2pos",
    "/measurement/instrument/sample_motor_stack/setup/sample_x",
    "/measurement/instrument/sample_motor_stack/setup/axis5pos",
    "/measurement/instrument/camera_motor_stack/setup/camera_elevation",
    "/measurement/instrument/source/current",
    "/measurement/instrument/camera_motor_stack/setup/camera_distance",
    "/measurement/instrument/source/beam_intensity_incident",
    "/measurement/instrument/monochromator/energy",
    "/measurement/instrument/detector/exposure_time",
    "/measurement/instrument/time_stamp",
    "/measurement/instrument/monochromator/setup/turret2",
    "/measurement/instrument/monochromator/setup/turret1",
]

# Status domain in lifecycle order, severities, record constants.
STATUS_SUBMITTED = "submitted"
STATUS_RUNNING = "running"
STATUS_COMPLETE_WITH_ISSUES = "complete_with_issues"
STATUS_SUCCESSFUL = "successful"
STATUS_ERROR = "error"
TERMINAL_STATUSES = [STATUS_COMPLETE_WITH_ISSUES, STATUS_SUCCESSFUL, STATUS_ERROR]
PENDING_STATUSES = [STATUS_SUBMITTED, STATUS_RUNNING]
SEVERITY_WARNING = "warning"
SEVERITY_ERROR = "error"
DEFAULT_STAGE = "unknown"
UNKNOWN = "Unknown"
DATASET_TYPE = "raw"
DATA_FORMAT = "DX"
DATAFILE_TYPE = "RawDatasets"
ATTACHMENT_CAPTION = "raw image"
BEAMLINE_ALIASES = {"bl832": ["8.3.2"]}
SAMPLE_SIZE = 10
THUMBNAIL_TYPE = "jpg"
INTENSITY_SCALE = 205.0
INTENSITY_OFFSET = 1.001
AUTOCONTRAST_CUTOFF_PERCENT = 0.1


def status_rank(status_col):
    """submitted < running < terminal; used to order events with equal times."""
    from pyspark.sql import functions as F
    return (F.when(status_col == STATUS_SUBMITTED, F.lit(0))
            .when(status_col == STATUS_RUNNING, F.lit(1))
            .otherwise(F.lit(2)))


def unique_keys(keys):
    """Requested keys with duplicates removed, first position kept."""
    seen, out = set(), []
    for k in keys:
        if k not in seen:
            seen.add(k)
            out.append(k)
    return out


ISSUE = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("msg", T.StringType()),
    T.StructField("exception", T.StringType()),
])

FIELDS = T.StructType([
    T.StructField("file_path", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("shape", T.ArrayType(T.LongType())),
    T.StructField("maxshape", T.ArrayType(T.LongType())),
    T.StructField("str_values", T.ArrayType(T.StringType())),
    T.StructField("int_values", T.ArrayType(T.LongType())),
    T.StructField("dbl_values", T.ArrayType(T.DoubleType())),
])

#: The stride sample of an array of a file; a scalar has neither step nor values.
SAMPLES = T.StructType([
    T.StructField("file_path", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("n_values", T.LongType()),
    T.StructField("step", T.LongType()),
    T.StructField("chunks", T.LongType()),
    T.StructField("chunks_read", T.LongType()),
    T.StructField("str_values", T.ArrayType(T.StringType())),
    T.StructField("int_values", T.ArrayType(T.LongType())),
    T.StructField("dbl_values", T.ArrayType(T.DoubleType())),
])

FRAMES = T.StructType([
    T.StructField("file_path", T.StringType()),
    T.StructField("frame_idx", T.IntegerType()),
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("pixels", T.ArrayType(T.DoubleType())),
])

DATA_FILE = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("time", T.StringType()),
    T.StructField("type", T.StringType()),
])

JOB_REQUESTS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("submitter", T.StringType()),
    T.StructField("document_path", T.StringType()),
    T.StructField("mapping_id", T.StringType()),
    T.StructField("ingest_types", T.ArrayType(T.StringType())),
    T.StructField("submit_time", T.TimestampType()),
])

JOB_EVENTS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("time", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("submitter", T.StringType()),
    T.StructField("log", T.StringType()),
    T.StructField("issues", T.ArrayType(ISSUE)),
])

CLIENTS = T.StructType([
    T.StructField("key_digest", T.StringType()),
    T.StructField("client", T.StringType()),
    T.StructField("api", T.StringType()),
])

# The job lifecycle as allowed transitions (previous -> next);
# "none" is the state before a job's first event.
ALLOWED_TRANSITIONS = {
    "none": ["submitted"],
    "submitted": ["running", "error"],
    "running": ["running", "complete_with_issues", "successful", "error"],
    "complete_with_issues": [],
    "successful": [],
    "error": [],
}
