"""Names, limits and byte layouts set by the log format itself.

They have to be exactly these for results to be right, so they are all listed
here as plain text.
"""

# Log container: a zip archive with one SQLite database inside.
LOG_FILE_GLOB = "*.azm"
LOG_DB_MEMBER = "azqdata.db"

# Table that holds one row per log, and the 1 Hz heartbeat used for end times.
LOGS_TABLE = "logs"
LOCATION_TABLE = "location"
HEARTBEAT_TABLE = "android_info_1sec"
LOG_INFO_TABLE = "log_info"
SIGNALLING_TABLE = "signalling"

# Tables left out unless asked for by name.
DEFAULT_EXCLUDED_TABLES = (
    "spatial_ref_sys",
    "geometry_columns",
    "log_decode_message",
    "azq_internal_types",
)
# Tables never imported.
NEVER_IMPORTED_TABLE = "android_metadata"
NEVER_IMPORTED_INFIX = "_layer_statistics"
NEVER_IMPORTED_PREFIX = "spatialite_history"

# wifi_scanned is only trusted from this app version on (3.0.742).
VERSION_GATED_TABLE = "wifi_scanned"
VERSION_GATE = 3000742
# Oldest app version that is supported without a warning (3.0.587).
OLDEST_SUPPORTED_VERSION = 3000587

# Not loaded into relational targets.
COLUMNAR_ONLY_TABLE = "lte_rrc_tmsi"
# Bad cells in these tables are reported but do not fail the log.
TOLERATED_TABLES = ("lte_rrc_tmsi", "nr_handover_stats")

# Rows are kept from 48 hours before the log start to 48 hours after its end.
CLAMP_MARGIN_HOURS = 48

# Columns.
GEOMETRY_COLUMN = "geom"
LEGACY_COLUMN = "time_ms"
# Columns that rules and joins go by.
KNOWN_COLUMNS = ("time", "time_ms", "log_hash", "geom", "symbol", "posid", "seqid", "netid", "modem_time", "direction", "lat", "lon")
UPLINK_SYMBOL = "send"
BSIC_CHARACTERS = 5
BAND_PREFIX_CHARACTERS = 3
NOT_DATETIME_SUFFIXES = ("trip_time", "_interruption_time")
UNSIGNED_32_COLUMNS = (
    "lte_volte_rtp_source_ssrc",
    "lte_volte_rtp_timestamp",
    "lte_m_tmsi",
    "lte_mmec",
)
UNSIGNED_64_COLUMN = "exynos_basic_info_nr_cellid"
FLOAT_RATE_COLUMNS = {"nr_deb_stat": ("nr_rlc_ul_tp_kbps", "nr_rlc_dl_tp_kbps")}
LENIENT_CAST_TABLE = "nr_cell_meas"

# SpatiaLite point blob: 60 bytes, little endian, SRID 4326, class 1.
POINT_BLOB_LENGTH = 60
POINT_BLOB_HEADER = "0001E6100000"
POINT_CLASS = "01000000"
POINT_CLASS_AT = 39
POINT_X_AT = 43
EWKB_POINT_PREFIX = "0101000020E6100000"
EWKB_POINT_LENGTH = 25
MSSQL_POINT_PREFIX = "E6100000010C"
MSSQL_POINT_LENGTH = 22

# Identity: nine IMEI digits in the high half, epoch seconds in the low half.
IMEI_MODULUS = 1000000000
HALF = 4294967296
LOW_MASK = 4294967295
