"""Parameters of the usage metrics.

Thresholds are a small configuration table (one row per appliance type);
they are turned into a DataFrame whose row count is known on the driver, so
broadcasting it is safe by construction.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the original job's settings for equal results).
# thresholds: app_type_id -> [min_power, min_duration_s, max_gap_s]
THRESHOLDS = {
    "2": [10, 300, 3600],
    "30": [10, 300, 3600],
    "25": [10, 600, 600],
    "31": [10, 600, 3600],
    "5": [10, 600, 600],
    "300": [10, 0, 600],
    "301": [10, 0, 3600],
    "20": [10, 0, 60],
    "37": [10, 0, 3600],
    "300301": [10, 0, 600],
}
STD_MULTIPLE = 3
SPECIAL_USER_OFFSETS = (-7200, 18000)   # start offset, end offset (seconds)
N_WEEKS = 8
WINDOW_SIZE = 4
PARAM_TH_TOP = 1.5
PARAM_TH_BOTTOM = 0.5
COUNT_BUFFER = 1.0
DURATION_BUFFER = 210.0
DAYS_3_SECS = 259200
CHUNK_STEP = 86340          # fetch sub-window step; a chunk is [s, s + 86339]
CHUNK_MIN_SPAN = 86400      # spans shorter than this are fetched whole
PAIR_APPS = ("300", "301")
PAIR_APP_ID = "300301"
HISTORY_DAYS = 56
INTERVAL_MAX_DAYS = 28
LATENIGHT_START_HOUR = 22   # JST, previous evening
LATENIGHT_END_HOUR = 5      # JST, exclusive
PROVIDER_PATTERN = r"(\d+)_([a-zA-Z0-9]+)"
# ---------------------------------------------------------------------------

JST_OFFSET = 9 * 3600
DAY = 86400
LABEL_OFFSET = DAY - JST_OFFSET    # ymd label = unix_date(data_day)*86400 + 54000

THRESHOLD_SCHEMA = T.StructType([
    T.StructField("app_type_id", T.StringType(), False),
    T.StructField("min_power", T.DoubleType(), False),
    T.StructField("min_duration", T.LongType(), False),
    T.StructField("max_gap", T.LongType(), False),
])

LITERAL_ROWS = 1_000      # larger tables are no literals in a plan
BROADCAST_ROWS = 10_000   # larger tables are joined as any other


def literal_table(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """A driver-side table; a small one as a literal (JVM-only local relation, no Python RDD)."""
    if len(rows) > LITERAL_ROWS:
        return spark.createDataFrame(rows, schema)
    struct_type = T.ArrayType(schema, containsNull=False)
    arr = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
                    for row in rows]).cast(struct_type)
    return spark.range(0, 1, 1, 1).select(F.inline(arr))


@dataclass(frozen=True)
class Thresholds:
    """app_type_id -> (min_power, min_duration, max_gap)."""

    rows: dict = field(default_factory=lambda: dict(THRESHOLDS))

    def to_df(self, spark: SparkSession) -> DataFrame:
        data = [(str(k), float(v[0]), int(v[1]), int(v[2])) for k, v in self.rows.items()]
        table = literal_table(spark, data, THRESHOLD_SCHEMA)
        # The row count is known here, so the hint is bounded; beyond it Spark decides by size.
        return F.broadcast(table) if len(data) <= BROADCAST_ROWS else table

    @property
    def app_types(self) -> list[str]:
        return sorted(self.rows)


def special_users_df(spark: SparkSession, users: dict) -> DataFrame:
    """Special-user offsets table: user_id -> (start_offset, end_offset); any number of users."""
    items = list(users.items())
    key_type = T.LongType() if items and isinstance(items[0][0], int) else T.StringType()
    schema = T.StructType([
        T.StructField("user_id", key_type, False),
        T.StructField("start_offset", T.LongType(), False),
        T.StructField("end_offset", T.LongType(), False),
    ])
    return literal_table(spark, [(k, int(v[0]), int(v[1])) for k, v in items], schema)
