"""Fixed schemas of the control data.

Times are wall clock readings of one fixed zone, so they are TIMESTAMP_NTZ: no value
depends on the session zone.
"""

from __future__ import annotations

from pyspark.sql import types as T


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TEXT, WALL, FLAG = T.StringType(), T.TimestampNTZType(), T.BooleanType()
INT, LONG, REAL = T.IntegerType(), T.LongType(), T.DoubleType()

TRACKER = struct(source_table=TEXT, event_time=WALL)

METADATA = struct(
    source_table=TEXT, target_table=TEXT, strategy=TEXT, disabled=FLAG,
    priority=INT, min_staleness=INT, max_staleness=INT,
)

QUEUE = struct(
    source_table=TEXT, target_table=TEXT, event_time=WALL, trigger_time=WALL,
    strategy=TEXT, lock_rows=FLAG, status=TEXT, priority=INT, event_time_latest=WALL,
)

HISTORY = struct(
    source_table=TEXT, target_table=TEXT, status=TEXT, event_time=WALL,
    trigger_time=WALL, finish_time=WALL, duration_min=REAL, strategy=TEXT,
    lock_rows=FLAG, priority=INT, error=TEXT, num_records=LONG,
)

BATCH_QUEUE = struct(
    source_table=TEXT, target_table=TEXT, strategy=TEXT, lock_rows=FLAG,
    status=TEXT, priority=LONG,
)

MANIFEST = struct(source=TEXT, target=TEXT, strategy=TEXT, lock_rows=FLAG)

RUN = struct(
    table=TEXT, strategy=TEXT, status=TEXT, start=REAL, end=REAL,
    num_records=LONG, error=TEXT,
)

# The two ways a table is extracted; each is its own queue partition.
STRATEGIES = ("TPT", "WriteNOS")

# How many tables of a strategy are copied at the same time.
DEFAULT_SLOTS = {"TPT": 8, "WriteNOS": 2}

# States of a queue row and of a history row.
QUEUED, RUNNING_ROW = "Q", "R"
RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
