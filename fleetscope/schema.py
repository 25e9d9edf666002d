"""Source schemas, the column mapping to internal names, and metric families.

The source tables keep the column names of the spreadsheets they come from
(some contain ``%`` and ``/``).  Everything downstream of the reader works on
the snake_case names of ``COLUMN_MAP`` so that no later expression needs quoting.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: source column names of the metric tables --------------------
SRC_SERVER = "Server_Name"
SRC_TIME = "HR_Time"
SRC_PROCESSOR = "Processor"
SRC_CPU = "AVG_%_Processor_Time"
SRC_MEM = "AVG_Memory_Usage_Percentage"
SRC_DISK = "Disk_Name"
SRC_WRITES_AVG = "AVG_Disk_Writes/Sec"
SRC_WRITES_MAX = "MAX_Disk_Writes/Sec"
SRC_READS_AVG = "AVG_Disk_Reads/Sec"
SRC_READS_MAX = "MAX_Disk_Reads/Sec"
# The processor value that marks the all-processor row.
TOTAL_PROCESSOR = "_Total"
# --- end of fixed values --------------------------------------------------------

SERVER = "server_name"
TIME = "hr_time"
PROCESSOR = "processor"
CPU = "cpu_pct"
MEM = "mem_pct"
DISK = "disk_name"
WRITES_AVG = "disk_writes_avg"
WRITES_MAX = "disk_writes_max"
READS_AVG = "disk_reads_avg"
READS_MAX = "disk_reads_max"

COLUMN_MAP: dict[str, str] = {
    SRC_SERVER: SERVER,
    SRC_TIME: TIME,
    SRC_PROCESSOR: PROCESSOR,
    SRC_CPU: CPU,
    SRC_MEM: MEM,
    SRC_DISK: DISK,
    SRC_WRITES_AVG: WRITES_AVG,
    SRC_WRITES_MAX: WRITES_MAX,
    SRC_READS_AVG: READS_AVG,
    SRC_READS_MAX: READS_MAX,
}

STRING_COLUMNS = {SERVER, PROCESSOR, DISK}
METRIC_COLUMNS = {CPU, MEM, WRITES_AVG, WRITES_MAX, READS_AVG, READS_MAX}


@dataclass(frozen=True)
class MetricFamily:
    """One metric table: which source columns it has and how it is reported."""

    name: str
    source_columns: tuple[str, ...]
    # metric columns of the usage profiles, y then y2
    profile_metrics: tuple[str, ...]
    # metric and aggregate behind the host share (pie chart)
    share_metric: str
    share_agg: str  # "sum" or "avg"
    has_disk: bool = False

    @property
    def columns(self) -> list[str]:
        return [COLUMN_MAP[c] for c in self.source_columns]

    def source_schema(self, time_type: T.DataType = T.TimestampNTZType()) -> T.StructType:
        fields = []
        for c in self.source_columns:
            internal = COLUMN_MAP[c]
            if internal == TIME:
                dtype = time_type
            elif internal in STRING_COLUMNS:
                dtype = T.StringType()
            else:
                dtype = T.DoubleType()
            fields.append(T.StructField(c, dtype, True))
        return T.StructType(fields)


CPU_FAMILY = MetricFamily(
    name="cpu",
    source_columns=(SRC_SERVER, SRC_TIME, SRC_PROCESSOR, SRC_CPU),
    profile_metrics=(CPU,),
    share_metric=CPU,
    share_agg="sum",
)
MEM_FAMILY = MetricFamily(
    name="mem",
    source_columns=(SRC_SERVER, SRC_TIME, SRC_MEM),
    profile_metrics=(MEM,),
    share_metric=MEM,
    share_agg="avg",
)
DISK_FAMILY = MetricFamily(
    name="disk",
    source_columns=(SRC_SERVER, SRC_TIME, SRC_DISK, SRC_WRITES_AVG, SRC_WRITES_MAX,
                    SRC_READS_AVG, SRC_READS_MAX),
    profile_metrics=(WRITES_AVG, WRITES_MAX),
    share_metric=WRITES_AVG,
    share_agg="avg",
    has_disk=True,
)
FAMILIES = {f.name: f for f in (CPU_FAMILY, MEM_FAMILY, DISK_FAMILY)}

# The two disk charts of every (client, host, disk): (section, mean line, "MAX" line).
DISK_CHARTS = (("writes", WRITES_AVG, WRITES_MAX), ("reads", READS_AVG, READS_MAX))
