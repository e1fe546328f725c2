"""Column layouts of the envelopes that come in and of the log table.

An OTLP any-value is a struct with one field per kind, of which one is set, so
the usual values are read and written without any parsing of their own.  Kinds
nest without end and Spark structs cannot, so containers are typed one level
deep and what lies deeper is a ``variant``.  Attributes stay an array of
key/value structs: a key may repeat and the first one counts, which a map
cannot hold.
"""

# 64-bit integers are strings in OTLP/JSON.
_SCALARS = "stringValue:string,boolValue:boolean,intValue:string,doubleValue:double,bytesValue:string"
ELEMENT = f"struct<{_SCALARS},arrayValue:variant,kvlistValue:variant>"
ANY_VALUE = (
    f"struct<{_SCALARS},arrayValue:struct<values:array<{ELEMENT}>>,"
    f"kvlistValue:struct<values:array<struct<key:string,value:{ELEMENT}>>>>"
)
ATTRIBUTES = f"array<struct<key:string,value:{ANY_VALUE}>>"

RESOURCE = f"struct<attributes:{ATTRIBUTES},droppedAttributesCount:int>"
SCOPE = f"struct<name:string,version:string,attributes:{ATTRIBUTES},droppedAttributesCount:int>"

LOG_RECORD = (
    "struct<timeUnixNano:string,observedTimeUnixNano:string,"
    f"severityNumber:int,severityText:string,body:{ANY_VALUE},"
    f"attributes:{ATTRIBUTES},droppedAttributesCount:int,flags:bigint,"
    "traceId:string,spanId:string,eventName:string>"
)
SCOPE_LOGS = f"struct<scope:{SCOPE},logRecords:array<{LOG_RECORD}>,schemaUrl:string>"

OTLP_LOGS = f"resourceLogs array<struct<resource:{RESOURCE},scopeLogs:array<{SCOPE_LOGS}>,schemaUrl:string>>"

# Traces are only routed and passed on, so everything below the resource is opaque.
OTLP_TRACES = f"resourceSpans array<struct<resource:{RESOURCE},scopeSpans:variant,schemaUrl:string>>"

# Column of scanned envelopes: the text of a line that is not a proper envelope, else NULL.
REJECTED = "rejected"

# Attribute keys, table name and limits a reader or writer may rely on.
RUN_ID_KEY = "agenticrun.uid"
PHASE_KEY = "agenticrun.phase"
EVENT_KEY = "event"
DEFAULT_SCHEMA = "templogs"
DEFAULT_TABLE = "logs"
DEFAULT_LIMIT = 100
MAX_LIMIT = 1000

# What a reader gets back, in this order.
RECORD_COLUMNS = ["id", "phase", "timestamp", "event", "body"]

# What the table holds; the last three are never shown to readers.  ``bucket`` and
# ``era`` partition it: a hash of the run, and a range of ids.
TABLE_COLUMNS = ["id", "agentic_run_id", "phase", "timestamp", "event", "body", "batch_id", "bucket", "era"]
TABLE_DDL = (
    "id BIGINT, agentic_run_id STRING, phase STRING DEFAULT '', timestamp TIMESTAMP, "
    "event STRING, body VARIANT, batch_id BIGINT, bucket INT, era BIGINT"
)
