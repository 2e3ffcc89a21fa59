"""Explicit schemas for every dataset the package reads or produces.

Log fields arrive as text; reports convert them where they are used, so a
malformed value turns into NULL instead of failing the job.
"""

from pyspark.sql import types as T

# The members of a log record's ``fields``, in the order used by
# the flat ``logs`` frame.
LOG_FIELDS = [
    "LogId",
    "AppId",
    "AppName",
    "CustomerID",
    "Contract",
    "Session",
    "Mac",
    "MenuSession",
    "PlayingSession",
    "Screen",
    "SubMenuId",
    "ItemId",
    "ChapterID",
    "Duration",
    "RealTimePlaying",
    "ElapsedTimePlaying",
    "ListOnFolder",
    "Folder",
    "Position",
]

FIELDS_STRUCT = T.StructType([T.StructField(n, T.StringType()) for n in LOG_FIELDS])

# Kafka dump: nested struct, event time as a timestamp.
RAW_KAFKA = T.StructType(
    [
        T.StructField("received_at", T.TimestampType()),
        T.StructField("fields", FIELDS_STRUCT),
    ]
)

# Archive: schemaless map of text values, event time as text.
RAW_ARCHIVE = T.StructType(
    [
        T.StructField("received_at", T.StringType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
    ]
)

# One flat, typed frame for both sources.
LOGS = T.StructType(
    [T.StructField("ts", T.TimestampType()), T.StructField("Date", T.DateType())]
    + [T.StructField(n, T.StringType()) for n in LOG_FIELDS]
)

CUS = T.StructType(
    [
        T.StructField("ID", T.LongType()),
        T.StructField("Area", T.IntegerType()),
        T.StructField("UType", T.StringType()),
    ]
)

LISTFOLDER = T.StructType(
    [T.StructField("MovieID", T.LongType()), T.StructField("Folder", T.IntegerType())]
)

FOL = T.StructType(
    [T.StructField("MenuID", T.IntegerType()), T.StructField("FolderID", T.IntegerType())]
)

VIEWS = T.StructType(
    [
        T.StructField("device", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("AppName", T.StringType()),
        T.StructField("ItemId", T.StringType()),
        T.StructField("duration", T.DecimalType(10, 2)),
        T.StructField("playing_session", T.TimestampType()),
    ]
)

TITLES = T.StructType(
    [
        T.StructField("ItemId", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("title_vie", T.StringType()),
    ]
)

# The members of one promotion in the feed.
VOUCHER_MEMBERS = [
    "id",
    "name",
    "eventCode",
    "discount",
    "fromDate",
    "toDate",
    "status",
    "quotaGeneralCode",
    "quotaPrivateCode",
    "images",
    "voucherType",
    "serviceType",
]

VOUCHER = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("eventCode", T.StringType()),
        T.StructField("discount", T.DoubleType()),
        T.StructField("fromDate", T.StringType()),
        T.StructField("toDate", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("quotaGeneralCode", T.StringType()),
        T.StructField("quotaPrivateCode", T.StringType()),
        T.StructField("images", T.StringType()),
        T.StructField("voucherType", T.StringType()),
        T.StructField("serviceType", T.StringType()),
    ]
)

VOUCHER_FEED = T.StructType([T.StructField("data", T.ArrayType(VOUCHER))])

# Device names of the view logs, in report order.
DEVICES = ["mobile", "box", "smarttv"]
