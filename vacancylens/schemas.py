"""Explicit schemas; nothing in the engine infers a schema from data."""

from pyspark.sql import types as T

PLACE = T.StructType(
    [
        T.StructField(
            "country",
            T.StructType(
                [
                    T.StructField("code", T.StringType()),
                    T.StructField("name", T.StringType()),
                ]
            ),
        ),
        T.StructField("city", T.StringType()),
        T.StructField("street", T.StringType()),
        T.StructField("postalCode", T.StringType()),
        T.StructField("url", T.StringType()),
    ]
)

LOCATION = T.StructType(
    [
        T.StructField("places", T.ArrayType(PLACE)),
        T.StructField("fullyRemote", T.BooleanType()),
        T.StructField("covidTimeRemotely", T.BooleanType()),
    ]
)

SALARY = T.StructType(
    [
        T.StructField("from", T.DoubleType()),
        T.StructField("to", T.DoubleType()),
        T.StructField("type", T.StringType()),
        T.StructField("currency", T.StringType()),
    ]
)

LOGO = T.StructType(
    [
        T.StructField("original", T.StringType()),
        T.StructField("jobs_details", T.StringType()),
    ]
)

POSTING = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("location", LOCATION),
        T.StructField("posted", T.LongType()),
        T.StructField("renewed", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("technology", T.StringType()),
        T.StructField("logo", LOGO),
        T.StructField("category", T.StringType()),
        T.StructField("seniority", T.ArrayType(T.StringType())),
        T.StructField("url", T.StringType()),
        T.StructField("regions", T.ArrayType(T.StringType())),
        T.StructField("salary", SALARY),
        T.StructField("flavors", T.ArrayType(T.StringType())),
        T.StructField("topInSearch", T.BooleanType()),
        T.StructField("highlighted", T.BooleanType()),
        T.StructField("onlineInterviewAvailable", T.BooleanType()),
        T.StructField("referralBonus", T.DoubleType()),
        T.StructField("referralBonusCurrency", T.StringType()),
    ]
)

ENVELOPE = T.StructType(
    [
        T.StructField(
            "metadata",
            T.StructType(
                [
                    T.StructField("source_name", T.StringType()),
                    T.StructField("obtained_datetime", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "raw_data",
            T.StructType(
                [
                    T.StructField("postings", T.ArrayType(POSTING)),
                    T.StructField("totalCount", T.LongType()),
                ]
            ),
        ),
    ]
)

CITY = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
    ]
)

GAZETTEER = T.StructType(
    [
        T.StructField("alias", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
    ]
)

POSTING_LINE = T.StructType(
    [
        ENVELOPE["metadata"],
        T.StructField("document", T.StringType()),
        T.StructField("totalCount", T.LongType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("posting", POSTING),
    ]
)

#: What the lake knows of a document beside its postings.
_DOCUMENT_HEAD = [
    T.StructField("source_name", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("document", T.StringType()),
    T.StructField("obtained_datetime", T.TimestampType()),
    T.StructField("modified", T.TimestampType()),
    T.StructField("path", T.StringType()),
]

RAW_SNAPSHOT = T.StructType([*_DOCUMENT_HEAD, T.StructField("payload", T.StringType())])

ARCHIVED_POSTING = T.StructType(
    [*_DOCUMENT_HEAD, T.StructField("total", T.LongType()), T.StructField("pos", T.IntegerType()), *POSTING.fields]
)

ARCHIVED_HEAD = T.StructType(
    [
        *_DOCUMENT_HEAD,
        T.StructField("n_postings", T.LongType()),
        T.StructField("files", T.ArrayType(T.StringType())),
        T.StructField("payload_files", T.ArrayType(T.StringType())),
        T.StructField("archived", T.LongType()),
        T.StructField("batch", T.StringType()),
    ]
)

METADATA = T.StructType(
    [
        T.StructField("source_name", T.StringType()),
        T.StructField("obtained_datetime", T.TimestampType()),
    ]
)

SERVED = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("obtained_datetime", T.TimestampType()),
        T.StructField("run", T.StringType()),
        T.StructField("published", T.LongType()),
        T.StructField("batch", T.StringType()),
    ]
)

DOCUMENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("posted", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("technology", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("remote", T.BooleanType()),
        T.StructField("contract_type", T.StringType()),
        T.StructField("salary_min", T.DoubleType()),
        T.StructField("salary_max", T.DoubleType()),
        T.StructField("salary_mean", T.DoubleType()),
        T.StructField("city", T.ArrayType(CITY)),
        T.StructField("seniority", T.ArrayType(T.StringType())),
    ]
)
