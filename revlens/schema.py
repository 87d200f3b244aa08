"""Table shapes shared by the stages."""

from pyspark.sql import types as T

REVIEW_FIELDS = (
    "review_id", "product_id", "product_name", "source_language", "rating", "title", "body",
)

#: A valid review. ``seq`` is its place in the source and stands for the order
#: of the records in every later stage; it is unique, ``review_id`` need not be.
REVIEW = T.StructType(
    [T.StructField("seq", T.LongType())]
    + [
        T.StructField(name, T.IntegerType() if name == "rating" else T.StringType())
        for name in REVIEW_FIELDS
    ]
)

VIOLATION = "struct<path:string,message:string>"
TRANSLATION = "struct<title:string,body:string,engine:string>"
TRANSLATIONS = f"map<string,{TRANSLATION}>"
QUALITY = "map<string,struct<score:double,kept:boolean>>"

#: All checked records in one table, partitioned by ``valid``.
RECORDS = T.StructType(
    [
        *REVIEW.fields,
        T.StructField(
            "violations",
            T.ArrayType(
                T.StructType(
                    [T.StructField("path", T.StringType()), T.StructField("message", T.StringType())]
                )
            ),
        ),
        T.StructField("valid", T.BooleanType()),
    ]
)
