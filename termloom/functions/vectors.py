"""Sparse vectors as text (``word_id:weight;word_id:weight``) and as JSON, both ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VECTOR_TYPE = "array<struct<word_id:bigint,weight:double>>"
DOCUMENT_TYPE = "struct<id:string,title:string,url:string,docLength:bigint,vectorized:string>"


def encode(vector: Column) -> Column:
    return F.array_join(
        F.transform(vector, lambda e: F.concat_ws(":", e["word_id"].cast("string"), e["weight"].cast("string"))),
        ";",
    )


def decode(text: Column) -> Column:
    def element(part: Column) -> Column:
        # Searches for the sign; split_part() makes an array of the parts each time. Without the sign there is no number.
        weight = F.when(F.contains(part, F.lit(":")), F.substring_index(part, ":", -1)).otherwise("")
        return F.struct(
            F.substring_index(part, ":", 1).cast("long").alias("word_id"), weight.cast("double").alias("weight")
        )

    return F.when(text == "", F.array().cast(VECTOR_TYPE)).otherwise(F.transform(F.split(text, ";"), element))


def encode_list(numbers: Column) -> Column:
    """``1,20,3`` of an array of whole numbers."""
    return F.array_join(numbers.cast("array<string>"), ",")


def decode_list(text: Column) -> Column:
    none = F.array().cast("array<bigint>")
    return F.when(text == "", none).otherwise(F.split(text, ",").cast("array<bigint>"))


def document_json(id: Column, title: Column, url: Column, doc_length: Column, vector: Column) -> Column:
    return F.to_json(
        F.struct(
            id.alias("id"),
            title.alias("title"),
            url.alias("url"),
            doc_length.alias("docLength"),
            encode(vector).alias("vectorized"),
        )
    )


def parse_document_json(text: Column) -> Column:
    return F.from_json(text, DOCUMENT_TYPE, {"mode": "FAILFAST"})
