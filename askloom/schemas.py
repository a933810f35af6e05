"""Explicit schemas of the tables that flows read and write."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("page", T.IntegerType()),
    T.StructField("text", T.StringType()),
])

CHUNKS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("page", T.IntegerType()),
    T.StructField("chunk_no", T.IntegerType()),
    T.StructField("text", T.StringType()),
])

# Files that could not be read.
ERRORS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("error", T.StringType()),
])

VECTOR = T.ArrayType(T.FloatType())

INDEX = T.StructType(CHUNKS.fields + [T.StructField("embedding", VECTOR)])

QUESTIONS = T.StructType([
    T.StructField("question", T.StringType()),
    T.StructField("ground_truth", T.StringType()),
])

# The column names of the result table and of the run log.
RESULTS = T.StructType([
    T.StructField("question_originale", T.StringType()),
    T.StructField("question_anglais", T.StringType()),
    T.StructField("reponse_rag", T.StringType()),
    T.StructField("ground_truth", T.StringType()),
])

RUNS = T.StructType([
    T.StructField("run_name", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    T.StructField("artifact", T.StringType()),
])
