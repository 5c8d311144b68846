"""Explicit schemas of the data model, for readers that must not infer."""

from pyspark.sql import types as T

FLAG = T.StructType([T.StructField(n, T.StringType()) for n in ("option", "short", "default_value", "description")])
ENTRY = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("objective", "command_name", "command", "description", "syntax")]
    + [T.StructField("flags", T.ArrayType(FLAG)), T.StructField("question", T.StringType()), T.StructField("chain_of_thought", T.StringType())]
)
FEW_SHOT = T.StructType([T.StructField("general_form", T.StringType()), T.StructField("instruction", T.StringType()), T.StructField("command", T.StringType()), T.StructField("specific", T.BooleanType()), T.StructField("chain_of_thought", T.StringType())])
SUBSTITUTION = T.StructType([T.StructField("d-sub", T.StringType()), T.StructField("c-sub", T.StringType())])
RULE_SET = T.MapType(T.StringType(), T.ArrayType(SUBSTITUTION))
TOC = T.StructType([T.StructField("chapter_metadata", T.ArrayType(T.StructType([T.StructField("title", T.StringType()), T.StructField("parts", T.ArrayType(T.StructType([T.StructField("title", T.StringType()), T.StructField("parts", T.ArrayType(T.StringType()))])))])))])
VECTOR = T.StructType([T.StructField("id", T.StringType()), T.StructField("values", T.ArrayType(T.FloatType())), T.StructField("metadata", T.StructType([T.StructField("text", T.StringType()), T.StructField("date_uploaded", T.TimestampNTZType())]))])
NESTED = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("command", "description", "syntax")]
    + [T.StructField("flags", T.ArrayType(FLAG)), T.StructField("examples", T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("description", "code", "cot")] + [T.StructField("questions", T.ArrayType(T.StringType()))])))]
)
