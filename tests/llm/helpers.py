"""Tables of awkward rows."""

from pyspark.sql import types as T

DOC = "doc_id long, text string, lang string, source string, n_chars long, id long, mark long, score double"


def documents(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    full = [(i, t, "en", "s", len(t) if t is not None else None, 7, 8, 0.5) for i, t in rows]
    return spark.createDataFrame(full, DOC)


def vectors(spark, rows):
    shape = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("score", T.StringType()), T.StructField("id", T.StringType())])
    return spark.createDataFrame([(i, v, lab, "x", "y") for i, v, lab in rows], shape)


LONG = " ".join(f"w{k % 977}" for k in range(40_000))
AWKWARD = ["", None, " \n\t ", "one", "a b c d e", "tie tie tie tie tie tie", "Zoë’s naïve 日本語 text 👩‍👩‍👧 \x1c!\x85 end", "<|endoftext|> mid <|startoftext|>", LONG]
