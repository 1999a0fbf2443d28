import pytest

#: A column whose name clashes with names that operators use inside, by upper case too.
CLASH = ["size", "row", "Text_", "rank", "spans"]


@pytest.fixture(scope="module")
def documents(spark):
    def make(rows, folder=None):
        """(doc_id, text) with further columns; written as a documents table if a folder is given."""
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(d, t) for d, t in rows], "doc_id long, text string")
        df = df.withColumns({"lang": F.lit("en"), "source": F.concat(F.lit("s"), (F.col("doc_id") % 3).cast("string")), "n_chars": F.char_length("text").cast("long")})
        df = df.withColumns({name: F.lit(1) for name in CLASH})
        if folder:
            df.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
        return df

    return make
