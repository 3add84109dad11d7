import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from sparkngram.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, app="sparkngram-tests")
    yield s


TOY = (["SOS buy the book EOS"] * 4 + ["SOS sell the book EOS"] + ["SOS buy the house EOS"] * 2
       + ["SOS paint the house EOS"])


@pytest.fixture(scope="session")
def toy_counts(spark):
    """Document-frequency counts (each line a document, case kept, blank split)."""
    from pyspark.sql import functions as F
    from sparkngram.operators.ngrams import count_ngrams
    df = spark.createDataFrame([(i, line) for i, line in enumerate(TOY)], "line_no int, line string")
    df = df.select("line_no", F.split("line", " ").alias("tokens"))
    return count_ngrams(df, "tokens", (1, 2, 3), doc_freq=True).cache()
