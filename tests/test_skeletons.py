"""The composed form is the engine's, equal to Python's."""

import random
import sys
import unicodedata

from pyspark.sql import functions as F

from scriptorium.functions import letters as A
from scriptorium.plans import catalogue

from .test_max_sim import plan


def test_composed_form_in_the_engine(spark):
    rng = random.Random(7)
    assigned = [chr(i) for i in range(sys.maxunicode + 1) if unicodedata.category(chr(i)) not in ("Cn", "Cs")]
    moved = [c for c in assigned if unicodedata.combining(c) or unicodedata.decomposition(c)]
    texts = ["".join(rng.choice(moved if rng.random() < 0.7 else assigned) for _ in range(20)) for _ in range(20_000)] + assigned + ["", None]
    df = spark.createDataFrame([(t, t and unicodedata.normalize("NFC", t)) for t in texts], "t string, want string")
    assert df.filter(~A.nfc(F.col("t")).eqNullSafe(F.col("want"))).count() == 0


def test_skeletons_need_no_python(spark, small):
    assert "Python" not in plan(catalogue.QUERIES["arabic_skeletons"](spark, small))
