"""Bands of the near-duplicate search follow the similarity asked for."""

import pytest

from starling.llm import minhash


@pytest.mark.parametrize("similarity", [0.6, 0.7, 0.8, 0.85, 0.9])
def test_pairs_at_the_similarity_share_a_band(similarity):
    bands, rows = minhash.bands_for(similarity)
    assert bands * rows <= minhash.REGISTERS and (1 - similarity ** rows) ** bands <= 1e-5


def test_bands_of_the_operator_and_the_pipeline():
    assert minhash.bands_for(0.85) == (36, 7) and minhash.bands_for(0.8) == (42, 6)


def test_the_pipelines_similarity_reaches_the_bands(spark):
    rows = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(80)))], "doc_id long, text string")
    classes = minhash.sketches(rows, "doc_id", "text", 5)
    assert minhash._banded(classes, 0.8).count() == 42 and minhash._banded(classes, 0.85).count() == 36
