"""Settings of a session."""

from __future__ import annotations

import pytest

from parcelpay.session import ADVISORY_BYTES, ADVISORY_KEY, byte_count, tune


@pytest.mark.parametrize("text, size", [("64MB", 64 << 20), ("8m", 8 << 20), ("67108864b", 64 << 20), ("16k", 16 << 10), ("5", 5), ("1g", 1 << 30)])
def test_sizes_are_read_as_spark_writes_them(text, size):
    assert byte_count(text) == size


def test_a_task_reads_a_bounded_piece_of_a_shuffle(spark, conf):
    conf(ADVISORY_KEY, "64MB")
    assert byte_count(tune(spark).conf.get(ADVISORY_KEY)) == ADVISORY_BYTES


def test_a_smaller_piece_stays(spark, conf):
    conf(ADVISORY_KEY, "16k")
    assert tune(spark).conf.get(ADVISORY_KEY) == "16k"
