from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from gatewise.session import build_session  # noqa: E402

CAPTURE_SCHEMA = T.StructType([
    T.StructField("profile_id", T.LongType()),
    T.StructField("person_id", T.StringType()),
    T.StructField("profile_type", T.IntegerType()),
    T.StructField("member_tier", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.IntegerType()),
    T.StructField("capture_id", T.StringType()),
    T.StructField("camera_id", T.IntegerType()),
    T.StructField("region_id", T.StringType()),
    T.StructField("region_name", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("region_name_heatmap", T.StringType()),
    T.StructField("capture_time", T.TimestampNTZType()),
])


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = build_session("local[4]", 8, extra={"spark.checkpoint.dir": ckpt})
    yield s


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def capture(profile_id, when, region="ZONE 5", camera=5, cid=None, age=30, tier=None, ptype=2, gender=1,
            sector="Music"):
    """One raw capture row (region id = the number in the region name)."""
    rid = region.split()[-1]
    return (profile_id, f"P{profile_id}", ptype, tier, age, gender, cid or f"{profile_id}-{when}", camera, rid,
            region, sector, f"MAP {region}", ts(when))


def captures_df(spark, rows):
    return spark.createDataFrame(rows, CAPTURE_SCHEMA)
