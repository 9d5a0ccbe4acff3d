import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "5")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(shared))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SEGMENTS = "seg_id bigint, session_id string, pos bigint, start_s double, end_s double, speaker string, text string"
NAMES = "session_id string, speaker string, display_name string"
CHUNKS = "session_id string, chunk_id bigint, speaker_span string, word_count bigint, text string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
