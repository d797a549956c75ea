import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[4]").appName("interlog-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "4g")
         .config("spark.sql.ui.retainedExecutions", "20")
         .config("spark.ui.retainedJobs", "50")
         .config("spark.ui.retainedStages", "50")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from interlog.session import checkpoint_dir
    checkpoint_dir(s)
    yield s


def rows_frame(spark, rows, cols="row_id long, user_id long, timestamp long, content_id long, content_type_id long, "
                                 "answered_correctly long, prior_question_elapsed_time double"):
    return spark.createDataFrame(rows, cols)
