import pytest


@pytest.fixture(scope="session")
def shared_spark(tmp_path_factory):
    """A session whose shared folder is set, as on a cluster."""
    from pyspark.sql import SparkSession

    from bindery.session import local_session

    active = SparkSession.getActiveSession()
    if active is not None and active.conf.get("spark.checkpoint.dir", None):
        return active
    if active is not None:
        active.stop()
    return local_session("8", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
