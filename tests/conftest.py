import pytest

from default_rows import DEFAULTS
from orderloom import get_session
from orderloom.schemas import RAW


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session = get_session()
    session.sparkContext.setLogLevel("OFF")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return session


@pytest.fixture
def conf(spark):
    """Set Spark settings for one test."""
    saved = {}

    def set_conf(**values):
        for key, value in values.items():
            key = "spark.sql." + key.replace("__", ".")
            saved.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_conf
    for key, value in saved.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def raw(spark):
    """Raw tables as text: one default row each, or the rows given as changes to the default."""

    def build(**tables):
        out = {}
        for name in RAW:
            changes = tables.get(name, [{}])
            ddl = ", ".join(f"{c} STRING" for c in DEFAULTS[name])
            rows = [tuple({**DEFAULTS[name], **row}.values()) for row in changes]
            out[name] = spark.createDataFrame(rows, ddl)
        return out

    return build


@pytest.fixture
def build(raw):
    """All silver, staging and mart tables of raw tables given like in ``raw``."""
    from orderloom.plans.marts import build_marts
    from orderloom.plans.silver import build_silver
    from orderloom.plans.staging import build_staging

    def run(**tables):
        silver = build_silver(raw(**tables))
        staging = build_staging(silver)
        return {**silver, **staging, **build_marts(staging)}

    return run
