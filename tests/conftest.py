import pytest

from siltworks.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Change session settings for one test."""
    before = {}

    def change(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def database(spark):
    """A database of its own for one test."""
    from siltworks.sources.tables import drop_database, ensure_database
    from siltworks.staging import staged_path

    name = "testing"
    ensure_database(spark, name, staged_path(spark, name))
    yield name
    spark.catalog.setCurrentDatabase("default")
    drop_database(spark, name)
