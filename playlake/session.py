"""Sessions: of a job's own, beside the caller's, and for the command line."""

from pyspark.sql import SparkSession

TIME_ZONE = "spark.sql.session.timeZone"


def child_session(spark: SparkSession, **settings: object) -> SparkSession:
    """A session beside `spark`, with its settings, catalogue and database, in which settings can be changed.

    Jobs that change settings do so in a session of their own, so two of them can run side by side and neither touches the
    caller's. Temporary views are not shared.
    """
    child = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name):
            child.conf.set(name, value)
    for name, value in settings.items():
        child.conf.set(name, value)
    database = spark.catalog.currentDatabase()
    if database != child.catalog.currentDatabase():
        child.catalog.setCurrentDatabase(database)
    return child


def utc_session(spark: SparkSession) -> SparkSession:
    """A child session whose calendar columns are in UTC, whatever the caller's zone is."""
    return child_session(spark, **{TIME_ZONE: "UTC"})


def build_session(app_name: str = "playlake") -> SparkSession:
    """Create or reuse a session whose calendar columns do not depend on the machine's time zone."""
    return (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
