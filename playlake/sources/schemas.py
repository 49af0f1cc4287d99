"""Declared columns of the two inputs and the five tables."""

# Field names and types of the input files. `registration` holds epoch
# milliseconds, which a 32-bit float cannot, so it is a double.
SONG_SCHEMA = """
    num_songs INT,
    artist_id STRING,
    artist_latitude FLOAT,
    artist_longitude FLOAT,
    artist_location STRING,
    artist_name STRING,
    song_id STRING,
    title STRING,
    duration STRING,
    year STRING
"""

LOG_SCHEMA = """
    artist STRING,
    auth STRING,
    firstName STRING,
    gender STRING,
    itemInSession INT,
    lastName STRING,
    length FLOAT,
    level STRING,
    location STRING,
    method STRING,
    page STRING,
    registration DOUBLE,
    sessionId INT,
    song STRING,
    status INT,
    ts STRING,
    userAgent STRING,
    userId STRING
"""

# Columns as stored; partition columns come last.
TABLE_SCHEMAS = {
    "songs": "song_id STRING, title STRING, duration STRING, year STRING, artist_id STRING",
    "artists": "artist_id STRING, name STRING, location STRING, latitude FLOAT, longitude FLOAT",
    "users": "user_id STRING, first_name STRING, last_name STRING, gender STRING, level STRING",
    "time": "ts STRING, start_time TIMESTAMP, hour INT, day INT, week INT, weekday INT, "
    "year INT, month INT",
    "song_plays": "start_time TIMESTAMP, user_id STRING, level STRING, song_id STRING, "
    "artist_id STRING, session_id INT, location STRING, user_agent STRING, songplay_id BIGINT",
}

PARTITION_COLUMNS = {"songs": ["year", "artist_id"], "time": ["year", "month"]}
