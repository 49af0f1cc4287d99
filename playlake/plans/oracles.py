"""For each registered query, the same result in DuckDB SQL on the given tables."""

# The linear star: customers as songs, nations as artists, urgent orders as plays.
LINEAR = """
    songs AS (
        SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS song_id, c_name AS title,
               CAST(c_nationkey AS VARCHAR) AS artist_id, c_mktsegment AS year, c_acctbal AS duration
        FROM customer
    ),
    artists AS (
        SELECT DISTINCT CAST(n_nationkey AS VARCHAR) AS artist_id, n_name AS name, n_regionkey AS location
        FROM nation
    ),
    log AS (
        SELECT *, epoch_us(o_orderdate) // 1000 AS ms, CAST(o_custkey AS VARCHAR) AS user_id,
               CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'free' ELSE o_orderstatus END AS level
        FROM orders
    ),
    plays AS (SELECT * FROM log WHERE o_orderpriority = '1-URGENT'),
    song_plays AS (
        SELECT make_timestamp(ms * 1000) AS start_time, p.user_id, p.level, s.song_id, s.artist_id,
               CAST(year(o_orderdate) AS INTEGER) AS session_id, o_orderstatus AS location,
               o_orderpriority AS user_agent
        FROM plays p
        JOIN customer c ON c.c_custkey = p.o_custkey
        JOIN nation n ON n.n_nationkey = c.c_nationkey
        JOIN songs s ON s.title = c.c_name
        JOIN artists a ON a.name = n.n_name
    )"""

USERS = """
    SELECT DISTINCT user_id, o_orderstatus AS first_name, 'customer ' || user_id AS last_name,
           o_orderstatus AS gender, level
    FROM {log}"""

# The fan-out star: parts as songs, brands as artists with one row per part type, purchases as plays.
FANOUT = """
    songs AS (
        SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS song_id, p_name AS title, p_brand AS artist_id,
               p_size AS year
        FROM part
    ),
    artists AS (SELECT DISTINCT p_brand AS artist_id, p_brand AS name, p_type AS location FROM part),
    log AS (
        SELECT p_name AS song, p_brand AS artist
        FROM events JOIN part ON p_partkey = CAST(json_extract(props, '$.k') AS BIGINT)
        WHERE event_type = 'purchase'
    )"""

CALENDAR = """
    CAST(ms AS VARCHAR) AS ts, make_timestamp(ms * 1000) AS start_time,
    CAST(hour(make_timestamp(ms * 1000)) AS INTEGER) AS hour,
    CAST(day(make_timestamp(ms * 1000)) AS INTEGER) AS day,
    CAST(week(make_timestamp(ms * 1000)) AS INTEGER) AS week,
    CAST(month(make_timestamp(ms * 1000)) AS INTEGER) AS month,
    CAST(year(make_timestamp(ms * 1000)) AS INTEGER) AS year,
    CAST(dayofweek(make_timestamp(ms * 1000)) + 1 AS INTEGER) AS weekday"""

FACT = f"WITH {LINEAR} SELECT * FROM song_plays"

COUNTS = f"""
    WITH {LINEAR}, users AS ({USERS.format(log="plays")})
    SELECT 'Songs:' AS label, count(*) AS n FROM songs
    UNION ALL SELECT 'Users:', count(*) FROM users
    UNION ALL SELECT 'Time:', count(DISTINCT ms) FROM plays
    UNION ALL SELECT 'SongsPlays:', count(*) FROM song_plays
    UNION ALL SELECT 'Artists:', count(*) FROM artists"""

RECONCILED = "SELECT label, n AS recorded, n AS written, 'ok' AS status FROM ({counts})"

# The job reads artists from song metadata, so an artist without a song has no row there.
JOB_COUNTS = COUNTS.replace(
    "FROM nation\n", "FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)\n"
)

# Fixed values in the statements: the wording of messages and labels, as in functions/messages.py and audit.py.
TOP_SONGS = f"""
    WITH {LINEAR},
    ranked AS (
        SELECT song_id, plays, row_number() OVER (ORDER BY plays DESC, song_id) AS place
        FROM (SELECT song_id, count(*) AS plays FROM song_plays GROUP BY song_id)
    )
    SELECT DISTINCT format('"{{}}" by {{}} played {{}} times.', title, name, plays) AS message
    FROM ranked NATURAL JOIN songs JOIN artists USING (artist_id)
    WHERE place <= 10"""

TOP_ARTISTS = f"""
    WITH {LINEAR},
    ranked AS (
        SELECT artist_id, plays, row_number() OVER (ORDER BY song_id DESC, artist_id) AS place
        FROM (SELECT DISTINCT artist_id, song_id, count(*) OVER (PARTITION BY artist_id, song_id) AS plays FROM song_plays)
        WHERE song_id IN (SELECT song_id FROM songs)
    )
    SELECT DISTINCT format('"{{}}" was played {{}} times.', name, plays) AS message
    FROM ranked JOIN artists USING (artist_id)
    WHERE place <= 10"""

JOB_ARTISTS = LINEAR.replace(
    "FROM nation\n", "FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)\n"
)

ORACLES = {
    "json_scan": """
        SELECT CAST(NULL AS VARCHAR) AS artist, CAST(NULL AS VARCHAR) AS auth,
               'n' || user_id AS "firstName", CAST(NULL AS VARCHAR) AS gender,
               CAST(event_id % 7 AS INTEGER) AS "itemInSession", CAST(NULL AS VARCHAR) AS "lastName",
               CAST(value AS FLOAT) AS length, CAST(NULL AS VARCHAR) AS level,
               CAST(NULL AS VARCHAR) AS location, 'PUT' AS method, event_type AS page,
               CAST(event_id AS DOUBLE) AS registration, CAST(NULL AS INTEGER) AS "sessionId", props AS song,
               CAST(CASE WHEN event_id % 2 = 0 THEN 200 END AS INTEGER) AS status,
               CAST(epoch_us(ts) // 1000 AS VARCHAR) AS ts, CAST(NULL AS VARCHAR) AS "userAgent",
               CAST(user_id AS VARCHAR) AS "userId"
        FROM events""",
    "json_scan_songs": """
        SELECT 1 AS num_songs, p_brand AS artist_id, CAST(p_retailprice AS FLOAT) AS artist_latitude,
               CAST(-p_retailprice AS FLOAT) AS artist_longitude, p_type AS artist_location,
               CAST(NULL AS VARCHAR) AS artist_name, CAST(p_partkey AS VARCHAR) AS song_id, p_name AS title,
               CAST(p_size AS VARCHAR) AS duration, CAST(p_size AS VARCHAR) AS year
        FROM part""",
    "filter_page": "SELECT * FROM events WHERE event_type = 'purchase'",
    "dim_songs": """
        SELECT DISTINCT p_name AS song_id, p_name AS title, p_brand AS artist_id,
               CAST(p_size AS VARCHAR) AS year, CAST(p_size AS VARCHAR) AS duration
        FROM part""",
    "dim_artists": """
        SELECT DISTINCT p_brand AS artist_id, p_brand AS name, p_type AS location,
               CAST(NULL AS FLOAT) AS latitude, CAST(NULL AS FLOAT) AS longitude
        FROM part""",
    "dim_users": f"WITH {LINEAR} {USERS.format(log='log')}",
    "dim_time": f"SELECT {CALENDAR} FROM (SELECT DISTINCT epoch_us(ts) // 1000 AS ms FROM events)",
    "fact_plays": FACT,
    "fact_fanout": f"""
        WITH {FANOUT}
        SELECT s.song_id, count(*) AS plays
        FROM log l JOIN songs s ON l.song = s.title JOIN artists a ON l.artist = a.name
        GROUP BY s.song_id""",
    "fact_row_id": f"""
        WITH {LINEAR} SELECT count(*) AS n_rows, count(*) AS n_ids, true AS non_negative FROM song_plays""",
    "top_songs": TOP_SONGS,
    "top_artists": TOP_ARTISTS,
    "top_artists_by_plays": f"""
        WITH {LINEAR},
        top AS (
            SELECT artist_id, count(*) AS plays FROM song_plays
            GROUP BY artist_id ORDER BY plays DESC, artist_id LIMIT 10
        )
        SELECT '"' || a.name || '" was played ' || t.plays || ' times.' AS message
        FROM top t JOIN artists a ON t.artist_id = a.artist_id
        GROUP BY t.artist_id, a.name, t.plays""",
    "free_paid_ratio": f"""
        WITH {LINEAR}, users AS ({USERS.format(log="log")}),
        counts AS (
            SELECT count(user_id) FILTER (level = 'free') AS free,
                   count(user_id) FILTER (level = 'paid') AS paid
            FROM users
        )
        SELECT 'Ratio: ' AS label, 'Free users: ' || free AS free_users,
               'Paid users: ' || paid AS paid_users,
               (free / nullif(paid, 0)) || ':' || (paid / nullif(paid, 0)) AS ratio
        FROM counts""",
    "table_counts": COUNTS,
    "view_counts": f"{COUNTS} UNION ALL SELECT 'Log:', count(*) FROM plays",
    "catalog_counts": COUNTS,
    "reconcile_counts": RECONCILED.format(counts=COUNTS),
    "parquet_partitioned": """
        SELECT CAST(p_partkey AS VARCHAR) AS song_id, p_name AS title, CAST(p_size AS VARCHAR) AS duration,
               CAST(p_size AS VARCHAR) AS year, p_brand AS artist_id
        FROM part""",
    "parquet_partitioned_time": f"""
        SELECT {CALENDAR} FROM (SELECT DISTINCT epoch_us(o_orderdate) // 1000 AS ms FROM orders)""",
    "parquet_plain": "SELECT * FROM customer",
    "csv_counts": COUNTS,
    "csv_report": TOP_SONGS,
    "etl_reconciliation": RECONCILED.format(counts=JOB_COUNTS),
    "etl_song_plays": FACT,
    "catalog_join": f"""
        WITH {LINEAR}
        SELECT s.artist_id, s.year, s.title, count(*) AS plays
        FROM song_plays p JOIN songs s USING (song_id, artist_id) GROUP BY ALL""",
    "etl_songs": f"""
        WITH {LINEAR}
        SELECT song_id, title, CAST(duration AS VARCHAR) AS duration, year, artist_id FROM songs""",
    "etl_artists": f"""
        WITH {JOB_ARTISTS}
        SELECT artist_id, name, CAST(location AS VARCHAR) AS location, CAST(NULL AS FLOAT) AS latitude,
               CAST(NULL AS FLOAT) AS longitude
        FROM artists""",
    "etl_users": f"WITH {LINEAR} {USERS.format(log='plays')}",
    "etl_time": f"WITH {LINEAR} SELECT {CALENDAR} FROM (SELECT DISTINCT ms FROM plays)",
    "etl_top_songs": TOP_SONGS,
    "etl_top_artists": TOP_ARTISTS,
    "etl_counts": JOB_COUNTS,
}

# As read back from CSV: the writer trims blanks at the end of a value, and the job's users are those with plays.
ORACLES["etl_top_artists_by_plays"] = ORACLES["top_artists_by_plays"]
ORACLES["etl_ratio"] = (
    ORACLES["free_paid_ratio"].replace(USERS.format(log="log"), USERS.format(log="plays")).replace("'Ratio: '", "'Ratio:'")
)
