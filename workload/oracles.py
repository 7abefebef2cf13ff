"""The same results in plain SQL, written independently of the operators."""

from __future__ import annotations

from workload.roles import FEATURE_AGGREGATES, FEATURES, PLAYLIST_SIZE

NUMBERS = ", ".join(FEATURES)
TARGET = f"track_id, track_name, artist_name, duration_ms, {NUMBERS}"


def _with(*parts: str, select: str) -> str:
    return f"WITH {', '.join(parts)} {select}"


def _word(text: str, word: int) -> str:
    return f"CAST(('0x' || substr(md5({text}), {8 * word + 1}, 8)) AS BIGINT)"


def _row_hash(keys: list[str], seed: int) -> str:
    return _word(" || '|' || ".join([*[f"CAST({k} AS VARCHAR)" for k in keys], f"'{seed}'"]), 0)


# --- catalogue -----------------------------------------------------------------

ITEM = "item AS (SELECT l_partkey, {} FROM lineitem GROUP BY l_partkey)".format(
    ", ".join(
        f"CAST(sum(CAST(round({column} * 100) AS BIGINT)) AS BIGINT) * 10000 // count({column}) / 1e6 AS {name}"
        if how == "avg"
        else f"{how}({column}) AS {name}"
        for name, (how, column) in FEATURE_AGGREGATES.items()
    )
)
BASE = f"""base AS (
    SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS tid, p_name, p_brand, p_type,
           round(p_retailprice * CAST(700.0 AS DOUBLE), 2) AS ms, {NUMBERS}
    FROM part LEFT JOIN item ON p_partkey = l_partkey)"""
NO_TEMPO = ", ".join(f for f in FEATURES if f != "tempo")
CONFORMED = f"""conformed AS (
    SELECT tid AS track_id, p_name AS track_name, CAST(NULL AS VARCHAR) AS artist_name, ms AS duration_ms, {NUMBERS},
           CAST(0 AS INTEGER) AS source_rank FROM base
    UNION ALL
    SELECT tid, CASE WHEN k % 2 = 0 THEN '  ' || upper(p_name) || ' ' ELSE p_name END, p_brand,
           CASE WHEN k % 5 = 0 THEN NULL ELSE ms END, {NUMBERS}, 1 FROM base
    UNION ALL
    SELECT tid, p_name, p_brand, ms, {NO_TEMPO}, CASE WHEN k % 4 <> 0 THEN tempo END, 2 FROM base
    UNION ALL
    SELECT tid, p_name, CASE WHEN k % 7 = 0 THEN NULL WHEN k % 11 = 0 THEN ' ' ELSE p_brand END, ms, {NUMBERS}, 3
    FROM base
    UNION ALL
    SELECT CASE WHEN k % 9 <> 0 THEN tid END, p_type, p_brand, ms + 1000.0, {NUMBERS}, 4 FROM base)"""
COMPLETENESS = " + ".join(
    f"CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END" for c in TARGET.split(", ") if c != "track_id"
)
TIES = ", ".join(f"{c} ASC NULLS LAST" for c in TARGET.split(", ") if c != "track_id")
MERGED = f"""merged AS (
    SELECT {TARGET} FROM (
        SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY
            CASE WHEN artist_name IS NOT NULL AND artist_name <> '' THEN 1 ELSE 0 END DESC,
            {COMPLETENESS} DESC, source_rank ASC, {TIES}) AS rn
        FROM conformed) WHERE rn = 1)"""


def _first_per_name(source: str, name: str) -> str:
    return f"""{name} AS (
    SELECT {TARGET} FROM (
        SELECT *, row_number() OVER (PARTITION BY track_name, artist_name ORDER BY track_id ASC NULLS LAST) AS rn
        FROM {source}) WHERE rn = 1)"""


COMPLETE = "complete AS (SELECT * FROM merged WHERE {})".format(" AND ".join(f"{f} IS NOT NULL" for f in FEATURES))
CLEANED = f"""cleaned AS (
    SELECT track_id, lower(trim(track_name)) AS track_name,
           lower(trim(CASE WHEN artist_name IS NULL OR trim(artist_name) = '' THEN 'Unknown Artist'
                      ELSE artist_name END)) AS artist_name,
           duration_ms AS duration, {NUMBERS}
    FROM named WHERE duration_ms BETWEEN 30000 AND 900000)"""
CATALOG = [ITEM, BASE, CONFORMED, MERGED, COMPLETE, _first_per_name("complete", "named"), CLEANED]


def _unit(column: str, source: str) -> str:
    low, high = (f"(SELECT {f}({column}) FROM {source})" for f in ("min", "max"))
    return (
        f"CASE WHEN {low} = {high} THEN CASE WHEN {column} IS NOT NULL THEN CAST(0.5 AS DOUBLE) END "
        f"ELSE ({column} - {low}) / ({high} - {low}) END"
    )


def _scaled(column: str, source: str) -> str:
    return f"round({_unit(column, source)}, 6) AS {column}"


def _catalog_lane() -> str:
    scaled = ", ".join(_scaled(c, "cleaned") for c in ["duration", *FEATURES])
    return _with(*CATALOG, select=f"SELECT track_id, track_name, artist_name, {scaled} FROM cleaned")


def _fitted_scale() -> str:
    """Bounds and means of the third source; of its missing values the mean lies within the bounds."""

    def scaled(column: str) -> str:
        fit = "(SELECT {}(%s) FROM conformed WHERE source_rank = 2)" % column
        low, high, mean = (fit.format(f) for f in ("min", "max", "avg"))
        unit = f"(coalesce({column}, {mean}) - {low}) / nullif({high} - {low}, 0)"
        return f"round(coalesce(least(greatest({unit}, 0), 1), 0.5), 6) AS {column}"

    columns = ", ".join(scaled(c) for c in ["duration_ms", *FEATURES])
    return _with(ITEM, BASE, CONFORMED, select=f"SELECT track_id, track_name, {columns} FROM conformed WHERE source_rank = 4")


def _missing() -> str:
    columns = [*TARGET.split(", "), "source_rank"]
    union = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_missing, count(*) AS n FROM conformed"
        for c in columns
    )
    return _with(
        ITEM, BASE, CONFORMED,
        select=f"""SELECT "column", n_missing, round(n_missing * CAST(100.0 AS DOUBLE) / n, 6) AS pct
                   FROM ({union}) WHERE n_missing > 0""",
    )


def _correlations() -> str:
    pairs = [(b, a) for i, a in enumerate(FEATURES) for b in FEATURES[i + 1 :]]
    union = " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS corr FROM conformed"
        for a, b in pairs
    )
    return _with(ITEM, BASE, CONFORMED, select=union)


# --- profiles ------------------------------------------------------------------

PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DATASETS = ("part", "lineitem", "orders", "events", "documents", "embeddings")


def _shape() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{t}' AS dataset, (SELECT count(*) FROM {t}) AS n_rows,
            CAST((SELECT count(*) FROM (DESCRIBE SELECT * FROM {t})) AS INTEGER) AS n_columns"""
        for t in DATASETS
    )


def _schema() -> str:
    def one(t: str) -> str:
        return f"""SELECT '{t}' AS dataset, CAST(row_number() OVER () - 1 AS INTEGER) AS position,
            column_name AS "column",
            CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
                 WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>'
                 ELSE lower(column_type) END AS type
            FROM (DESCRIBE SELECT * FROM {t})"""

    return " UNION ALL ".join(one(t) for t in DATASETS)


def _statistics() -> str:
    def one(c: str) -> str:
        return f"""SELECT '{c}' AS feature, round(avg({c}), 6) AS mean,
            (SELECT round({c}, 6) FROM lineitem GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode,
            round(median({c}), 6) AS median, round(stddev_samp({c}), 6) AS std,
            round(min({c}), 6) AS min, round(max({c}), 6) AS max FROM lineitem"""

    return " UNION ALL ".join(one(c) for c in PROFILED)


def _histogram() -> str:
    def one(c: str) -> str:
        return f"""
        SELECT '{c}' AS feature, CAST(b AS INTEGER) AS bin,
               round(low + b * step, 6) AS lower, round(low + (b + 1) * step, 6) AS upper,
               count(v) AS n
        FROM (SELECT min({c}) AS low, (max({c}) - min({c})) / 50 AS step FROM lineitem) s
        CROSS JOIN range(50) t(b)
        LEFT JOIN (SELECT {c} AS v FROM lineitem) x
          ON v >= low + b * step AND (b = 49 OR v < low + (b + 1) * step)
        GROUP BY b, low, step"""

    return " UNION ALL ".join(one(c) for c in PROFILED)


# --- interactions --------------------------------------------------------------

ROWS = """entries AS (
    SELECT CAST(o_custkey AS VARCHAR) AS user_id, p_name || ' ' || CAST(p_partkey AS VARCHAR) AS trackname,
           CASE WHEN p_partkey % 17 <> 0 THEN p_brand END AS artistname
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""
COUNTS = """counts AS (
    SELECT user_id, trackname, artistname, count(*) AS play_count FROM entries
    WHERE user_id IS NOT NULL AND trackname IS NOT NULL AND artistname IS NOT NULL
    GROUP BY user_id, trackname, artistname)"""
ENCODED = """users AS (
    SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS INTEGER) AS user_code
    FROM (SELECT DISTINCT user_id FROM counts)),
songs AS (
    SELECT trackname, artistname,
           CAST(row_number() OVER (ORDER BY trackname || '||' || artistname, trackname) - 1 AS INTEGER) AS song_code
    FROM (SELECT DISTINCT trackname, artistname FROM counts)),
encoded AS (
    SELECT user_code AS user_id, song_code AS song_id, CAST(play_count AS DOUBLE) AS interaction,
           user_id AS user_id_original, trackname AS track_name, artistname AS artist_name
    FROM counts JOIN users USING (user_id) JOIN songs USING (trackname, artistname))"""
PLAYS = """plays AS (
    SELECT o_custkey AS user_id, l_partkey AS song_id, CAST(count(*) AS DOUBLE) AS interaction
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""
SPLIT = f"""hashed AS (SELECT *, {_row_hash(["user_id", "song_id"], 42)} AS h FROM plays),
splits AS (
    SELECT user_id, song_id, interaction,
           CASE WHEN h < CAST(round(0.8 * 4294967296) AS BIGINT) THEN 'train'
                WHEN h < CAST(round(0.9 * 4294967296) AS BIGINT) THEN 'test' ELSE 'validation' END AS split
    FROM hashed)"""
PAIRS = f"""pairs AS (
    SELECT user_id, song_id FROM splits WHERE split = 'validation'
    ORDER BY {_row_hash(["user_id", "song_id"], 42)}, user_id, song_id LIMIT 5000)"""
PAIR_TEXT = "CAST(user_id AS VARCHAR) || '|' || CAST(song_id AS VARCHAR) || '|42'"
CANDIDATES = f"""items AS (
    SELECT song_id, row_number() OVER (ORDER BY song_id) - 1 AS idx
    FROM (SELECT DISTINCT song_id FROM splits WHERE split = 'train')),
size AS (SELECT count(*) AS n FROM items),
prime AS (
    SELECT min(p) AS p FROM (SELECT n + i AS p FROM size, range(0, 1000) t(i))
    WHERE NOT EXISTS (SELECT 1 FROM range(2, 1000) d(d) WHERE d * d <= p AND p % d = 0)),
walk AS (
    SELECT user_id, song_id, j, ({_word(PAIR_TEXT, 0)} % p + ({_word(PAIR_TEXT, 1)} % (p - 1) + 1) * j) % p AS idx
    FROM pairs, prime, size, range(0, 2000) t(j) WHERE j < least(p, 100 + p - n)),
drawn AS (
    SELECT w.user_id, w.song_id, i.song_id AS candidate,
           row_number() OVER (PARTITION BY w.user_id, w.song_id ORDER BY j) AS draw
    FROM walk w JOIN items i ON w.idx = i.idx WHERE i.song_id <> w.song_id),
candidates AS (
    SELECT user_id, song_id, CAST(0 AS INTEGER) AS draw, song_id AS candidate FROM pairs
    UNION ALL
    SELECT user_id, song_id, CAST(draw AS INTEGER), candidate FROM drawn WHERE draw <= 99)"""


def _factors(source: str, key: str, size: int, where: str = "") -> str:
    return f"""SELECT id, list_transform(range(1, {size + 1}), lambda i:
        CAST((id % 8191 + 1) * (id % 8191 + 1 + i + {size}) * (i * 2 + 3) % 8191 - 4095 AS DOUBLE) / 4096) AS v
        FROM (SELECT CAST({key} AS BIGINT) AS id FROM {source} {where})"""


def _scored(size: int, name: str = "scored") -> str:
    return f"""{name}_u AS MATERIALIZED ({_factors("customer", "c_custkey", size)}),
{name}_i AS MATERIALIZED ({_factors("part", "p_partkey", size, "WHERE p_partkey % 50 <> 0")}),
{name} AS (
    SELECT c.candidate, c.user_id, c.song_id, c.draw,
           coalesce(round(list_dot_product(u.v, i.v), 9), CAST('-Infinity' AS DOUBLE)) AS score
    FROM candidates c JOIN {name}_u u ON c.user_id = u.id LEFT JOIN {name}_i i ON c.candidate = i.id)"""


def _ranks(scored: str = "scored", name: str = "ranks") -> str:
    return f"""{name} AS (
    SELECT n.user_id, n.song_id, CAST(1 + count(*) FILTER (WHERE n.draw > 0 AND n.score > p.score) AS INTEGER) AS rank,
           CAST(count(*) FILTER (WHERE n.draw > 0) AS INTEGER) AS n_negatives
    FROM {scored} n JOIN {scored} p ON n.user_id = p.user_id AND n.song_id = p.song_id AND p.draw = 0
    GROUP BY n.user_id, n.song_id)"""


METRICS = """coalesce(round(avg(CASE WHEN rank <= 10 THEN CAST(1 AS DOUBLE) ELSE 0 END), 6), 0) AS hr,
    coalesce(round(avg(CASE WHEN rank <= 10 THEN CAST(1 AS DOUBLE) / rank ELSE 0 END), 6), 0) AS mrr, count(*) AS n"""
EVALUATION = [PLAYS, SPLIT, PAIRS, CANDIDATES]
ALL_PAIRS = "pairs AS (SELECT user_id, song_id FROM splits WHERE split = 'validation')"
SCORES = f"""scores AS (
    SELECT user_id, song_id, split,
           CAST({_row_hash(["user_id", "song_id"], 7)} AS DOUBLE) / 4294967296 AS confidence_score FROM splits)"""

LONG_TAIL = f"""tail_u AS MATERIALIZED ({_factors("customer", "c_custkey", 16)}),
tail_i AS MATERIALIZED (
    SELECT id, list_transform(v, lambda x: x * pow(2.0, least(length(regexp_extract(bin(id), '0*$')), 5) - 5)) AS v
    FROM ({_factors("part", "p_partkey", 16)})),
products AS MATERIALIZED (
    SELECT u.id AS user_id, i.id AS song_id, round(list_dot_product(u.v, i.v), 9) AS score
    FROM tail_u u CROSS JOIN tail_i i
    WHERE NOT EXISTS (SELECT 1 FROM plays p WHERE p.user_id = u.id AND p.song_id = i.id))"""
# Round r of the search takes blocks 2^r - 1 to 2^(r+1) - 2; a user goes on to those whose
# longest item can reach the tenth best product of the blocks before the round.
BLOCKS_READ = """sized_u AS (SELECT id, sqrt(list_dot_product(v, v)) AS norm FROM tail_u),
sized_i AS (
    SELECT id, sqrt(list_dot_product(v, v)) AS norm,
        (row_number() OVER (ORDER BY sqrt(list_dot_product(v, v)) DESC, id) - 1) // 200 AS block FROM tail_i),
tops AS (SELECT block, max(norm) AS top, CAST(2 ** floor(log2(block + 1)) - 1 AS BIGINT) AS low FROM sized_i GROUP BY block),
starts AS (SELECT DISTINCT low FROM tops),
floors AS (
    SELECT user_id, low, min(score) AS floor FROM (
        SELECT user_id, low, score, row_number() OVER (PARTITION BY user_id, low ORDER BY score DESC, song_id) AS rk
        FROM products p JOIN sized_i i ON i.id = p.song_id JOIN starts s ON i.block < s.low)
    WHERE rk <= 10 GROUP BY user_id, low HAVING count(*) = 10)"""

# --- neighbours and content ----------------------------------------------------

VECTORS = """vectors AS (
    SELECT vec_id AS track_id, 'song ' || CAST(vec_id AS VARCHAR) AS track_name,
           'artist ' || CAST(label AS VARCHAR) AS artist_name, CAST(embedding AS DOUBLE[]) AS f FROM embeddings)"""
PLAYLIST = f"""playlist AS (
    SELECT track_id, track_name, artist_name FROM vectors
    ORDER BY {_row_hash(["track_id"], 42)}, track_id LIMIT {PLAYLIST_SIZE}),
seeds AS (SELECT * FROM vectors WHERE track_id IN (SELECT track_id FROM playlist))"""
NEAR = """near AS (
    SELECT * FROM (
        SELECT seed_id, dist, track_id, artist_name,
               row_number() OVER (PARTITION BY seed_id ORDER BY dist, track_id) AS rk
        FROM (SELECT s.track_id AS seed_id, v.track_id, v.artist_name, round(list_distance(v.f, s.f), 9) AS dist
              FROM seeds s CROSS JOIN vectors v)) WHERE rk <= 50)"""
SCORE = """score AS (
    SELECT v.track_id, round(avg(list_cosine_similarity(v.f, s.f)), 9) AS mean_cosine
    FROM vectors v CROSS JOIN seeds s GROUP BY v.track_id)"""
GROUP = """grouped AS (
    SELECT track_id, artist_name FROM vectors
    WHERE artist_name IN (SELECT artist_name FROM seeds) AND track_id NOT IN (SELECT track_id FROM seeds))"""
POOL = """pool AS (
    SELECT DISTINCT track_id, artist_name FROM (SELECT track_id, artist_name FROM near
    WHERE track_id NOT IN (SELECT track_id FROM seeds) UNION ALL SELECT * FROM grouped))"""
BLEND = """overall AS (
    SELECT track_id, mean_cosine, row_number() OVER (ORDER BY mean_cosine DESC, track_id) AS rk
    FROM pool JOIN score USING (track_id) ORDER BY rk LIMIT 40),
slots AS (
    SELECT track_id, mean_cosine, row_number() OVER (ORDER BY mean_cosine DESC, track_id) AS rk
    FROM grouped JOIN score USING (track_id) WHERE track_id NOT IN (SELECT track_id FROM overall)
    ORDER BY rk LIMIT 10)"""
CONTENT = [VECTORS, PLAYLIST, NEAR, SCORE, GROUP, POOL, BLEND]

# --- records -------------------------------------------------------------------

# Every thirteenth record was cut short when it was made: it cannot be decoded.
RECORDS = """good AS (
    SELECT event_id, 'T' || CAST(event_id AS VARCHAR) AS track_id,
           trim(upper(event_type) || ' ' || substr(props, 7, 1)) AS track_name,
           CASE WHEN event_id % 19 <> 0 THEN 'User ' || CAST(user_id AS VARCHAR) END AS artist_name,
           value * CAST(10.0 AS DOUBLE) AS duration,
           CASE WHEN event_id % 5 <> 0 THEN value END AS tempo,
           CASE WHEN event_id % 3 <> 0 THEN value END AS loudness,
           CASE WHEN event_id % 4 <> 0 THEN value END AS artist_familiarity,
           CASE WHEN event_id % 6 <> 0 THEN value END AS artist_hotttnesss,
           CASE WHEN event_id % 3 <> 0 THEN value * 2 END AS song_hotttnesss
    FROM events WHERE event_id % 13 <> 0)"""
FILES = """good AS (
    SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS track_id, upper(s_name) AS track_name,
           CASE WHEN s_suppkey % 19 <> 0 THEN 'Nation ' || CAST(s_nationkey AS VARCHAR) END AS artist_name,
           CAST(s_suppkey % 1000 + 25 AS DOUBLE) AS duration,
           CASE WHEN s_suppkey % 5 <> 0 THEN s_acctbal END AS tempo,
           CASE WHEN s_suppkey % 3 <> 0 THEN s_acctbal END AS loudness,
           CASE WHEN s_suppkey % 4 <> 0 THEN s_acctbal END AS artist_familiarity,
           CASE WHEN s_suppkey % 6 <> 0 THEN s_acctbal END AS artist_hotttnesss,
           CAST(s_nationkey AS DOUBLE) AS song_hotttnesss
    FROM supplier WHERE s_suppkey % 13 <> 0)"""


def _records_lane(good: str) -> str:
    numbers = ["duration", "tempo", "loudness", "artist_familiarity", "artist_hotttnesss", "song_hotttnesss"]
    imputed = ", ".join(f"coalesce({c}, (SELECT avg({c}) FROM rows)) AS {c}" for c in numbers)
    flags = ", ".join(f"{c} IS NULL AS {c}_was_null" for c in numbers)
    scaled = ", ".join(_scaled(c, "imputed") for c in numbers)
    kept = ", ".join(f"{c}_was_null" for c in numbers)
    rows = """named AS (
        SELECT *, row_number() OVER (PARTITION BY track_name, artist_name ORDER BY track_id) AS rn
        FROM good
        WHERE track_id IS NOT NULL AND track_name IS NOT NULL AND artist_name IS NOT NULL),
    rows AS (SELECT * REPLACE (lower(trim(track_name)) AS track_name, lower(trim(artist_name)) AS artist_name)
             FROM named WHERE rn = 1 AND duration BETWEEN 30 AND 900)"""
    return _with(
        good,
        rows,
        f"imputed AS (SELECT track_id, track_name, artist_name, {imputed}, {flags} FROM rows)",
        select=f"SELECT track_id, track_name, artist_name, {scaled}, {kept} FROM imputed",
    )


# --- whole lanes ---------------------------------------------------------------


def _catalog_recs() -> str:
    features = ", ".join(_unit(c, "cleaned") for c in ["duration", *FEATURES])
    songs = f"""vectors AS MATERIALIZED (
        SELECT track_id, track_name, artist_name, [{features}] AS f FROM cleaned WHERE track_id IS NOT NULL)"""
    return _with(
        *CATALOG, songs, PLAYLIST, NEAR, SCORE, GROUP, POOL, BLEND,
        select="""SELECT * EXCLUDE (copy) FROM (
            SELECT CASE part WHEN 0 THEN 'similar' ELSE 'same_group' END AS section, b.track_id, v.track_name,
                   v.artist_name, b.mean_cosine AS mean_cosine_score, CAST(rk AS INTEGER) AS rk,
                   row_number() OVER (PARTITION BY v.track_name, v.artist_name ORDER BY part, rk) AS copy
            FROM (SELECT 0 AS part, * FROM overall UNION ALL SELECT 1, * FROM slots) b
            JOIN vectors v ON b.track_id = v.track_id) WHERE copy = 1""",
    )


def _stages(*rows: tuple[str, str, str]) -> str:
    """Rows of a stage report: name, relation, number of columns, and the relation before, if any."""
    return " UNION ALL ".join(
        f"""SELECT CAST({i} AS INTEGER) AS stage_no, '{name}' AS stage, (SELECT count(*) FROM {source}) AS n_rows,
            CAST({columns} AS INTEGER) AS n_columns, {
                f"(SELECT count(*) FROM {before}) - (SELECT count(*) FROM {source})" if before else "CAST(0 AS BIGINT)"
            } AS n_removed"""
        for i, (name, source, columns, before) in enumerate(rows)
    )


def _catalog_report() -> str:
    each = [(f"source_{i + 1}", f"(SELECT * FROM conformed WHERE source_rank = {i})", 12, "") for i in range(5)]
    return _with(
        *CATALOG,
        select=_stages(
            *each,
            ("sources", "conformed", 13, ""),
            ("merged", "merged", 12, "conformed"),
            ("complete", "complete", 12, "merged"),
            ("unique_names", "named", 12, "complete"),
            ("cleaned", "cleaned", 12, "named"),
        ),
    )


PARTS = f"""parted AS (
    SELECT * EXCLUDE (h), CASE WHEN h < CAST(round(0.8 * 4294967296) AS BIGINT) THEN 'train'
        WHEN h < CAST(round(0.9 * 4294967296) AS BIGINT) THEN 'test' ELSE 'validation' END AS split
    FROM (SELECT *, {_row_hash(["user_id", "song_id"], 42)} AS h FROM encoded))"""


def _interaction_report() -> str:
    complete = "(SELECT * FROM entries WHERE artistname IS NOT NULL AND trackname IS NOT NULL AND user_id IS NOT NULL)"
    return _with(
        ROWS, COUNTS, ENCODED, PARTS,
        select=_stages(
            ("rows", "entries", 4, ""),
            ("complete", complete, 3, "entries"),
            ("interactions", "parted", 7, complete),
            ("users", "(SELECT DISTINCT user_id FROM parted)", 1, ""),
            ("songs", "(SELECT DISTINCT song_id FROM parted)", 1, ""),
            *[(p, f"(SELECT * FROM parted WHERE split = '{p}')", 7, "") for p in ("train", "test", "validation")],
        ),
    )


def _profile_datasets() -> str:
    names = ["track_id", "track_name", "artist_name"]
    numbers = ["duration", "tempo", "loudness", "artist_familiarity", "artist_hotttnesss", "song_hotttnesss"]
    described = {
        "merged": ("merged", TARGET.split(", "), FEATURES),
        "records": ("good", [*names, *numbers], ["loudness", "tempo"]),
    }
    rows = []
    for label, (source, columns, features) in described.items():
        def one(subject: str, measure: str, value: str) -> str:
            return f"SELECT '{label}' AS dataset, '{subject}' AS subject, '{measure}' AS measure, CAST(({value}) AS DOUBLE) AS value"

        keys = ", ".join(columns)
        rows.append(one("", "n_rows", f"SELECT count(*) FROM {source}"))
        rows.append(one("", "n_columns", str(len(columns))))
        rows.append(one("", "n_duplicates", f"SELECT sum(c - 1) FROM (SELECT count(*) AS c FROM {source} GROUP BY {keys})"))
        rows += [
            f"SELECT * FROM ({one(c, 'n_missing', f'SELECT count(*) FROM {source} WHERE {c} IS NULL')}) WHERE value > 0"
            for c in columns
        ]
        for f in features:
            for measure, sql in (("mean", "avg"), ("median", "median"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")):
                rows.append(one(f, measure, f"SELECT round({sql}({f}), 6) FROM {source}"))
            most = f"SELECT round({f}, 6) FROM {source} WHERE {f} IS NOT NULL GROUP BY {f} ORDER BY count(*) DESC, {f} LIMIT 1"
            rows.append(one(f, "mode", most))
    return _with(*CATALOG, RECORDS, select=" UNION ALL ".join(rows))


# Lines 6 and 7 of an order were written with a field too few or too many.
LINES = """lines AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS user_id, p_brand || ', ' || p_name AS artistname, p_name AS trackname,
           l_returnflag AS playlistname, l_linenumber
    FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def _list_checks(users: str) -> str:
    return f"""SELECT {users}, least(10, (SELECT count(*) FROM songs) - count(*)) AS n_songs,
        least(10, (SELECT count(*) FROM songs) - count(*)) AS n_distinct, CAST(0 AS BIGINT) AS n_played,
        CAST(0 AS BIGINT) AS n_rises, CAST(0 AS BIGINT) AS n_nameless
        FROM encoded GROUP BY {users} HAVING (SELECT count(*) FROM songs) > count(*)"""


ORACLES = {
    "content_recs": _with(
        *CONTENT,
        select="""SELECT section, b.track_id, v.track_name, v.artist_name,
            b.mean_cosine AS mean_cosine_score, CAST(rk AS INTEGER) AS rk
        FROM (SELECT 'similar' AS section, * FROM overall UNION ALL SELECT 'same_group', * FROM slots) b
        JOIN vectors v ON b.track_id = v.track_id""",
    ),
    "scan_playlist": _with(
        VECTORS, PLAYLIST,
        select="SELECT CAST(track_id AS VARCHAR) AS track_id, track_name, artist_name FROM playlist",
    ),
    "suggestions_csv": _with(
        *CONTENT,
        select="""SELECT v.track_name, v.artist_name, b.mean_cosine AS mean_cosine_score
        FROM (SELECT * FROM overall UNION ALL SELECT * FROM slots) b JOIN vectors v ON b.track_id = v.track_id""",
    ),
    "scan_catalog": "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part",
    "tolerant_csv": _with(
        LINES, select="SELECT user_id, artistname, trackname, playlistname FROM lines WHERE l_linenumber NOT IN (6, 7)"
    ),
    "csv_rejects": _with(
        LINES,
        select="""SELECT user_id || ', "' || artistname || '", "' || trackname || '"' ||
            CASE WHEN l_linenumber = 7 THEN ', ' || playlistname || ', more' ELSE '' END AS line, count(*) AS n
        FROM lines WHERE l_linenumber IN (6, 7) GROUP BY 1""",
    ),
    "file_manifest": """SELECT event_type, CAST(sum(strlen(props) + 1) AS BIGINT) AS n_bytes
        FROM events GROUP BY event_type""",
    "extract_records": _with(
        RECORDS, select="SELECT * EXCLUDE (event_id) FROM good"
    ),
    "rejected_records": "SELECT event_id AS path FROM events WHERE event_id % 13 = 0",
    "records_lane": _records_lane(RECORDS),
    "records_from_files": _records_lane(FILES),
    "binary_records": """SELECT 'C' || CAST(c_custkey AS VARCHAR) AS track_id, c_name AS track_name,
            CASE WHEN c_custkey % 19 <> 0 THEN 'Nation ' || CAST(c_nationkey AS VARCHAR) END AS artist_name,
            c_acctbal AS duration, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS tempo,
            CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS loudness,
            CAST(c_nationkey AS DOUBLE) AS artist_familiarity, CAST(NULL AS DOUBLE) AS artist_hotttnesss,
            c_acctbal * 2 AS song_hotttnesss
        FROM customer WHERE c_custkey % 13 <> 0 AND c_custkey % 17 <> 0""",
    "binary_rejects": """SELECT CAST(c_custkey AS VARCHAR) || '.trk' AS name,
            CASE WHEN c_custkey % 13 = 0 THEN 'ValueError: cut short in track_id'
                 ELSE 'ValueError: numbers are cut short or too many' END AS error
        FROM customer WHERE c_custkey % 13 = 0 OR c_custkey % 17 = 0""",
    "sink_roundtrip": _with(PLAYS, SPLIT, select="SELECT * FROM splits"),
    "model_roundtrip": """SELECT count(DISTINCT l_partkey) AS n_saved, count(DISTINCT l_partkey) AS n_loaded,
        CAST(0 AS DOUBLE) AS max_gap FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "stage_report": _with(
        *CATALOG,
        select="""SELECT CAST(0 AS INTEGER) AS stage_no, 'merged' AS stage, (SELECT count(*) FROM merged) AS n_rows,
            CAST(12 AS INTEGER) AS n_columns, CAST(0 AS BIGINT) AS n_removed
        UNION ALL SELECT 1, 'cleaned', (SELECT count(*) FROM cleaned), 12,
            (SELECT count(*) FROM merged) - (SELECT count(*) FROM cleaned)""",
    ),
    "catalog_report": _catalog_report(),
    "left_enrich": _with(
        ITEM,
        select=f"SELECT p_partkey, p_name, p_brand, {NUMBERS} FROM part LEFT JOIN item ON p_partkey = l_partkey",
    ),
    "conform_sources": _with(ITEM, BASE, CONFORMED, select="SELECT * FROM conformed"),
    "best_record": _with(*CATALOG, select="SELECT * FROM merged"),
    "drop_incomplete": _with(
        ITEM, BASE, CONFORMED,
        select="SELECT * FROM conformed WHERE artist_name IS NOT NULL AND duration_ms IS NOT NULL AND "
        + " AND ".join(f"{f} IS NOT NULL" for f in FEATURES),
    ),
    "dedupe_by_name": _with(
        ITEM, BASE, CONFORMED, MERGED, _first_per_name("merged", "unique_names"), select="SELECT * FROM unique_names"
    ),
    "clean_catalog": _with(*CATALOG, select="SELECT * FROM cleaned"),
    "catalog_lane": _catalog_lane(),
    "sanitize_values": """SELECT l_orderkey, l_linenumber,
            CASE WHEN l_linenumber <> 1 THEN l_returnflag END AS flag,
            CASE WHEN l_orderkey % 3 <> 0 AND l_orderkey % 5 <> 0 AND l_orderkey % 7 <> 0 THEN l_quantity END AS quantity
        FROM lineitem""",
    "minmax_scale": """SELECT l_orderkey, l_linenumber, l_partkey,
            round((l_quantity - min(l_quantity) OVER ()) / (max(l_quantity) OVER () - min(l_quantity) OVER ()), 6)
                AS l_quantity,
            round((l_extendedprice - min(l_extendedprice) OVER ())
                / (max(l_extendedprice) OVER () - min(l_extendedprice) OVER ()), 6) AS l_extendedprice,
            round((l_discount - min(l_discount) OVER ()) / (max(l_discount) OVER () - min(l_discount) OVER ()), 6)
                AS l_discount,
            round((l_tax - min(l_tax) OVER ()) / (max(l_tax) OVER () - min(l_tax) OVER ()), 6) AS l_tax,
            CAST(0.5 AS DOUBLE) AS constant
        FROM lineitem""",
    "fitted_scale": _fitted_scale(),
    "mean_impute": """SELECT l_orderkey, l_linenumber, l_partkey,
            round(CASE WHEN l_linenumber = 3 THEN (SELECT avg(l_quantity) FROM lineitem WHERE l_linenumber <> 3)
                ELSE l_quantity END, 6) AS l_quantity,
            round(CASE WHEN l_linenumber = 5 THEN (SELECT avg(l_tax) FROM lineitem WHERE l_linenumber <> 5)
                ELSE l_tax END, 6) AS l_tax,
            l_linenumber = 3 AS l_quantity_was_null, l_linenumber = 5 AS l_tax_was_null
        FROM lineitem""",
    "profile_shape": _shape(),
    "profile_schema": _schema(),
    "profile_missing": _missing(),
    "profile_dups": """SELECT CAST(sum(c) AS BIGINT) AS n_rows, CAST(sum(c - 1) AS BIGINT) AS n_duplicates,
            round(sum(c - 1) * CAST(100.0 AS DOUBLE) / sum(c), 6) AS pct
        FROM (SELECT count(*) AS c FROM documents GROUP BY text, lang, source, n_chars)""",
    "profile_stats": _statistics(),
    "profile_hist": _histogram(),
    "profile_corr": _correlations(),
    "interaction_counts": _with(ROWS, COUNTS, select="SELECT * FROM counts"),
    "distinct_ids": "SELECT DISTINCT l_partkey AS song_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "dense_ids": _with(
        ROWS,
        select="""SELECT trackname, CAST(row_number() OVER (ORDER BY trackname) - 1 AS INTEGER) AS song_code
            FROM (SELECT DISTINCT trackname FROM entries)""",
    ),
    "encode_ids": _with(ROWS, COUNTS, ENCODED, select="SELECT * FROM encoded"),
    "user_lane": _with(
        LINES, "entries AS (SELECT * FROM lines WHERE l_linenumber NOT IN (6, 7))", COUNTS, ENCODED, PARTS,
        select="SELECT * FROM parted",
    ),
    "interaction_report": _interaction_report(),
    "catalog_recs": _catalog_recs(),
    "profile_datasets": _profile_datasets(),
    "user_history": _with(
        PLAYS,
        select="""SELECT * FROM (SELECT *, CAST(row_number() OVER
            (PARTITION BY user_id ORDER BY interaction DESC, song_id) AS INTEGER) AS rk FROM plays) WHERE rk <= 15""",
    ),
    "hash_split": _with(PLAYS, SPLIT, select="SELECT * FROM splits"),
    "sample_playlist": _with(VECTORS, PLAYLIST, select="SELECT * FROM playlist"),
    "eval_pairs": _with(PLAYS, SPLIT, PAIRS, select="SELECT * FROM pairs"),
    "negative_samples": _with(*EVALUATION, select="SELECT * FROM candidates"),
    "knn_exact": _with(
        VECTORS, PLAYLIST, NEAR,
        select="SELECT seed_id, dist, track_id, CAST(rk AS INTEGER) AS rk FROM near",
    ),
    "knn_all": _with(
        VECTORS,
        select="""SELECT seed_id, dist, track_id, CAST(rk AS INTEGER) AS rk FROM (
            SELECT *, row_number() OVER (PARTITION BY seed_id ORDER BY dist, track_id) AS rk
            FROM (SELECT s.track_id AS seed_id, v.track_id, round(list_distance(v.f, s.f), 9) AS dist
                  FROM vectors s CROSS JOIN vectors v)) WHERE rk <= 10""",
    ),
    "knn_lsh": _with(
        VECTORS, PLAYLIST, NEAR,
        select="SELECT seed_id, dist, track_id, CAST(rk AS INTEGER) AS rk FROM near",
    ),
    "knn_lsh_checks": _with(
        VECTORS, PLAYLIST,
        select="""SELECT track_id AS seed_id, CAST(0 AS BIGINT) AS n_wrong, CAST(0 AS BIGINT) AS n_misplaced,
            CAST(0 AS BIGINT) AS n_repeated, CAST(1 AS INTEGER) AS finds_itself FROM playlist""",
    ),
    "knn_recall": _with(
        VECTORS, PLAYLIST, NEAR,
        select="SELECT seed_id, CAST(1 AS DOUBLE) AS recall, count(*) AS neighbours FROM near GROUP BY seed_id",
    ),
    "mean_cosine": _with(
        VECTORS, PLAYLIST, SCORE, select="SELECT track_id, mean_cosine FROM score"
    ),
    "same_group_pool": _with(VECTORS, PLAYLIST, GROUP, select="SELECT * FROM grouped"),
    "candidate_pool": _with(VECTORS, PLAYLIST, NEAR, GROUP, POOL, select="SELECT * FROM pool"),
    "match_seeds": f"""WITH parts AS (
            SELECT CAST(p_partkey AS VARCHAR) AS track_id, lower(p_name) AS track_name, lower(p_brand) AS artist_name
            FROM part),
        listed AS (SELECT * FROM parts ORDER BY {_row_hash(["track_id"], 42)}, track_id LIMIT {PLAYLIST_SIZE})
        SELECT p.* FROM parts p
        WHERE p.track_id IN (SELECT track_id FROM listed WHERE CAST(track_id AS BIGINT) % 2 <> 0)
           OR EXISTS (SELECT 1 FROM listed l WHERE CAST(l.track_id AS BIGINT) % 2 = 0
                      AND l.track_name = p.track_name AND l.artist_name = p.artist_name)""",
    "score_candidates": _with(
        *EVALUATION, _scored(64),
        select="SELECT candidate, user_id, song_id, draw, score FROM scored",
    ),
    "rank_positive": _with(PLAYS, SPLIT, ALL_PAIRS, CANDIDATES, _scored(64), _ranks(), select="SELECT * FROM ranks"),
    "rank_metrics": _with(*EVALUATION, _scored(64), _ranks(), select=f"SELECT {METRICS} FROM ranks"),
    "select_best": _with(
        *EVALUATION,
        *[part for s in (16, 32, 64) for part in (_scored(s, f"s{s}"), _ranks(f"s{s}", f"r{s}"))],
        select="SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT CAST({i} AS INTEGER) AS grid_index, CAST({s} AS INTEGER) AS rank, * FROM (SELECT {METRICS} FROM r{s})"
            for i, s in enumerate((16, 32, 64))
        )
        + ") ORDER BY hr DESC, grid_index LIMIT 1",
    ),
    "als_fit": _with(
        PLAYS, SPLIT,
        select="""SELECT 'user' AS side, CAST(10 AS INTEGER) AS rank, count(DISTINCT user_id) AS n_ids,
            CAST(0 AS BIGINT) AS n_unsolved, count(DISTINCT user_id) AS n_checked FROM splits WHERE split = 'train'
        UNION ALL SELECT 'item', 10, count(DISTINCT song_id), NULL, NULL FROM splits WHERE split = 'train'""",
    ),
    "als_grid": _with(
        PLAYS, SPLIT, PAIRS,
        select="""SELECT g.*, (SELECT count(*) FROM pairs WHERE user_id IN
                (SELECT user_id FROM splits WHERE split = 'train')) AS n,
            CAST(0 AS BIGINT) AS n_gap, CAST(0 AS DOUBLE) AS hr_gap, CAST(0 AS DOUBLE) AS mrr_gap
        FROM (VALUES (CAST(0 AS INTEGER), CAST(10 AS INTEGER), CAST(0.1 AS DOUBLE), CAST(1 AS DOUBLE)),
                     (1, 50, 0.1, 1), (2, 50, 0.1, 20)) g(grid_index, rank, "regParam", alpha)""",
    ),
    "als_final": _with(
        PLAYS, SPLIT, PAIRS.replace("'validation'", "'test'"),
        select="""SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_gap, CAST(0 AS DOUBLE) AS hr_gap, CAST(0 AS DOUBLE) AS mrr_gap
            FROM pairs
            WHERE user_id IN (SELECT user_id FROM splits WHERE split = 'train')""",
    ),
    "top_new_songs": _with(
        PLAYS, LONG_TAIL,
        select="""SELECT user_id, song_id, score AS confidence_score, CAST(rk AS INTEGER) AS rk FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, song_id) AS rk FROM products)
            WHERE rk <= 10""",
    ),
    "top_new_blocks": _with(
        PLAYS, LONG_TAIL, BLOCKS_READ,
        select="""SELECT u.id AS user_id, count(*) AS n_blocks FROM sized_u u CROSS JOIN tops t
            LEFT JOIN floors f ON f.user_id = u.id AND f.low = t.low
            WHERE f.floor IS NULL OR u.norm * t.top * (1 + 1e-9) + 1e-9 >= f.floor GROUP BY u.id""",
    ),
    "recs_coverage": _with(ROWS, COUNTS, ENCODED, select=_list_checks("user_id")),
    "recs_for_users": _with(
        ROWS, COUNTS, ENCODED,
        select=f"""SELECT * FROM ({_list_checks("user_id, user_id_original")})
            WHERE CAST(user_id_original AS BIGINT) % 7 = 0""",
    ),
    "history_for_users": _with(
        ROWS, COUNTS, ENCODED,
        select="""SELECT * FROM (SELECT *, CAST(row_number() OVER
            (PARTITION BY user_id ORDER BY interaction DESC, song_id) AS INTEGER) AS rk FROM encoded)
            WHERE rk <= 15 AND CAST(user_id_original AS BIGINT) % 7 = 0""",
    ),
    "explode_recs": _with(
        PLAYS, SPLIT, SCORES,
        select="""SELECT user_id, song_id, round(confidence_score, 6) AS confidence_score FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY confidence_score DESC, song_id) AS rn
            FROM scores) WHERE rn <= 50""",
    ),
    "anti_heard": _with(
        PLAYS, SPLIT, SCORES,
        select="""SELECT * FROM (
            SELECT user_id, song_id, round(confidence_score, 6) AS confidence_score,
                   CAST(row_number() OVER (PARTITION BY user_id ORDER BY confidence_score DESC, song_id) AS INTEGER) AS rk
            FROM scores WHERE split <> 'train') WHERE rk <= 10""",
    ),
}
