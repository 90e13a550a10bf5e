"""Independent DuckDB SQL for the registered queries (the correctness oracle).

Averages are computed exactly from integer-scaled sums so they equal Spark's
decimal averages digit for digit; rounding is half away from zero in both.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

POSTS_CTE = """
ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, (value - 50) / 10 AS x
  FROM events
),
posts AS (
  SELECT
    CAST(event_id AS VARCHAR) AS tweet_id,
    event_type || ' k' || CAST(k AS VARCHAR) AS text,
    'user_' || CAST(user_id AS VARCHAR) AS author,
    user_id * 100 AS author_followers,
    CASE WHEN event_type = 'signup' THEN 'es' ELSE 'en' END AS lang,
    CASE WHEN k = 0 THEN NULL ELSE ts - to_seconds(k) END AS tweet_created_at,
    CASE WHEN k % 25 = 0 THEN CAST([] AS VARCHAR[])
         ELSE [event_type, 'k' || CAST(k % 10 AS VARCHAR)] END AS hashtags,
    CAST(len(CASE WHEN k % 25 = 0 THEN CAST([] AS VARCHAR[])
         ELSE [event_type, 'k' || CAST(k % 10 AS VARCHAR)] END) AS INTEGER) AS hashtag_count,
    CAST(k AS BIGINT) AS retweet_count,
    CAST(floor(value) AS BIGINT) AS like_count,
    round(x / sqrt(x * x + 15), 4) AS compound_score,
    CASE WHEN round(x / sqrt(x * x + 15), 4) >= 0.05 THEN 'positive'
         WHEN round(x / sqrt(x * x + 15), 4) <= -0.05 THEN 'negative'
         ELSE 'neutral' END AS sentiment,
    'events' AS source,
    ts AS processed_at
  FROM ev
),
as_of AS (SELECT max(processed_at) AS t FROM posts)
"""

ASOF = "(SELECT t FROM as_of)"


def avg4(c: str) -> str:
    """Exact average of a 4-decimal value, rounded to 4 places."""
    return f"(round(CAST(sum(CAST(round({c} * 10000) AS BIGINT)) AS DOUBLE) / count({c})) / 10000)"


def avg8(c: str) -> str:
    """Exact average of a 4-decimal value to 8 places (Spark's decimal average scale)."""
    return f"(round(CAST(sum(CAST(round({c} * 10000) AS BIGINT)) AS DOUBLE) * 10000 / count({c})) / 100000000)"


def pct(part: str, total: str, digits: int) -> str:
    scale = 10**digits
    return f"(round(CAST({part} AS DOUBLE) * {100 * scale} / NULLIF({total}, 0)) / {scale})"


def cnt(label: str) -> str:
    return f"count(*) FILTER (WHERE sentiment = '{label}')"


def with_posts(body: str) -> str:
    return f"WITH {POSTS_CTE}\n{body}"


def sql(name: str, body: str, posts: bool = True) -> None:
    ORACLE[name] = with_posts(body) if posts else body


LAG_US = "date_diff('microsecond', tweet_created_at, processed_at)"

# ---------------------------------------------------------------- projections
sql("canonical_posts", "SELECT * FROM posts")
sql("processing_lag", f"SELECT tweet_id, CAST({LAG_US} AS DOUBLE) / 1000000 AS processed_lag FROM posts")
sql(
    "sentiment_label",
    """SELECT tweet_id, compound_score,
       CASE WHEN compound_score >= 0.05 THEN 'positive' WHEN compound_score <= -0.05 THEN 'negative'
            ELSE 'neutral' END AS label FROM posts""",
)
sql(
    "feed_cards",
    """SELECT tweet_id,
       array_to_string(list_transform(hashtags, lambda h: '#' || h), ' ') AS tag_line,
       substr(text, 1, 60) AS preview,
       format('{:,}', author_followers) AS followers_display,
       printf('%.3f', round(CAST(compound_score AS DECIMAL(10,4)), 3)) AS score_display,
       CASE WHEN source = 'twitterapi.io' THEN 'LIVE' ELSE upper(source) END AS source_badge
     FROM posts""",
)

# -------------------------------------------------------------------- filters
sql(
    "filter_text_lang",
    "SELECT doc_id, lang, n_chars FROM documents WHERE text IS NOT NULL AND text <> '' AND lang IN ('en')",
    posts=False,
)
sql("trailing_window", f"SELECT tweet_id, processed_at, sentiment FROM posts WHERE processed_at >= {ASOF} - INTERVAL 24 HOUR")
sql("tag_overlap", "SELECT tweet_id, hashtags FROM posts WHERE list_has_any(hashtags, ['click', 'k3'])")
sql(
    "keyword_match",
    """SELECT tweet_id, text, hashtags FROM posts
       WHERE list_contains(list_transform(hashtags, lambda h: lower(h)), 'purchase')
          OR contains(lower(text), 'purchase')""",
)

# --------------------------------------------------------------- aggregations
sql(
    "kpi_summary",
    f"""SELECT count(*) AS total_tweets,
       {cnt('positive')} AS positive_count, {cnt('negative')} AS negative_count, {cnt('neutral')} AS neutral_count,
       {pct(cnt('positive'), 'count(*)', 2)} AS positive_pct,
       {avg4('compound_score')} AS avg_compound_score,
       (round(CAST(sum({LAG_US}) AS DOUBLE) / (count({LAG_US}) * 10000)) / 100) AS avg_lag_seconds,
       min(processed_at) AS earliest_tweet, max(processed_at) AS latest_tweet
     FROM posts""",
)


def series_sql(unit: str, avg: str, where: str = "") -> str:
    return f"""SELECT date_trunc('{unit}', processed_at) AS bucket, sentiment, count(*) AS tweet_count,
       {avg} AS avg_compound, CAST(sum(retweet_count) AS BIGINT) AS total_retweets,
       CAST(sum(like_count) AS BIGINT) AS total_likes
     FROM posts {where} GROUP BY 1, 2"""


sql("per_minute_series", series_sql("minute", avg8("compound_score")))
sql("per_hour_series", series_sql("hour", avg4("compound_score")))
sql(
    "time_series_recent",
    series_sql("minute", avg4("compound_score"), f"WHERE processed_at >= {ASOF} - INTERVAL 60 MINUTE"),
)
sql(
    "hashtag_by_sentiment",
    f"""SELECT hashtag, sentiment, count(*) AS mention_count, {avg8('compound_score')} AS avg_sentiment_score
     FROM (SELECT unnest(hashtags) AS hashtag, sentiment, compound_score FROM posts
           WHERE processed_at >= {ASOF} - INTERVAL 24 HOUR)
     GROUP BY 1, 2""",
)
sql(
    "top_hashtags",
    f"""SELECT hashtag, count(*) AS mention_count, {avg4('compound_score')} AS avg_score
     FROM (SELECT unnest(hashtags) AS hashtag, compound_score FROM posts
           WHERE processed_at >= {ASOF} - INTERVAL 24 HOUR)
     GROUP BY 1 ORDER BY mention_count DESC, hashtag LIMIT 20""",
)
sql(
    "rolling_snapshot",
    f"""SELECT date_trunc('minute', {ASOF}) - INTERVAL 5 MINUTE AS window_start,
       date_trunc('minute', {ASOF}) AS window_end, sentiment, count(*) AS tweet_count,
       {avg4('compound_score')} AS avg_compound, {ASOF} AS computed_at
     FROM posts WHERE processed_at >= {ASOF} - INTERVAL 5 MINUTE GROUP BY sentiment""",
)
sql(
    "rolling_snapshot_24h",
    f"""SELECT date_trunc('minute', {ASOF}) - INTERVAL 24 HOUR AS window_start,
       date_trunc('minute', {ASOF}) AS window_end, c.sentiment,
       CAST(COALESCE(s.tweet_count, 0) AS BIGINT) AS tweet_count, COALESCE(s.avg_compound, 0.0) AS avg_compound,
       {ASOF} AS computed_at
     FROM (VALUES ('positive'), ('negative'), ('neutral')) c(sentiment)
     LEFT JOIN (SELECT sentiment, count(*) AS tweet_count, {avg4('compound_score')} AS avg_compound
                FROM posts WHERE processed_at >= {ASOF} - INTERVAL 24 HOUR GROUP BY sentiment) s
       USING (sentiment)""",
)
sql(
    "search_summary",
    f"""SELECT count(*) AS total, {cnt('positive')} AS positive, {cnt('negative')} AS negative,
       {cnt('neutral')} AS neutral FROM posts WHERE list_has_any(hashtags, ['click', 'k3'])""",
)
sql("class_counts", "SELECT sentiment, count(*) AS cnt FROM posts GROUP BY sentiment")
sql("positive_rate", f"SELECT lang, {pct(cnt('positive'), 'count(sentiment)', 4)} AS positive_rate FROM posts GROUP BY lang")
sql(
    "rolling_1h_avg",
    f"""SELECT {avg4('compound_score')} AS rolling_avg, count(*) AS tweet_count
     FROM posts WHERE processed_at >= {ASOF} - INTERVAL 1 HOUR""",
)
sql(
    "series_pivot",
    f"""SELECT date_trunc('hour', processed_at) AS bucket, {cnt('positive')} AS positive,
       {cnt('negative')} AS negative, {cnt('neutral')} AS neutral FROM posts GROUP BY 1""",
)
sql(
    "minute_of_day_pivot",
    f"""SELECT strftime(processed_at, '%H:%M') AS time, {cnt('positive')} AS positive,
       {cnt('negative')} AS negative, {cnt('neutral')} AS neutral FROM posts GROUP BY 1""",
)
sql(
    "class_shares",
    f"""SELECT total,
       COALESCE({pct('positive', 'total', 1)}, 0.0) AS positive_pct,
       COALESCE({pct('negative', 'total', 1)}, 0.0) AS negative_pct,
       COALESCE({pct('neutral', 'total', 1)}, 0.0) AS neutral_pct,
       CAST(COALESCE({pct('positive', 'total', 0)}, 0.0) AS BIGINT) AS positive_pct_int,
       CAST(COALESCE({pct('negative', 'total', 0)}, 0.0) AS BIGINT) AS negative_pct_int,
       CAST(COALESCE({pct('neutral', 'total', 0)}, 0.0) AS BIGINT) AS neutral_pct_int
     FROM (SELECT count(*) AS total, {cnt('positive')} AS positive, {cnt('negative')} AS negative,
                  {cnt('neutral')} AS neutral FROM posts)""",
)
sql(
    "kpi_unpivot",
    f"""SELECT 'positive' AS class, {cnt('positive')} AS count FROM posts
     UNION ALL SELECT 'negative', {cnt('negative')} FROM posts
     UNION ALL SELECT 'neutral', {cnt('neutral')} FROM posts""",
)
sql(
    "hashtag_polarity",
    f"""SELECT hashtag, avg_score,
       CASE WHEN avg_score > 0 THEN 'green' WHEN avg_score < 0 THEN 'red' END AS polarity
     FROM (SELECT hashtag, {avg4('compound_score')} AS avg_score
           FROM (SELECT unnest(hashtags) AS hashtag, compound_score FROM posts) GROUP BY hashtag)""",
)


# ------------------------------------------------------------ latest per key
def sliding_sql(width_min: int, slide_min: int) -> str:
    n = width_min // slide_min
    return f"""snaps AS (
  SELECT ws AS window_start, ws + INTERVAL {width_min} MINUTE AS window_end, sentiment,
         count(*) AS tweet_count, {avg4('compound_score')} AS avg_compound,
         ws + INTERVAL {width_min} MINUTE AS computed_at
  FROM (SELECT time_bucket(INTERVAL {slide_min} MINUTE, processed_at) - to_minutes({slide_min} * i) AS ws,
               sentiment, compound_score
        FROM posts, range(0, {n}) r(i))
  GROUP BY ws, sentiment)"""


ORACLE["snapshot_series"] = with_posts("").rstrip() + f", {sliding_sql(5, 1)}\nSELECT * FROM snaps"
ORACLE["latest_per_class"] = (
    with_posts("").rstrip()
    + f""", {sliding_sql(60, 10)}
SELECT * FROM snaps QUALIFY row_number() OVER (PARTITION BY sentiment ORDER BY window_end DESC) = 1"""
)
ORACLE["rolling_latest"] = (
    with_posts("").rstrip()
    + f""", {sliding_sql(5, 1)}
SELECT sentiment, tweet_count, avg_compound, window_start, window_end, computed_at FROM snaps
QUALIFY row_number() OVER (PARTITION BY sentiment ORDER BY window_end DESC) = 1"""
)

# -------------------------------------------------------------------- top-k
RECENT = "tweet_id, text, author, author_followers, hashtags, compound_score, sentiment, retweet_count, like_count, processed_at, source"
sql("recent_posts", f"SELECT {RECENT} FROM posts ORDER BY processed_at DESC, tweet_id DESC LIMIT 100")
sql(
    "search_posts",
    f"""SELECT {RECENT} FROM posts WHERE list_has_any(hashtags, ['click', 'k3']) AND sentiment = 'positive'
     ORDER BY processed_at DESC, tweet_id DESC LIMIT 50""",
)
sql(
    "new_since_poll",
    f"""SELECT tweet_id, processed_at, sentiment FROM posts
     WHERE processed_at >= {ASOF} - INTERVAL 24 HOUR
       AND tweet_id NOT IN (SELECT tweet_id FROM posts WHERE processed_at < {ASOF} - INTERVAL 1 HOUR)""",
)
sql(
    "accumulate_feed",
    f"""SELECT * FROM (
       SELECT {RECENT} FROM posts WHERE processed_at >= {ASOF} - INTERVAL 1 HOUR
       UNION ALL
       SELECT * FROM (SELECT {RECENT} FROM posts WHERE processed_at < {ASOF} - INTERVAL 1 HOUR
                      ORDER BY processed_at DESC, tweet_id DESC LIMIT 200) o
       WHERE o.tweet_id NOT IN (SELECT tweet_id FROM posts WHERE processed_at >= {ASOF} - INTERVAL 1 HOUR))
     ORDER BY processed_at DESC, tweet_id DESC LIMIT 200""",
)


# ===================================================== front end (SRC, PRJ, SNK)
ISO = "'%Y-%m-%dT%H:%M:%S.%f+00:00'"
ETYPE = "split_part(text, ' ', 1)"

sql(
    "decode_json",
    f"""SELECT tweet_id AS key, tweet_id AS id, text, author, author_followers, lang,
       strftime(tweet_created_at, {ISO}) AS created_at, hashtags, retweet_count, like_count, source,
       CAST(NULL AS VARCHAR) AS _corrupt_record
     FROM posts
     UNION ALL
     SELECT 'c-' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL,
       NULL, NULL, NULL, NULL, text
     FROM conversations""",
)
sql(
    "encode_json",
    f"""SELECT tweet_id AS key,
       CAST(to_json(struct_pack(id := tweet_id, text := text, author := author, author_followers := author_followers,
         lang := lang, created_at := strftime(tweet_created_at, {ISO}), hashtags := hashtags,
         retweet_count := retweet_count, like_count := like_count, source := source)) AS VARCHAR) AS value
     FROM posts""",
)
sql(
    "envelope_routes",
    """SELECT route, count(*) AS n, count(*) FILTER (WHERE rate_limited) AS rate_limited FROM (
       SELECT CASE WHEN role = 'user' AND text <> '' THEN 'publish' WHEN role = 'user' THEN 'empty'
                   WHEN role = 'system' THEN 'error' ELSE 'ignored' END AS route,
              COALESCE(role = 'system' AND contains(lower(text), 'rate limit'), false) AS rate_limited
       FROM conversations
       UNION ALL SELECT 'dropped', false FROM conversations)
     GROUP BY route""",
    posts=False,
)
sql(
    "normalize_posts",
    f"""SELECT tweet_id, tweet_id AS id, text,
       CASE WHEN {ETYPE} = 'signup' THEN 'unknown' ELSE author END AS author,
       CASE WHEN {ETYPE} = 'signup' THEN CAST(0 AS BIGINT) ELSE author_followers END AS author_followers,
       lang,
       COALESCE(strftime(tweet_created_at, {ISO}), strftime({ASOF}, {ISO})) AS created_at,
       hashtags, retweet_count, like_count, 'twitterapi.io' AS source
     FROM posts""",
)
sql(
    "parse_created_at",
    f"""SELECT tweet_id,
       CASE WHEN starts_with(text, 'click') THEN strftime(tweet_created_at, '%a %b %d %H:%M:%S +0000 %Y')
            ELSE strftime(tweet_created_at, {ISO}) END AS raw,
       CASE WHEN starts_with(text, 'click') THEN date_trunc('second', tweet_created_at)
            ELSE tweet_created_at END AS tweet_created_at
     FROM posts WHERE tweet_created_at IS NOT NULL""",
)
sql(
    "apply_defaults",
    f"""SELECT tweet_id, text, author, tweet_created_at, compound_score, sentiment,
       CAST(0 AS BIGINT) AS author_followers, 'en' AS lang, CAST([] AS VARCHAR[]) AS hashtags, 0 AS hashtag_count,
       CAST(0 AS BIGINT) AS retweet_count, CAST(0 AS BIGINT) AS like_count, 'twitterapi.io' AS source,
       {ASOF} AS processed_at
     FROM posts""",
)
DIRTY = f""",
dirty AS (
  SELECT CASE WHEN {ETYPE} = 'view' AND retweet_count < 5 THEN NULL ELSE tweet_id END AS tweet_id, text,
         CASE WHEN {ETYPE} = 'signup' AND retweet_count < 10 THEN NULL ELSE author END AS author,
         compound_score,
         CASE WHEN {ETYPE} = 'error' AND retweet_count < 5 THEN 'mixed' ELSE sentiment END AS sentiment,
         processed_at
  FROM posts
  UNION ALL
  SELECT tweet_id, text, author, compound_score, sentiment, processed_at + INTERVAL 1 MINUTE FROM posts WHERE retweet_count = 1
),
checked AS (
  SELECT *, list_filter([
      CASE WHEN tweet_id IS NULL THEN 'null_tweet_id' END, CASE WHEN text IS NULL THEN 'null_text' END,
      CASE WHEN author IS NULL THEN 'null_author' END, CASE WHEN compound_score IS NULL THEN 'null_compound_score' END,
      CASE WHEN sentiment IS NULL THEN 'null_sentiment' END,
      CASE WHEN sentiment IS NOT NULL AND sentiment NOT IN ('positive', 'negative', 'neutral') THEN 'bad_sentiment' END
    ], lambda x: x IS NOT NULL) AS r
  FROM dirty
),
ranked AS (
  SELECT *, CASE WHEN len(r) = 0 THEN row_number() OVER (PARTITION BY tweet_id, len(r) = 0 ORDER BY processed_at) END AS rn
  FROM checked
)
"""
ORACLE["quarantine"] = with_posts("").rstrip() + DIRTY + """
SELECT tweet_id, author, sentiment, processed_at,
       CASE WHEN rn > 1 THEN list_concat(r, ['duplicate_key']) ELSE r END AS reasons
FROM ranked WHERE len(r) > 0 OR rn > 1"""
ORACLE["quarantine_valid"] = with_posts("").rstrip() + DIRTY + """
SELECT sentiment, count(*) AS n, max(processed_at) AS latest FROM ranked WHERE len(r) = 0 AND rn = 1 GROUP BY sentiment"""

_TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
sql("table_counts", "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _TABLES), posts=False)
sql(
    "first_nonempty_source",
    """SELECT tweet_id, source_used FROM (
       SELECT tweet_id, 0 AS pr, 'live' AS source_used FROM posts WHERE list_has_any(hashtags, ['nosuchtag'])
       UNION ALL SELECT tweet_id, 1, 'twitter' FROM posts WHERE list_has_any(hashtags, ['click'])
       UNION ALL SELECT tweet_id, 2, 'mock' FROM posts) u
     WHERE pr = (SELECT min(pr) FROM (
       SELECT 0 AS pr FROM posts WHERE list_has_any(hashtags, ['nosuchtag'])
       UNION ALL SELECT 1 FROM posts WHERE list_has_any(hashtags, ['click'])
       UNION ALL SELECT 2 FROM posts))""",
)

# ================================================================ scoring
LEX = """WITH toks AS (
  SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS token
  FROM documents WHERE text IS NOT NULL AND text <> '' AND lang IN ('en')
),
lex AS (
  SELECT token, CAST((length(token) * 7 + ascii(token)) % 9 - 4 AS DOUBLE) AS valence
  FROM (SELECT token, count(*) AS freq FROM toks WHERE token <> '' GROUP BY token)
),
sums AS (
  SELECT t.doc_id, COALESCE(sum(l.valence), 0) AS s, count(l.valence) AS matched_tokens
  FROM toks t LEFT JOIN lex l USING (token) GROUP BY t.doc_id
),
scored AS (SELECT doc_id, round(s / sqrt(s * s + 15), 4) AS compound_score, matched_tokens FROM sums)
"""
ORACLE["corpus_lexicon"] = LEX + "SELECT token, valence FROM lex"
ORACLE["lexicon_score"] = LEX + "SELECT * FROM scored"
ORACLE["score_and_label"] = LEX + """SELECT doc_id, compound_score,
  CASE WHEN compound_score >= 0.05 THEN 'positive' WHEN compound_score <= -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment
FROM scored"""
ORACLE["lexicon_score_udf"] = LEX + "SELECT doc_id, compound_score FROM scored"

# ================================================================= merges
LABEL_NEG = """CASE WHEN 0.0 - compound_score >= 0.05 THEN 'positive' WHEN 0.0 - compound_score <= -0.05 THEN 'negative'
                    ELSE 'neutral' END"""
MERGE_CTE = f""",
b AS (SELECT t - INTERVAL 15 DAY AS t1, t - INTERVAL 10 DAY AS t2 FROM as_of),
base AS (SELECT * FROM posts WHERE processed_at < (SELECT t2 FROM b)),
batch AS (
  SELECT * REPLACE (CAST(0.0 - compound_score AS DOUBLE) AS compound_score, {LABEL_NEG} AS sentiment,
                    processed_at + INTERVAL 1 HOUR AS processed_at)
  FROM posts WHERE processed_at >= (SELECT t1 FROM b)
  UNION ALL
  SELECT * REPLACE (CAST(0.0 AS DOUBLE) AS compound_score, 'neutral' AS sentiment, processed_at + INTERVAL 2 HOUR AS processed_at)
  FROM posts WHERE processed_at >= (SELECT t1 FROM b) AND processed_at < (SELECT t2 FROM b)
),
u AS (SELECT *, 0 AS _src FROM base UNION ALL SELECT *, 1 AS _src FROM batch)
"""
ORACLE["upsert_partial"] = with_posts("").rstrip() + MERGE_CTE + """,
i AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY _src, processed_at) = 1),
m AS (SELECT tweet_id, compound_score, sentiment, processed_at FROM u
      QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY _src DESC, processed_at DESC) = 1)
SELECT i.* EXCLUDE (compound_score, sentiment, processed_at, _src), m.compound_score, m.sentiment, m.processed_at
FROM i JOIN m USING (tweet_id)"""
ORACLE["insert_if_absent"] = with_posts("").rstrip() + MERGE_CTE + """,
f AS (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY processed_at) = 1)
SELECT * FROM base UNION ALL SELECT * FROM f WHERE tweet_id NOT IN (SELECT tweet_id FROM base)"""


def sliding_from(src: str, width_min: int, slide_min: int, computed_shift: str = "") -> str:
    n = width_min // slide_min
    return f"""(
  SELECT ws AS window_start, ws + INTERVAL {width_min} MINUTE AS window_end, sentiment,
         count(*) AS tweet_count, {avg4('compound_score')} AS avg_compound,
         ws + INTERVAL {width_min} MINUTE {computed_shift} AS computed_at
  FROM (SELECT time_bucket(INTERVAL {slide_min} MINUTE, processed_at) - to_minutes({slide_min} * i) AS ws,
               sentiment, compound_score
        FROM {src}, range(0, {n}) r(i))
  GROUP BY ws, sentiment)"""


ORACLE["rolling_upsert"] = with_posts("").rstrip() + MERGE_CTE + f""",
old AS {sliding_from('base', 5, 1)},
new AS {sliding_from("(SELECT * FROM posts WHERE processed_at >= (SELECT t2 FROM b) - INTERVAL 1 DAY)", 5, 1, '+ INTERVAL 1 MINUTE')},
su AS (SELECT *, 0 AS _src FROM old UNION ALL SELECT *, 1 AS _src FROM new)
SELECT window_start, window_end, sentiment, tweet_count, avg_compound, computed_at FROM su
QUALIFY row_number() OVER (PARTITION BY window_end, sentiment ORDER BY computed_at DESC, _src DESC) = 1"""
UPSERTED = MERGE_CTE + """,
i AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY _src, processed_at) = 1),
m AS (SELECT tweet_id, compound_score, sentiment, processed_at FROM u
      QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY _src DESC, processed_at DESC) = 1),
merged AS (SELECT i.* EXCLUDE (compound_score, sentiment, processed_at, _src), m.compound_score, m.sentiment, m.processed_at
           FROM i JOIN m USING (tweet_id))
"""
ORACLE["refresh_per_minute"] = with_posts("").rstrip() + UPSERTED + series_sql("minute", avg8("compound_score")).replace("FROM posts", "FROM merged")
ORACLE["refresh_top_hashtags"] = with_posts("").rstrip() + UPSERTED + f"""SELECT hashtag, count(*) AS mention_count, {avg4('compound_score')} AS avg_score
FROM (SELECT unnest(hashtags) AS hashtag, compound_score FROM merged) GROUP BY 1 ORDER BY mention_count DESC, hashtag LIMIT 20"""
sql("explorer_rows", "SELECT processed_at, author, text, sentiment, compound_score FROM posts WHERE sentiment = 'negative'")
sql(
    "bound_query",
    "SELECT sentiment, count(*) AS n, max(processed_at) AS latest FROM posts WHERE source = 'events' AND like_count >= 100 GROUP BY 1",
)
ORACLE["snapshot_violations"] = with_posts("").rstrip() + f""", snaps AS {sliding_from('posts', 60, 60)},
dirty AS (
  SELECT * REPLACE (CASE WHEN hour(window_end) = 3 AND sentiment = 'neutral' THEN 'mixed' ELSE sentiment END AS sentiment,
                    CASE WHEN hour(window_end) = 5 THEN NULL ELSE tweet_count END AS tweet_count) FROM snaps
  UNION ALL SELECT * FROM snaps WHERE hour(window_end) = 7
),
checked AS (
  SELECT window_end, sentiment, tweet_count, list_filter([
      CASE WHEN tweet_count IS NULL THEN 'null_tweet_count' END,
      CASE WHEN sentiment NOT IN ('positive', 'negative', 'neutral') THEN 'bad_sentiment' END,
      CASE WHEN count(*) OVER (PARTITION BY window_end, sentiment) > 1 THEN 'duplicate_key' END
    ], lambda x: x IS NOT NULL) AS reasons FROM dirty
)
SELECT * FROM checked WHERE len(reasons) > 0"""

# =============================================================== keywords
KW_VALUES = "(VALUES ('click', 0), ('error', 1), ('#Purchase', 2), ('k3', 3), ('nosuchkey', 4)) t(keyword, position)"
NEEDLE = "regexp_replace(lower(kw.keyword), '^#+', '')"
ACT = f""",
kw AS (SELECT keyword, CAST(position AS INTEGER) AS position FROM {KW_VALUES}),
act AS (
  SELECT kw.keyword, max(p.processed_at) AS last_seen, count(*) AS matches
  FROM kw JOIN posts p
    ON list_contains(list_transform(p.hashtags, lambda h: lower(h)), {NEEDLE}) OR contains(lower(p.text), {NEEDLE})
  GROUP BY kw.keyword
),
st AS (
  SELECT kw.keyword, kw.position, CAST(COALESCE(a.matches, 0) AS BIGINT) AS matches,
         greatest(COALESCE(a.last_seen, s.m), s.m) AS last_seen,
         CAST(floor(date_diff('microsecond', greatest(COALESCE(a.last_seen, s.m), s.m), (SELECT t FROM as_of)) / 1000000) AS BIGINT)
           AS idle_seconds
  FROM kw LEFT JOIN act a USING (keyword), (SELECT min(processed_at) AS m FROM posts) s
)
"""
ORACLE["keyword_activity"] = with_posts("").rstrip() + ACT + "SELECT * FROM act"
ORACLE["silent_keywords"] = with_posts("").rstrip() + ACT + "SELECT *, idle_seconds >= 60 AS silent FROM st"
# The sweep as a recursion over list positions: the tracked list changes as it goes.
ORACLE["rotation_plan"] = with_posts("").rstrip() + ACT + """,
ss AS (SELECT *, idle_seconds >= 60 AS silent FROM st),
bk AS (SELECT ['signup', 'view', 'click'] AS pool)
SELECT position, keyword, CASE WHEN new_keyword <> keyword THEN new_keyword END AS replacement, new_keyword FROM (
  WITH RECURSIVE sweep AS (
    SELECT 0 AS step, (SELECT list(keyword ORDER BY position) FROM ss) AS active, CAST(0 AS BIGINT) AS cur
    UNION ALL
    SELECT step + 1,
           CASE WHEN taken IS NULL THEN active ELSE list_concat(list_concat(active[:step], [pool[(cur + taken) % len(pool) + 1]]), active[step + 2:]) END,
           cur + CASE WHEN NOT silent THEN 0 WHEN taken IS NULL THEN len(pool) ELSE taken + 1 END
    FROM (
      SELECT s.step, s.active, s.cur, bk.pool, ss.silent,
             CASE WHEN ss.silent THEN list_min(list_filter(range(0, len(bk.pool)),
               lambda i: NOT list_contains(s.active, bk.pool[(s.cur + i) % len(bk.pool) + 1]))) END AS taken
      FROM sweep s JOIN ss ON ss.position = s.step, bk
    )
  )
  SELECT ss.position, ss.keyword, f.active[ss.position + 1] AS new_keyword
  FROM ss, (SELECT active FROM sweep ORDER BY step DESC LIMIT 1) f
)"""

# ================================================================= health
sql(
    "freshness",
    f"""SELECT author, max(processed_at) AS last_activity,
       CAST(date_diff('microsecond', max(processed_at), {ASOF}) AS DOUBLE) / 1000000 AS age_seconds,
       COALESCE(CAST(date_diff('microsecond', max(processed_at), {ASOF}) AS DOUBLE) / 1000000 < 3600, false) AS healthy
     FROM posts GROUP BY author""",
)
OFFSETS = f""",
off AS (
  SELECT {ETYPE} AS "partition", CAST(0 AS BIGINT) AS low,
         NULLIF(count(*) FILTER (WHERE processed_at < {ASOF} - INTERVAL 6 HOUR), 0) AS committed,
         count(*) AS high
  FROM posts GROUP BY 1
),
lagged AS (
  SELECT *, CAST(greatest(0, high - CASE WHEN committed IS NULL OR committed < 0 THEN low ELSE committed END) AS BIGINT) AS lag
  FROM off
)
"""
ORACLE["backlog_by_partition"] = with_posts("").rstrip() + OFFSETS + "SELECT * FROM lagged"
ORACLE["backlog_total"] = with_posts("").rstrip() + OFFSETS + """SELECT count(*) AS partitions,
  CAST(sum(lag) AS BIGINT) AS total_lag, CAST(sum(lag) AS BIGINT) < 5000 AS healthy FROM lagged"""
sql(
    "batch_throughput",
    """SELECT batch_id, num_input_rows, CAST(sum(num_input_rows) OVER (ORDER BY batch_id) AS BIGINT) AS cumulative_rows
     FROM (SELECT CAST(floor(date_diff('microsecond', (SELECT min(processed_at) FROM posts), processed_at) / 3600000000) AS BIGINT)
                    AS batch_id, count(*) AS num_input_rows
           FROM posts GROUP BY 1)""",
)

# ============================================================== streaming
sql("stream_ingest", "SELECT * FROM posts")
sql("stream_dedup", "SELECT tweet_id, processed_at FROM posts")
ORACLE["stream_refresh"] = ORACLE["per_minute_series"]
ORACLE["sliding_window_sentiment"] = ORACLE["snapshot_series"]
ORACLE["stream_per_minute"] = ORACLE["per_minute_series"]
ORACLE["stream_silent_keywords"] = with_posts("").rstrip() + """,
kw AS (SELECT unnest(['click', 'error', '#Purchase', 'k3', 'nosuchkey', 'purchase k99', 'view k42']) AS keyword),
hits AS (
  SELECT DISTINCT kw.keyword, p.processed_at FROM kw JOIN posts p
    ON list_contains(list_transform(p.hashtags, lambda h: lower(h)), regexp_replace(lower(kw.keyword), '^#+', ''))
    OR contains(lower(p.text), regexp_replace(lower(kw.keyword), '^#+', ''))
),
gaps AS (
  SELECT keyword, processed_at AS last_seen,
         COALESCE(lead(processed_at) OVER (PARTITION BY keyword ORDER BY processed_at), (SELECT t FROM as_of)) AS after
  FROM hits
)
SELECT keyword, last_seen, last_seen + INTERVAL 3600 SECOND AS silent_at FROM gaps WHERE after >= last_seen + INTERVAL 3600 SECOND"""

KPI_COLUMNS = f"""count(*) AS total_tweets,
       {cnt('positive')} AS positive_count, {cnt('negative')} AS negative_count, {cnt('neutral')} AS neutral_count,
       {pct(cnt('positive'), 'count(*)', 2)} AS positive_pct, {avg4('compound_score')} AS avg_compound_score,
       (round(CAST(sum({LAG_US}) AS DOUBLE) / (count({LAG_US}) * 10000)) / 100) AS avg_lag_seconds"""
ORACLE["node_rolling_avg"] = ORACLE["rolling_1h_avg"]
sql(
    "node_window_kpis",
    f"""SELECT {KPI_COLUMNS} FROM posts
     WHERE processed_at >= {ASOF} - INTERVAL 9 DAY - INTERVAL 4321 SECOND AND processed_at <= {ASOF} - INTERVAL 1 DAY""",
)
sql(
    "cuboid_kpis",
    f"""SELECT date_trunc('hour', processed_at) AS hour, {KPI_COLUMNS} FROM posts
     WHERE lang = 'en' AND sentiment IN ('positive', 'negative') GROUP BY 1""",
)
ORACLE["bucketed_upsert"] = ORACLE["upsert_partial"]
ORACLE["bucketed_insert"] = ORACLE["insert_if_absent"]
sql("stream_bundle_series", series_sql("minute", avg4("compound_score"), f"WHERE processed_at >= {ASOF} - INTERVAL 180 MINUTE"))
ORACLE["stream_silence_alerts"] = ORACLE["stream_silent_keywords"]
# Eight replay files, two a micro-batch.
ORACLE["stream_batch_metrics"] = with_posts("").rstrip() + """,
r AS (
  SELECT *, like_count % 50 <> 0 AS named, retweet_count % 40 <> 7 AS classed, date_diff('microsecond', tweet_created_at, processed_at) // 1000000 AS lag FROM posts
)
SELECT CAST(4 AS BIGINT) AS batches, count(*) AS input_rows, count(*) FILTER (WHERE named AND classed) AS valid_rows,
       count(*) FILTER (WHERE NOT named) AS null_author, count(*) FILTER (WHERE NOT classed) AS bad_sentiment,
       CAST(sum(lag) FILTER (WHERE named AND classed) AS BIGINT) AS lag_sum, count(lag) FILTER (WHERE named AND classed) AS lag_rows,
       max(lag) FILTER (WHERE named AND classed) AS lag_max, max(processed_at) FILTER (WHERE named AND classed) AS newest
FROM r"""

# REST shape: same expected payload as the websocket shape.
ORACLE["normalize_rest"] = ORACLE["normalize_posts"]
sql(
    "normalize_scrape",
    f"""SELECT tweet_id, tweet_id AS id, text,
       CASE WHEN {ETYPE} = 'signup' THEN 'unknown' ELSE author END AS author,
       author_followers, lang,
       COALESCE(strftime(tweet_created_at, {ISO}), strftime({ASOF}, {ISO})) AS created_at,
       hashtags, retweet_count, like_count, 'twitter' AS source
     FROM posts""",
)

sql(
    "parse_tag_list",
    """SELECT event_id,
       list_filter(list_transform(string_split(' #' || event_type || ' ,k' || CAST(k % 10 AS VARCHAR) || ',, ##x,#', ','),
                                  lambda x: regexp_replace(trim(x), '^#', '')), lambda x: x <> '') AS tags,
       least(COALESCE(TRY_CAST(regexp_extract(trim(
               CASE WHEN event_type = 'view' THEN 'abc'
                    ELSE CAST(k * 3 AS VARCHAR) || CASE WHEN event_type = 'click' THEN 'px' ELSE '' END END),
             '^[+-]?[0-9]+', 0) AS INTEGER), 50), 200) AS limit_value
     FROM ev""",
)


# ====================================================== rule scorer (SEN-01)
def _rule_sql() -> str:
    from sentiflow.functions.rules import DEFAULT_PARAMS as P

    def lst(words):
        return ", ".join("'" + w.replace("'", "''") + "'" for w in words)

    def d(x):
        return f"CAST({x!r} AS DOUBLE)"

    up, down, negs = lst(P.boosters_up), lst(P.boosters_down), lst(P.negations)
    boost = lambda w: f"(CASE WHEN {w} IN ({up}) THEN {d(P.booster_increment)} WHEN {w} IN ({down}) THEN {d(P.booster_decrement)} END)"
    caps = lambda w: f"(upper({w}) = {w} AND lower({w}) <> {w})"
    negated = lambda w: f"COALESCE({w} IN ({negs}) OR contains({w}, 'n''t'), false)"
    inlex = lambda w: f"COALESCE({w} IN (SELECT token FROM lex), false)"
    damp = {1: 1.0, 2: 0.95, 3: 0.9}
    terms = []
    for k in (1, 2, 3):
        p, o = f"p{k}", f"o{k}"
        scalar = f"({boost(p)} * sg + CASE WHEN {caps(o)} AND mixed THEN sg * {d(P.caps_increment)} ELSE {d(0.0)} END)"
        terms.append(
            f"CASE WHEN {p} IS NOT NULL AND NOT {inlex(p)} AND {boost(p)} IS NOT NULL THEN {scalar} * {d(damp[k])} ELSE {d(0.0)} END"
        )
    neg, one = d(P.negation_scalar), d(1.0)
    f1 = f"CASE WHEN {negated('p1')} AND NOT {inlex('p1')} THEN {neg} ELSE {one} END"
    f2 = (f"CASE WHEN p2 = 'never' AND p1 IN ('so', 'this') THEN {d(P.never_so_scalar)} "
          f"WHEN {negated('p2')} AND NOT {inlex('p2')} THEN {neg} ELSE {one} END")
    f3 = (f"CASE WHEN p3 = 'never' AND (p2 IN ('so', 'this') OR p1 IN ('so', 'this')) THEN {d(P.never_so_scalar)} "
          f"WHEN {negated('p3')} AND NOT {inlex('p3')} THEN {neg} ELSE {one} END")
    fl = f"CASE WHEN p1 = 'least' AND NOT {inlex('p1')} AND NOT COALESCE(p2 IN ('at', 'very'), false) THEN {neg} ELSE {one} END"
    fb = f"CASE WHEN but > 0 AND i < but THEN {d(P.but_before)} WHEN but > 0 AND i > but THEN {d(P.but_after)} ELSE {one} END"
    caps_self = f"CASE WHEN {caps('wi')} AND mixed THEN sg * {d(P.caps_increment)} ELSE {d(0.0)} END"
    adjusted = f"(valence + {caps_self} + {terms[0]} + {terms[1]} + {terms[2]}) * ({f1}) * ({f2}) * ({f3}) * ({fl}) * ({fb})"
    silent = f"lwi IN ({up}, {down}) OR (lwi = 'kind' AND nxt = 'of')"
    punct = "'^[[:punct:]]+|[[:punct:]]+$'"
    return LEX + f""",
w AS (
  SELECT doc_id, COALESCE(text, '') AS text,
         list_filter(
           list_transform(regexp_split_to_array(trim(COALESCE(text, '')), '\\s+'),
             lambda t: CASE WHEN length(regexp_replace(t, {punct}, '', 'g')) <= 2 THEN t
                            ELSE regexp_replace(t, {punct}, '', 'g') END),
           lambda t: length(t) > 1) AS ws
  FROM documents WHERE text IS NOT NULL AND text <> '' AND lang IN ('en')
),
fl AS (
  SELECT doc_id, text, ws, list_transform(ws, lambda x: lower(x)) AS lws,
         COALESCE(list_bool_or(list_transform(ws, lambda x: {caps('x')})), false)
           AND COALESCE(list_bool_or(list_transform(ws, lambda x: NOT {caps('x')})), false) AS mixed
  FROM w
),
ex AS (
  SELECT doc_id, mixed, COALESCE(list_position(lws, 'but'), 0) AS but, i, lws[i] AS lwi, ws[i] AS wi,
         CASE WHEN i + 1 <= len(lws) THEN lws[i + 1] END AS nxt,
         CASE WHEN i > 1 THEN lws[i - 1] END AS p1, CASE WHEN i > 2 THEN lws[i - 2] END AS p2,
         CASE WHEN i > 3 THEN lws[i - 3] END AS p3,
         CASE WHEN i > 1 THEN ws[i - 1] END AS o1, CASE WHEN i > 2 THEN ws[i - 2] END AS o2,
         CASE WHEN i > 3 THEN ws[i - 3] END AS o3
  FROM (SELECT *, unnest(range(1, len(lws) + 1)) AS i FROM fl)
),
hit AS (SELECT ex.*, lex.valence, CAST(sign(lex.valence) AS DOUBLE) AS sg FROM ex JOIN lex ON ex.lwi = lex.token),
adj AS (SELECT doc_id, CASE WHEN {silent} THEN {d(0.0)} ELSE {adjusted} END AS v FROM hit),
rsum AS (SELECT doc_id, CAST(sum(CAST(v AS DECIMAL(20, 9))) AS DOUBLE) AS s FROM adj GROUP BY doc_id),
tot AS (
  SELECT w.doc_id, COALESCE(rsum.s, {d(0.0)}) AS s,
         least(length(w.text) - length(replace(w.text, '!', '')), {P.exclamation_max}) AS excl,
         length(w.text) - length(replace(w.text, '?', '')) AS ques
  FROM w LEFT JOIN rsum USING (doc_id)
),
ep AS (
  SELECT doc_id, s, excl * {d(P.exclamation_step)} + CASE WHEN ques > 3 THEN {d(P.question_max_value)}
         WHEN ques > 1 THEN ques * {d(P.question_step)} ELSE {d(0.0)} END AS ep FROM tot
),
fin AS (SELECT doc_id, CASE WHEN s > 0 THEN s + ep WHEN s < 0 THEN s - ep ELSE s END AS total FROM ep)
SELECT doc_id, greatest({d(-1.0)}, least({d(1.0)}, round(total / sqrt(total * total + {d(P.alpha)}), 4))) AS compound_score
FROM fin"""


ORACLE["rule_score"] = _rule_sql()

ORACLE["stream_ingest_documents"] = (
    "SELECT CAST(doc_id AS VARCHAR) AS tweet_id, 'en' AS lang, compound_score, CASE WHEN compound_score >= 0.05 THEN 'positive' "
    f"WHEN compound_score <= -0.05 THEN 'negative' ELSE 'neutral' END AS sentiment FROM ({ORACLE['rule_score']})"
)

ORACLE["tag_index_search"] = ORACLE["tag_overlap"]
ORACLE["posting_feed"] = ORACLE["search_posts"]
ORACLE["posting_counts"] = ORACLE["search_summary"]

ORACLE["trailing_window_partitioned"] = ORACLE["trailing_window"]

sql(
    "filtered_feed",
    """SELECT tweet_id, text, author, author_followers, hashtags, compound_score, sentiment, retweet_count, like_count,
       processed_at FROM posts WHERE list_has_any(hashtags, ['click', 'k3']) AND sentiment = 'negative'
     ORDER BY processed_at DESC, tweet_id DESC LIMIT 200""",
)
