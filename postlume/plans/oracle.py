"""The registered queries as plain SQL on the same tables."""

from __future__ import annotations

from postlume.operators import lexicons as L
from postlume.schema import CATEGORIES

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"


def stamp(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {name or column.split('.')[-1]}"


def in_list(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in r) + ")"
                     for r in rows)


# -- sources ----------------------------------------------------------------------

def minutes_in(column: str) -> str:
    return f"make_timestamp((1704067200 + {column} * 60) * 1000000)"


DOCUMENTS = f"""
SELECT 'documents' AS source_table, CAST(doc_id AS VARCHAR) AS source_id, doc_id, text,
       source AS author, n_chars AS likes,
       CAST(len(regexp_extract_all(text, '\\n')) AS BIGINT) AS retweets,
       CAST(len(regexp_extract_all(text, '[.!?]')) AS BIGINT) AS replies,
       n_chars * 20 AS views,
       make_timestamp((1704067200 + doc_id * 60) * 1000000 - n_chars * 1500000) AS posted_at,
       '' AS keyword, lang AS region, {minutes_in('doc_id')} AS scraped_at, '' AS source_url
FROM documents"""

CONVERSATIONS = f"""
SELECT 'conversations' AS source_table, CAST(conv_id AS VARCHAR) AS source_id, conv_id,
       CASE WHEN title IS NULL THEN caption WHEN caption IS NULL THEN title
            ELSE concat(title, ' ', caption) END AS text,
       '' AS author, CAST(0 AS BIGINT) AS likes, CAST(0 AS BIGINT) AS retweets, n_turns AS replies,
       CAST(0 AS BIGINT) AS views, CAST(NULL AS TIMESTAMP) AS posted_at, '' AS keyword,
       '' AS region, {minutes_in('conv_id')} AS scraped_at, '' AS source_url
FROM (SELECT c.conv_id, count(*) AS n_turns,
             max(CASE WHEN c.turn = u.turn THEN c.text END) AS title,
             max(CASE WHEN c.turn = a.turn THEN c.text END) AS caption
      FROM conversations c
      LEFT JOIN (SELECT conv_id, min(turn) AS turn FROM conversations WHERE role = 'user'
                 GROUP BY conv_id) u ON u.conv_id = c.conv_id
      LEFT JOIN (SELECT conv_id, min(turn) AS turn FROM conversations WHERE role = 'assistant'
                 GROUP BY conv_id) a ON a.conv_id = c.conv_id
      GROUP BY c.conv_id)
WHERE title IS NOT NULL OR caption IS NOT NULL"""

PAGES = f"""
SELECT 'pages' AS source_table, CAST(page_id AS VARCHAR) AS source_id, page_id,
       regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS text, '' AS author,
       CAST(0 AS BIGINT) AS likes, CAST(0 AS BIGINT) AS retweets, CAST(0 AS BIGINT) AS replies,
       CAST(0 AS BIGINT) AS views, CAST(NULL AS TIMESTAMP) AS posted_at, '' AS keyword,
       '' AS region, {minutes_in('page_id')} AS scraped_at, url AS source_url
FROM pages"""

NORMALIZED = ("source_table, source_id, text, author, likes, retweets, replies, views, "
              + stamp("posted_at") + ", keyword, region, " + stamp("scraped_at") + ", source_url")

UNION = " UNION ALL ".join(
    "SELECT source_table, source_id, text, author, likes, retweets, replies, views, posted_at, "
    f"keyword, region, scraped_at, source_url FROM ({part})"
    for part in (DOCUMENTS, CONVERSATIONS, PAGES))


def per_user_day(amount: str) -> str:
    def total(kind):
        return (f"CAST(coalesce(floor(sum(CASE WHEN event_type = '{kind}' THEN {amount} END)), 0)"
                " AS BIGINT)")
    return f"""SELECT user_id, CAST(ts AS DATE) AS day, {total('click')} AS likes,
        {total('purchase')} AS retweets, {total('signup')} AS replies, {total('view')} AS views,
        min(ts) AS posted_at FROM events GROUP BY user_id, CAST(ts AS DATE)"""


EVENTS_DAILY = per_user_day("1")
EVENTS_VALUE = per_user_day("CAST(value AS DECIMAL(18,2))")

TWEETS = """
SELECT CAST(event_id AS VARCHAR) AS tweet_id,
       CASE WHEN event_type <> 'error' THEN props END AS tweet_text,
       concat('user ', user_id) AS author, concat('u', user_id) AS author_handle,
       CASE WHEN event_type = 'click' THEN CAST(floor(value) AS BIGINT) END AS likes,
       CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS BIGINT) END AS retweets,
       CASE WHEN event_type = 'signup' THEN CAST(floor(value) AS BIGINT) END AS replies,
       CASE WHEN event_type = 'view' THEN CAST(floor(value) AS BIGINT) END AS views,
       ts AS posted_at, event_type AS keyword, '' AS region, ts AS scraped_at,
       CAST(ts AS DATE) AS date
FROM events"""

TWEET_COLUMNS = ("tweet_id, tweet_text, author, author_handle, likes, retweets, replies, views, "
                 + stamp("posted_at") + ", keyword, region, " + stamp("scraped_at"))


# -- engagement ---------------------------------------------------------------------

def rounded(value: str, digits: int) -> str:
    """Correct rounding of the exact binary value, by way of its decimal text."""
    return f"CAST(format('{{:.{digits}f}}', {value}) AS DOUBLE)"


def engagement(source: str) -> str:
    """All columns of ``source`` and the seven metrics."""
    return f"""
SELECT *,
  {rounded('raw_score', 2)} AS engagement_score,
  {rounded('CASE WHEN v > 0 THEN (l + r + c) / v ELSE 0 END', 4)} AS engagement_rate,
  {rounded('CASE WHEN l + r + c > 0 THEN r / (l + r + c) ELSE 0 END', 4)} AS virality_score,
  {rounded('CASE WHEN l > 0 THEN (c + r) / l ELSE 0 END', 4)} AS interaction_quality,
  {rounded('CASE WHEN hours > 0 THEN raw_score / hours ELSE 0 END', 2)} AS time_adjusted_score,
  {rounded('scale', 2)} AS percentile_score,
  CASE WHEN scale >= 90 THEN 'Viral' WHEN scale >= 75 THEN 'High'
       WHEN scale >= 50 THEN 'Above Average' WHEN scale >= 25 THEN 'Average'
       WHEN scale >= 10 THEN 'Below Average' ELSE 'Low' END AS engagement_tier
FROM (SELECT *, CASE WHEN raw_score > 0 THEN least(100::DOUBLE, log10(raw_score + 1) * 25::DOUBLE)
                     ELSE 0::DOUBLE END AS scale
      FROM (SELECT *, l * 1::DOUBLE + r * 3::DOUBLE + c * 2::DOUBLE + v * 0.01::DOUBLE AS raw_score,
                   (epoch_us({AS_OF}) - epoch_us(posted_at)) / 1e6 / 3600::DOUBLE AS hours
            FROM (SELECT *, coalesce(likes, 0)::DOUBLE AS l, coalesce(retweets, 0)::DOUBLE AS r,
                         coalesce(replies, 0)::DOUBLE AS c, coalesce(views, 0)::DOUBLE AS v
                  FROM ({source}))))"""


# -- rules --------------------------------------------------------------------------

TOKENS = ("SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS w FROM documents")

_EMOTIONS = [(w, e) for e, listed in {**L.POSITIVE_EMOTIONS, **L.NEGATIVE_EMOTIONS}.items()
             for w in listed.split()]
SENTIMENT = f"""
WITH t AS ({TOKENS}),
polarity AS (SELECT doc_id, count(*) FILTER (WHERE w IN {in_list(L.POSITIVE)}) AS p,
                    count(*) FILTER (WHERE w IN {in_list(L.NEGATIVE)}) AS n FROM t GROUP BY doc_id),
emotions AS (SELECT doc_id, string_agg(DISTINCT emotion, ',' ORDER BY emotion) AS emotions
             FROM t JOIN (VALUES {values(_EMOTIONS)}) AS lex(w, emotion) USING (w) GROUP BY doc_id),
counted AS (SELECT doc_id, w, count(*) AS n FROM t
            WHERE length(w) >= 5 AND w NOT IN {in_list(L.words(L.STOP_WORDS))} GROUP BY doc_id, w),
topics AS (SELECT doc_id, string_agg(w, ',' ORDER BY place) AS topics
           FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, w) AS place
                 FROM counted) WHERE place <= 3 GROUP BY doc_id)
SELECT doc_id,
  CASE WHEN p > n THEN 'positive' WHEN n > p THEN 'negative' ELSE 'neutral' END AS sentiment_label,
  {rounded('CASE WHEN p + n > 0 THEN abs(p - n) / (p + n) ELSE 0 END', 4)} AS sentiment_score,
  coalesce(emotions, '') AS sentiment_emotions, coalesce(topics, '') AS sentiment_topics
FROM (SELECT doc_id, coalesce(p, 0) AS p, coalesce(n, 0) AS n, emotions, topics
      FROM documents LEFT JOIN polarity USING (doc_id) LEFT JOIN emotions USING (doc_id)
      LEFT JOIN topics USING (doc_id))"""

_PHRASES = [(p, kind) for kind, listed in L.GAZETTEER.items() for p in listed]


def _entity(kind: str) -> str:
    return (f"coalesce(string_agg(DISTINCT phrase, ',' ORDER BY phrase) "
            f"FILTER (WHERE kind = '{kind}'), '') AS {kind}")


ENTITIES = f"""
WITH lists AS (SELECT doc_id, regexp_extract_all(lower(text), '\\p{{L}}+') AS ws FROM documents),
places AS (SELECT doc_id, ws, unnest(generate_series(1, len(ws))) AS i FROM lists),
phrases AS (SELECT doc_id, ws[i] AS phrase FROM places
            UNION ALL SELECT doc_id, ws[i] || ' ' || ws[i + 1] FROM places WHERE i + 1 <= len(ws)
            UNION ALL SELECT doc_id, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FROM places
                      WHERE i + 2 <= len(ws))
SELECT doc_id, {', '.join(_entity(kind) for kind in L.GAZETTEER)}
FROM documents LEFT JOIN (
  SELECT doc_id, phrase, kind FROM phrases JOIN (VALUES {values(_PHRASES)}) AS g(phrase, kind)
  USING (phrase)) USING (doc_id)
GROUP BY doc_id"""

_TOPIC_WORDS = sorted({(w, c) for c, subs in L.TOPICS.items() for listed in subs.values()
                       for w in listed.split()})
_SUBS = sorted({(w, c, s) for c, subs in L.TOPICS.items() for s, listed in subs.items()
                for w in listed.split()})
_ORDER = [(c, f"{i:02d}", L.INDUSTRIES[c]) for i, c in enumerate(CATEGORIES)]
TOPIC = f"""
WITH t AS ({TOKENS}),
counted AS (SELECT doc_id, category, count(*) AS n
            FROM t JOIN (VALUES {values(_TOPIC_WORDS)}) AS lex(w, category) USING (w)
            GROUP BY doc_id, category),
chosen AS (SELECT doc_id, category FROM (
             SELECT doc_id, category, row_number() OVER (PARTITION BY doc_id
                    ORDER BY n DESC, place) AS best
             FROM counted JOIN (VALUES {values(_ORDER)}) AS o(category, place, industry)
             USING (category)) WHERE best = 1),
subs AS (SELECT doc_id, category, string_agg(DISTINCT sub, ',' ORDER BY sub) AS subs
         FROM t JOIN (VALUES {values(_SUBS)}) AS s(w, category, sub) USING (w)
         GROUP BY doc_id, category),
words AS (SELECT doc_id,
            string_agg(DISTINCT w, ',' ORDER BY w) FILTER (
              WHERE w IN {in_list(sorted({w for w, _ in _TOPIC_WORDS}))}) AS keywords,
            bool_or(w IN {in_list(L.words(L.COMMERCIAL))}) AS is_commercial,
            bool_or(w IN {in_list(L.words(L.NEWS))}) AS is_news FROM t GROUP BY doc_id)
SELECT doc_id, coalesce(category, 'Other') AS primary_category,
       coalesce(subs, '') AS sub_categories, coalesce(industry, 'Unknown') AS industry,
       coalesce(keywords, '') AS keywords, coalesce(is_commercial, false) AS is_commercial,
       coalesce(is_news, false) AS is_news
FROM documents LEFT JOIN chosen USING (doc_id) LEFT JOIN subs USING (doc_id, category)
LEFT JOIN words USING (doc_id)
LEFT JOIN (VALUES {values(_ORDER)}) AS o(category, place, industry) USING (category)"""

_FLAGS = [(w, f, L.WARNINGS[f]) for f, listed in L.MODERATION.items() for w in listed.split()]
MODERATION = f"""
WITH t AS ({TOKENS}),
hits AS (SELECT doc_id, count(*) AS n FROM t
         WHERE w IN {in_list(L.words(*L.MODERATION.values()))} GROUP BY doc_id),
raised AS (SELECT doc_id, string_agg(DISTINCT flag, ',' ORDER BY flag) AS flags,
                  string_agg(DISTINCT warning, ',' ORDER BY warning) AS warnings
           FROM t JOIN (VALUES {values(_FLAGS)}) AS lex(w, flag, warning) USING (w)
           GROUP BY doc_id)
SELECT doc_id, n = 0 AS is_safe,
  CASE WHEN n = 0 THEN 'safe' WHEN n = 1 THEN 'low' WHEN n = 2 THEN 'medium'
       WHEN n IN (3, 4) THEN 'high' ELSE 'critical' END AS risk_level,
  flags, warnings AS content_warnings,
  CASE WHEN n = 0 THEN 'none' WHEN n = 1 THEN 'flag' WHEN n BETWEEN 2 AND 4 THEN 'review'
       ELSE 'remove' END AS recommended_action,
  {rounded('CASE WHEN n = 0 THEN 1 ELSE n / (n + 1) END', 4)} AS confidence_score
FROM (SELECT doc_id, coalesce(n, 0) AS n, coalesce(flags, '') AS flags,
             coalesce(warnings, '') AS warnings
      FROM documents LEFT JOIN hits USING (doc_id) LEFT JOIN raised USING (doc_id))"""

# -- upsert -------------------------------------------------------------------------

_BEFORE = f"""SELECT p.*, 'neutral' AS sentiment_label, 'Low' AS engagement_tier,
    '0.9.0' AS enrichment_version, '2024-01-01' AS date
  FROM ({UNION}) p WHERE source_table = 'pages' OR (source_table = 'documents'
    AND source_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels))"""
_AFTER = f"SELECT *, '1.0.0' AS enrichment_version, '2024-02-01' AS date FROM ({engagement(DOCUMENTS)})"
UPSERT = f"""
WITH old AS ({_BEFORE}), new AS ({_AFTER})
SELECT coalesce(new.source_table, old.source_table) AS source_table,
       coalesce(new.source_id, old.source_id) AS source_id,
       CASE WHEN new.source_id IS NULL THEN old.author ELSE new.author END AS source_author,
       CASE WHEN new.source_id IS NULL THEN 'unset' ELSE new.region END AS region,
       CASE WHEN new.source_id IS NULL THEN old.likes ELSE new.likes END AS likes,
       CASE WHEN new.source_id IS NULL THEN old.retweets ELSE new.retweets END AS shares,
       old.sentiment_label, new.engagement_score,
       CASE WHEN new.source_id IS NULL THEN old.engagement_tier ELSE new.engagement_tier END
         AS engagement_tier,
       CASE WHEN new.source_id IS NULL THEN old.enrichment_version ELSE new.enrichment_version END
         AS enrichment_version,
       CASE WHEN new.source_id IS NULL THEN old.date ELSE new.date END AS date
FROM old FULL JOIN new ON old.source_table = new.source_table AND old.source_id = new.source_id"""

_TAGGED = ("SELECT doc_id, concat('#', lang, ' @', source, ' a@', source, '.org x#y #', lang, "
           "' #größe_1\n', text) AS text FROM documents")


def _marks(sign: str, before: str, name: str) -> str:
    word = "\\p{L}\\p{M}\\p{N}_"
    return f"""
SELECT doc_id, coalesce(string_agg(tag, ',' ORDER BY first), '') AS {name} FROM ({_TAGGED})
LEFT JOIN (SELECT doc_id, tag, min(place) AS first FROM (
    SELECT doc_id, unnest(found) AS tag, generate_subscripts(found, 1) AS place FROM (
      SELECT doc_id, regexp_extract_all(text, '(?:^|[^{word}{before}]){sign}([{word}]+)', 1) AS found
      FROM ({_TAGGED})))
  GROUP BY doc_id, tag) USING (doc_id) GROUP BY doc_id"""


def _answers() -> str:
    topics = "'\"sentiment_topics\":[\"' || lang || '\"]'"
    label, score, joy = ('"sentiment_label":"positive"', '"sentiment_score":0.5',
                         '"sentiment_emotions":["joy"]')

    def answer(*parts):
        return "'{" + ",".join(parts) + ",' || " + topics + " || '}'"

    listed = [answer(label, score, joy), answer(label, joy), answer(label, score, joy, '"mood":1'),
              answer(label, '"sentiment_score":"0.9"', joy), "'[1,2]'", "'null'", "'no answer {'",
              answer('"sentiment_label":"angry"', score, joy), "NULL", "'{}'",
              answer('"sentiment_label":null', score, '"sentiment_emotions":[]')]
    return " UNION ALL ".join(f"SELECT doc_id, {i} AS variant, {a} AS answer FROM documents"
                              for i, a in enumerate(listed))


ANSWERS = f"""
SELECT doc_id, variant,
  CASE WHEN kind = 'malformed' THEN 'unknown'
       WHEN label IN ('positive', 'negative', 'neutral') THEN label ELSE 'neutral' END
    AS sentiment_label,
  coalesce(score, 0) AS sentiment_score,
  coalesce(array_to_string(emotions, ','), '') AS sentiment_emotions,
  coalesce(array_to_string(topics, ','), '') AS sentiment_topics,
  CASE WHEN kind <> 'object' THEN kind
       WHEN label NOT IN ('positive', 'negative', 'neutral') THEN 'unknown_value'
       WHEN label IS NULL OR score IS NULL OR emotions IS NULL OR topics IS NULL THEN 'partial'
       ELSE 'ok' END AS sentiment_status
FROM (
  SELECT doc_id, variant, kind,
    json_extract_string(good, '$.sentiment_label') AS label,
    CASE WHEN json_type(good, '$.sentiment_score') IN ('DOUBLE', 'UBIGINT', 'BIGINT')
         THEN CAST(json_extract_string(good, '$.sentiment_score') AS DOUBLE) END AS score,
    CAST(json_extract(good, '$.sentiment_emotions') AS VARCHAR[]) AS emotions,
    CAST(json_extract(good, '$.sentiment_topics') AS VARCHAR[]) AS topics
  FROM (SELECT doc_id, variant, kind, CASE WHEN kind = 'object' THEN answer ELSE '{{}}' END AS good
        FROM (SELECT *, CASE WHEN answer IS NULL THEN 'failed'
                             WHEN NOT json_valid(answer) THEN 'malformed'
                             WHEN json_type(answer) <> 'OBJECT' THEN 'malformed'
                             ELSE 'object' END AS kind FROM ({_answers()}))))"""

_ALL_RULES = f"""
SELECT 'documents' AS source_table, source_id, text AS source_text, author AS source_author,
  source_url, keyword, region, {stamp('scraped_at')}, likes, retweets AS shares,
  replies AS comments, views, {stamp('posted_at')},
  sentiment_label, sentiment_score, sentiment_emotions, sentiment_topics,
  people, organizations, locations, products, hashtags, mentions,
  primary_category, sub_categories, industry, keywords, is_commercial, is_news,
  engagement_score, engagement_rate, virality_score, interaction_quality, time_adjusted_score,
  percentile_score, engagement_tier,
  is_safe, risk_level, flags, content_warnings, recommended_action, confidence_score,
  '2024-02-01 00:00:00' AS enriched_at, '1.0.0' AS enrichment_version, '2024-02-01' AS date
FROM ({engagement(DOCUMENTS)})
JOIN ({SENTIMENT}) USING (doc_id) JOIN ({ENTITIES}) USING (doc_id)
JOIN ({TOPIC}) USING (doc_id) JOIN ({MODERATION}) USING (doc_id)
JOIN (SELECT doc_id,
        array_to_string(list_sort(list_distinct(regexp_extract_all(
          text, '(?:^|[^\\p{{L}}\\p{{M}}\\p{{N}}_&/])#([\\p{{L}}\\p{{M}}\\p{{N}}_]+)', 1))), ',') AS hashtags,
        array_to_string(list_sort(list_distinct(regexp_extract_all(
          text, '(?:^|[^\\p{{L}}\\p{{M}}\\p{{N}}_.@])@([\\p{{L}}\\p{{M}}\\p{{N}}_]+)', 1))), ',') AS mentions
      FROM documents) USING (doc_id)"""

_MODERATED_TEXT = f"""
SELECT source_table, source_id, CASE WHEN n = 0 THEN 'safe' WHEN n = 1 THEN 'low'
       WHEN n = 2 THEN 'medium' WHEN n IN (3, 4) THEN 'high' ELSE 'critical' END AS risk_level
FROM (SELECT source_table, source_id, len(list_filter(regexp_extract_all(lower(text), '\\p{{L}}+'),
        lambda w: w IN {in_list(L.words(*L.MODERATION.values()))})) AS n FROM ({UNION}))"""


def _notations() -> str:
    day = "epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP))"
    expected = [day, "epoch_us(date_trunc('hour', ts))", "epoch_us(date_trunc('minute', ts))",
                "epoch_us(date_trunc('second', ts))", "epoch_us(ts) - 19800000000", day,
                "epoch_us(date_trunc('second', ts))", day] + ["CAST(NULL AS BIGINT)"] * 4
    return " UNION ALL ".join(f"SELECT event_id, {i} AS notation, {e} AS posted_us FROM events"
                              for i, e in enumerate(expected))


def _crawled(table: str, text: str = "CASE WHEN event_type <> 'error' THEN props END", missing: str = "") -> str:
    """A source as the target should see it; ``missing`` names what its crawler does not record."""
    def count(name: str, kind: str) -> str:
        found = f"CASE WHEN event_type = '{kind}' THEN CAST(floor(value) AS BIGINT) ELSE 0 END"
        return f"{'CAST(0 AS BIGINT)' if name in missing.split() else found} AS {name}"

    posted = "CAST(NULL AS VARCHAR) AS posted_at" if "posted_at" in missing.split() else stamp("ts", "posted_at")
    region = "''" if "region" in missing.split() else "CASE WHEN event_type = 'view' THEN '' ELSE event_type END"
    return f"""
SELECT '{table}' AS source_table, CAST(event_id AS VARCHAR) AS source_id, {text} AS text, concat('u', user_id) AS author,
       {count('likes', 'click')}, {count('retweets', 'purchase')}, {count('replies', 'signup')}, {count('views', 'view')},
       {posted}, event_type AS keyword, {region} AS region, {stamp('ts', 'scraped_at')}, '' AS source_url
FROM events WHERE {text} IS NOT NULL"""


_REDDIT = ("CASE event_type WHEN 'view' THEN concat(props, ' ', event_type) WHEN 'click' THEN props "
           "WHEN 'signup' THEN event_type END")
_CRAWLED = " UNION ALL ".join([
    _crawled("x_tweets"), _crawled("apify_x_tweets"), _crawled("apify_tiktok_posts"),
    _crawled("instagram_posts", missing="retweets posted_at"),
    _crawled("reddit_posts", _REDDIT, missing="retweets views region"),
    _crawled("tiktok_videos", missing="posted_at region"),
    _crawled("youtube_videos", missing="retweets")])

_SHARED = """SELECT CAST(doc_id AS VARCHAR) AS source_id, lang = 'de' AS blank,
  CASE lang WHEN 'en' THEN 'the shared text' WHEN 'de' THEN ' ' ELSE text END AS t FROM documents"""


ORACLE: dict[str, str] = {
    "engagement_scores": f"""
SELECT user_id, CAST(day AS VARCHAR) AS day, engagement_score, engagement_rate, virality_score,
       interaction_quality, percentile_score, engagement_tier FROM ({engagement(EVENTS_DAILY)})""",
    "engagement_tiers": f"""
SELECT engagement_tier, count(*) AS n FROM ({engagement(EVENTS_VALUE)}) GROUP BY engagement_tier""",
    "time_adjusted": f"""
SELECT user_id, CAST(day AS VARCHAR) AS day, {stamp('posted_at')}, engagement_score,
       time_adjusted_score FROM ({engagement(EVENTS_VALUE)})""",
    "parse_posted_at": _notations(),
    "normalize_documents": f"SELECT {NORMALIZED} FROM ({DOCUMENTS})",
    "normalize_conversations": f"SELECT {NORMALIZED} FROM ({CONVERSATIONS})",
    "coalesce_text": """
SELECT conv_id, turn, CASE WHEN title IS NULL THEN caption WHEN caption IS NULL THEN title
       ELSE concat(title, ' ', caption) END AS text
FROM (SELECT conv_id, turn, CASE WHEN role = 'user' THEN text WHEN turn = 1 THEN '' END AS title,
             CASE WHEN role = 'assistant' OR turn = 2 THEN text END AS caption FROM conversations)""",
    "blank_text_filter": """
SELECT doc_id, variant, variant >= 2 OR NOT regexp_matches(text, '\\S') AS blank
FROM documents, (VALUES (0), (1), (2), (3), (4), (5), (6), (7)) AS v(variant)""",
    "union_providers": f"SELECT {NORMALIZED} FROM ({UNION})",
    "latest_posts": f"""
SELECT {TWEET_COLUMNS} FROM (SELECT * FROM ({TWEETS}) WHERE tweet_text IS NOT NULL
  ORDER BY scraped_at DESC, tweet_id LIMIT 100)""",
    "posts_by_date_range": f"""
SELECT {TWEET_COLUMNS} FROM (SELECT * FROM ({TWEETS}) WHERE tweet_text IS NOT NULL
  AND date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'
  ORDER BY scraped_at DESC, tweet_id LIMIT 1000)""",
    "all_providers": _CRAWLED,
    "posts_of_stored_days": f"""
WITH tweets AS ({TWEETS}), worst AS (
  SELECT date FROM tweets WHERE keyword = 'error' GROUP BY date ORDER BY count(*) DESC, date LIMIT 3)
SELECT {TWEET_COLUMNS} FROM (SELECT * FROM tweets WHERE tweet_text IS NOT NULL
  AND date IN (SELECT date FROM worst) ORDER BY scraped_at DESC, tweet_id LIMIT 1000)""",
    "topk_large": f"""
SELECT source_id, {stamp('max(t)', 'scraped_at')}, CAST(count(*) AS BIGINT) AS copies FROM (
  SELECT source_id, t, row_number() OVER (ORDER BY t DESC NULLS LAST, source_id) AS place FROM (
    SELECT CASE WHEN event_type = 'view' THEN 'hot' ELSE CAST(user_id AS VARCHAR) END AS source_id,
           CASE WHEN event_type <> 'error' THEN date_trunc('day', ts) END AS t FROM events))
WHERE place <= (SELECT count(*) // 2 FROM events) GROUP BY source_id""",
    "rejected_rows": f"""
WITH r AS (SELECT ts, user_id, CASE WHEN event_type <> 'signup' THEN CAST(event_id AS VARCHAR) END AS source_id,
    CASE WHEN event_type NOT IN ('error', 'view') THEN CAST(floor(value) AS BIGINT) END AS likes,
    concat_ws(',', CASE WHEN event_type = 'error' THEN 'likes=none' END, CASE WHEN value < 10 THEN 'scraped_at=soon' END,
              CASE WHEN event_type = 'signup' THEN 'source_id=no key' END) AS reasons FROM events)
SELECT 'events' AS source_table, source_id, CASE WHEN reasons = '' THEN likes END AS likes,
       CASE WHEN reasons = '' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS scraped_at,
       CASE WHEN reasons = '' THEN CAST(user_id AS VARCHAR) END AS keywords, reasons FROM r""",
    "unenriched_posts": f"""
SELECT source_table, source_id, author, region, {stamp('scraped_at')} FROM ({DOCUMENTS}) d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "pending_hot_id": f"""
SELECT source_id, {stamp('max(scraped_at)', 'scraped_at')}, count(*) AS copies FROM (
  SELECT CASE WHEN event_type = 'view' THEN 'hot' WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS source_id,
         ts AS scraped_at FROM events) e
WHERE source_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels WHERE CAST(doc_id AS VARCHAR) = source_id)
GROUP BY source_id""",
    "posted_at_types": """
SELECT event_id, epoch_us(ts) AS plain_us, epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP)) AS day_us,
       epoch_us(date_trunc('second', ts)) AS text_us, CAST(NULL AS BIGINT) AS number_us FROM events""",
    "topk_per_provider": f"""
SELECT author, source_id, {stamp('scraped_at')} FROM (
  SELECT *, row_number() OVER (PARTITION BY author ORDER BY scraped_at DESC, source_id) AS n
  FROM ({DOCUMENTS})) WHERE n <= 3""",
    "dedup_latest": f"""
SELECT user_id, event_id, event_type, value, {stamp('ts', 'scraped_at')} FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n
  FROM events) WHERE n = 1""",
    "upsert_enrichments": UPSERT,
    "upsert_table": UPSERT,
    "upsert_single_key": """
WITH old AS (SELECT * FROM orders WHERE o_orderstatus IN ('F', 'P')),
     new AS (SELECT * FROM orders WHERE o_orderstatus IN ('P', 'O'))
SELECT coalesce(new.o_orderkey, old.o_orderkey) AS o_orderkey, old.o_custkey,
       CASE WHEN new.o_orderkey IS NULL THEN old.o_orderstatus ELSE 'U' END AS o_orderstatus,
       CASE WHEN new.o_orderkey IS NULL THEN old.o_orderpriority
            WHEN new.o_orderpriority <> '5-LOW' THEN new.o_orderpriority END AS o_orderpriority
FROM old FULL JOIN new ON old.o_orderkey = new.o_orderkey""",
    "legacy_shape": f"""
SELECT tweet_id, tweet_text, author, author_handle, l::BIGINT AS likes, r::BIGINT AS retweets,
       c::BIGINT AS replies, v::BIGINT AS views, {stamp('posted_at')}, keyword, region,
       {stamp('scraped_at')}, CAST(NULL AS VARCHAR) AS sentiment_label, engagement_score,
       engagement_tier, '2024-02-01 00:00:00' AS enriched_at, '1.0.0' AS enrichment_version,
       '2024-02-01' AS date
FROM ({engagement(TWEETS)}) WHERE tweet_text IS NOT NULL""",
    "sink_coercion": f"""
SELECT 'events' AS source_table, CAST(event_id AS VARCHAR) AS source_id,
       regexp_extract(props, '"k": *([0-9]+)', 1) AS source_text, {stamp('ts', 'scraped_at')},
       CASE WHEN event_type <> 'view' THEN CAST(floor(value) AS BIGINT) END AS likes,
       value AS sentiment_score, event_type = 'error' AS is_news,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM events""",
    "hashtags": _marks("#", "&/", "hashtags"),
    "mentions": _marks("@", ".@", "mentions"),
    "sentiment_rules": SENTIMENT,
    "entities_gazetteer": ENTITIES,
    "topic_rules": TOPIC,
    "moderation_rules": MODERATION,
    "moderation_eval": f"""
SELECT count(*) FILTER (WHERE NOT is_safe AND toxic = 1) AS tp,
       count(*) FILTER (WHERE NOT is_safe AND toxic = 0) AS fp,
       count(*) FILTER (WHERE is_safe AND toxic = 1) AS fn,
       count(*) FILTER (WHERE is_safe AND toxic = 0) AS tn
FROM ({MODERATION}) JOIN labels USING (doc_id)""",
    "annotation_defaults": ANSWERS,
    "model_backend_fake": """
SELECT 'documents' AS source_table, CAST(doc_id AS VARCHAR) AS source_id,
       CASE WHEN length(text) - length(replace(text, 'e', ''))
                 > length(text) - length(replace(text, 'a', ''))
            THEN 'positive' ELSE 'negative' END AS sentiment_label,
       (length(text) % 100) / 100::DOUBLE AS sentiment_score, 'sentiment' AS sentiment_emotions,
       '' AS sentiment_topics, 'ok' AS sentiment_status FROM documents""",
    "model_backend_tasks": f"""
SELECT 'documents' AS source_table, source_id, '' AS people, CASE WHEN blank THEN '' ELSE 'org' END AS organizations,
  CASE WHEN blank THEN '' ELSE CAST(length(t) % 7 AS VARCHAR) END AS locations, '' AS products, '' AS hashtags,
  CASE WHEN blank THEN '' ELSE 'entities' END AS mentions, CASE WHEN blank THEN 'blank' ELSE 'ok' END AS entities_status,
  CASE WHEN NOT blank AND length(t) % 2 = 1 THEN 'Science' ELSE 'Other' END AS primary_category, '' AS sub_categories,
  CASE WHEN blank THEN 'Unknown' ELSE 'print' END AS industry,
  CASE WHEN blank THEN '' ELSE CAST(length(t) % 5 AS VARCHAR) END AS keywords,
  NOT blank AND length(t) % 3 = 0 AS is_commercial, false AS is_news,
  CASE WHEN blank THEN 'blank' WHEN length(t) % 2 = 1 THEN 'ok' ELSE 'unknown_value' END AS topic_status,
  blank OR length(t) % 2 = 0 AS is_safe, CASE WHEN blank THEN 'safe' ELSE 'low' END AS risk_level,
  CASE WHEN blank THEN '' ELSE 'spam' END AS flags, '' AS content_warnings,
  CASE WHEN blank THEN 'none' ELSE 'flag' END AS recommended_action, 1::DOUBLE AS confidence_score,
  CASE WHEN blank THEN 'blank' WHEN length(t) % 3 > 0 THEN 'unknown_value' ELSE 'partial' END AS moderation_status
FROM ({_SHARED})""",
    "run_stats": f"""
SELECT source_table, count(source_id) AS fetched, count(*) - count(source_id) AS null_ids,
       count(DISTINCT source_id) AS written
FROM (SELECT source_table, source_id FROM ({UNION}) UNION ALL
      SELECT 'events', CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END FROM events) u
WHERE source_table <> 'documents'
      OR source_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)
GROUP BY source_table""",
    "enrich_full": _ALL_RULES,
    "enrich_run": f"""
SELECT source_table, source_id, text AS source_text, source_url, replies AS comments,
       CAST(NULL AS VARCHAR) AS sentiment_label, engagement_score, engagement_tier, risk_level,
       '1.0.0' AS enrichment_version, '2024-02-01' AS date
FROM ({engagement(UNION)}) JOIN ({_MODERATED_TEXT}) USING (source_table, source_id)""",
    "custom_module": f"""
SELECT source_table, source_id, CAST(length(text) AS INT) AS n_letters,
       list_contains(regexp_extract_all(lower(text), '\\p{{L}}+'), 'team') AS greets, engagement_score
FROM ({engagement(DOCUMENTS)})""",
    "stream_copies": """
SELECT DISTINCT 'events' AS source_table, CAST(user_id AS VARCHAR) AS source_id, 'seen' AS source_text,
       'Low' AS engagement_tier, '2024-02-01' AS date FROM events WHERE event_type <> 'error'""",
    "incremental_stream": f"""
SELECT source_table, source_id, author AS source_author, likes, retweets AS shares,
       replies AS comments, views, {stamp('posted_at')}, engagement_score, time_adjusted_score,
       engagement_tier, '2024-02-01' AS date FROM ({engagement(DOCUMENTS)})""",
}
