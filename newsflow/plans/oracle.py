"""DuckDB SQL with the expected result of every registered query.

The expected values are stated from the driver's tables directly - a ticker list by ``key % 6``, for
example - and not by parsing the JSON that the Spark side builds and parses.
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------------------------
_SPACES = (
    "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||' '||chr(133)||chr(160)"
    "||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)"
    "||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)"
)
_WORD = r"[^\t\n\v\f\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
# The entities that occur in the driver's pages; the ampersand last, because entities are read once.
_ENTITIES = (("&copy;?", "©"), ("&middot;?", "·"), ("&quot;?", '"'), ("&lt;?", "<"), ("&gt;?", ">"), ("&amp;?", "&"))
# Markup and what takes its place.
_MARKUP = (
    (r"</p>\s*<p>", "chr(10)||chr(10)"),
    (r"<br\s*/?>", "chr(10)"),
    (r"</div>\s*<div>", "chr(10)||chr(10)"),
    ("<li>", "'• '"),
    ("</li>", "chr(10)"),
    ("<[^>]+>", "''"),
)
# The prompts, stated here once more so that the tested text is not its own measure.
_ARTICLE_PROMPT = "Summarize this financial news article about {ticker}."
_HTML_PROMPT = "Summarize this financial news article about {ticker} that is provided in raw HTML format."
_ARTICLE_RULES = """Requirements:
- Maximum {max_words} words (shorter is fine if content is brief)
- Focus on key facts, financial impact, and stock implications
- Include specific numbers, percentages, and dates when relevant
- Write in clear, professional financial journalism style
- Start directly with the news content (no meta-commentary)
- Prioritize actionable information for investors"""
_HTML_RULES = """Requirements:
- Maximum {max_words} words (shorter is fine if content is brief)
- Extract and summarize the main article content from the HTML
- Focus on key facts, financial impact, and stock implications
- Include specific numbers, percentages, and dates when relevant
- Write in clear, professional financial journalism style
- Start directly with the news content (no meta-commentary)
- Prioritize actionable information for investors
- Ignore any HTML tags, formatting, or navigation elements"""
# ----------------------------------------------------------------------------------------------


def _markup(x: str) -> str:
    out = f"coalesce({x},'')"
    for pattern, replacement in _MARKUP:
        out = f"regexp_replace({out},'{pattern}',{replacement},'gi')"
    return out


def _unescape(x: str) -> str:
    for pattern, replacement in _ENTITIES:
        x = f"regexp_replace({x},'{pattern}','{replacement}','g')"
    return x


def _tidy(x: str) -> str:
    x = rf"regexp_replace(regexp_replace({x},' +',' ','g'),'\n{{3,}}',chr(10)||chr(10),'g')"
    lines = f"list_transform(string_split({x},chr(10)), lambda l: trim(l,{_SPACES}))"
    return f"trim(array_to_string({lines},chr(10)),{_SPACES})"


def _clean(x: str) -> str:
    return _tidy(_unescape(_markup(x)))


def _words(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x},'{_WORD}')) AS BIGINT)"


_MILLIS = "CAST(trunc(epoch_us(ts)::DOUBLE/1e6*1e3) AS BIGINT)"
_ROUNDED = "round({}::DOUBLE,6)"


_EVENT = "coalesce(e.ts, TIMESTAMP '2024-01-01') AS ts, coalesce(e.event_type, 'none') AS event_type"


def _title(x: str) -> str:
    return rf"regexp_extract({x},'^[^.!?\n]*[.!?]?')"


def _articles(source: str) -> str:
    if source == "pages":
        base = (
            "SELECT p.page_id AS key, p.url, regexp_extract(p.html,'<title>([^<]*)</title>',1) AS title, p.html AS body,"
            f" {_EVENT} FROM pages p LEFT JOIN events e ON e.event_id = p.page_id"
        )
    else:
        base = (
            f"SELECT d.doc_id AS key, 'https://news.example/'||d.doc_id AS url, {_title('d.text')} AS title,"
            f" d.text AS body, {_EVENT} FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id"
        )
    return f"""base AS ({base}), article AS (SELECT key, url, title, body, ts,
        CASE WHEN key%3<>0 THEN '<p>'||event_type||'</p>' END AS teaser,
        CASE WHEN key%3<>0 THEN event_type ELSE '' END AS teaser_clean,
        CASE key%4 WHEN 1 THEN 'Updated' ELSE 'Created' END AS action,
        CASE key%3 WHEN 1 THEN ['Ann'] WHEN 2 THEN ['Ann','Bo '||key] ELSE []::VARCHAR[] END AS authors,
        CASE key%5 WHEN 1 THEN ['News'] WHEN 2 THEN ['News','Markets'] WHEN 3 THEN ['Solo'] ELSE []::VARCHAR[] END AS channels,
        CASE key%6 WHEN 1 THEN ['T'||(key%20)] WHEN 2 THEN ['T'||(key*2%20)] WHEN 3 THEN ['T'||(key%20),'T'||(key*2%20)]
          WHEN 4 THEN ['T'||(key*3%20)] WHEN 5 THEN ['T'||(key*5%20)] ELSE []::VARCHAR[] END AS tickers,
        CASE key%6 WHEN 0 THEN 0 WHEN 3 THEN 2 WHEN 4 THEN 4 ELSE 1 END AS n_securities,
        (epoch_us(ts)//1000000-300)*1000 AS created_at,
        CASE WHEN key%7<>0 THEN epoch_us(ts)//1000 END AS updated_at,
        strftime(to_timestamp(0)::TIMESTAMP + to_seconds(epoch_us(ts)//1000000-300),'%Y-%m-%dT%H:%M:%SZ') AS created_iso,
        CASE WHEN key%7<>0 THEN strftime(ts,'%Y-%m-%dT%H:%M:%S.%fZ') END AS updated_iso
        FROM base)"""


_HAS_TICKER = "len(tickers) > 0"


def _cleaned(source: str, body: str = "body_clean") -> str:
    blank = "CASE WHEN key%5<>0 THEN body_clean ELSE ' ' END" if body == "blanked" else "body_clean"
    return f"""{_articles(source)}, plain AS (SELECT *, {_clean("body")} AS body_clean FROM article WHERE {_HAS_TICKER}),
        cleaned AS (SELECT * REPLACE ({blank} AS body_clean) FROM plain)"""


_WHOLE = "coalesce(nullif(body_clean,''),nullif(teaser_clean,''),nullif(title,''),'No content available')"
_CONTENT = _WHOLE.replace("body_clean", "substring(body_clean,1,1000)")


def _lead(text: str, words: int) -> str:
    """The first words of a text, up to the last end of a sentence in them; all words if there are not more."""
    found = f"regexp_extract_all({text},'{_WORD}')"
    cut = f"array_to_string({found}[1:{words}],' ')"
    return f"""CASE WHEN len({found})<={words} THEN {cut}
        ELSE coalesce(nullif(regexp_extract({cut},'^(.*[.!?])( .*)?$',1),''),{cut}) END"""


_SUMMARY = f"coalesce(nullif({_lead('body_clean', 200)},''),nullif(teaser_clean,''),{_CONTENT})"


def _records(source: str, content: str = _WHOLE) -> str:
    return f"""{_cleaned(source)}, record AS (SELECT *, {content} AS content,
        unnest(tickers) AS ticker, CAST(generate_subscripts(tickers,1)-1 AS BIGINT) AS pos FROM cleaned)"""


_FLAT = f"""SELECT {_MILLIS} AS "timestamp", ticker, key AS news_id, action, title, content,
    array_to_string(authors,'|') AS authors, url, array_to_string(channels,'|') AS channels, created_at, updated_at, pos
    FROM record"""

_LINE = f"""to_json({{"timestamp": {_MILLIS}, "ticker": ticker, "news_id": key, "action": action, "title": title,
    "content": content, "authors": authors, "url": url, "channels": channels, "created_at": created_iso,
    "updated_at": updated_iso}})::VARCHAR"""
_LINE_BYTES = "CAST(octet_length(encode(line))+1 AS BIGINT)"

# Outcome of the damaged messages.
_OUTCOME = """CASE WHEN key%16 IN (0,7) THEN 'decode-failed' WHEN key%16 IN (1,2,3,6,8,9,11) THEN 'validation-failed'
    WHEN len(tickers)=0 THEN 'no-securities' ELSE 'accepted' END"""

_LOG = """log AS (SELECT *, CAST(json_extract(props,'$.k') AS BIGINT) AS k,
    CASE WHEN event_type='error' THEN 'WARNING' WHEN event_type='view' OR event_type='signup' AND event_id%2=1 THEN 'ERROR'
      ELSE 'DEBUG' END AS level,
    CASE WHEN event_type IN ('error','click') OR event_type='view' AND event_id%2=1 THEN 'app.summarizer'
      ELSE 'app.client' END AS logger,
    CASE WHEN event_type='error' THEN 'bedrock-throttled' WHEN event_type='click' THEN 'article-summarized'
      WHEN event_type='view' AND event_id%2=1 THEN 'article-summarization-failed' WHEN event_type='view' THEN 'summarization-failed'
      WHEN event_type='signup' AND event_id%2=1 THEN 'ws-error' WHEN event_type='signup' THEN 'multi-ticker-article'
      ELSE 'writing record' END AS event
    FROM events)"""


def _window(minutes: int, ts: str = "ts") -> str:
    return f"date_trunc('hour',{ts}) + to_minutes(CAST(minute({ts})//{minutes}*{minutes} AS BIGINT))"


def _label(start: str, minutes: int) -> str:
    end = f"({start} + to_minutes({minutes}) - INTERVAL 1 SECOND)"
    return f"strftime({start},'%Y%m%d_%H%M')||'-'||strftime({end},'%Y%m%d_%H%M')"


# The writer row by row: a file is closed by the first row that finds the limit reached.
_ROTATED = f"""{_records("documents", _SUMMARY)}, sized AS (SELECT key, pos, ts, {_LINE} AS line, {_window(30)} AS start FROM record),
    measured AS (SELECT key AS news_id, pos, ts, start, {_label("start", 30)} AS part, {_LINE_BYTES} AS bytes FROM sized),
    ranked AS (SELECT *, row_number() OVER w AS rn, CAST(coalesce(sum(bytes) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0) AS BIGINT) AS bytes_before
      FROM measured WINDOW w AS (PARTITION BY part ORDER BY ts, news_id, pos)),
    rotated AS (SELECT *, CAST(0 AS BIGINT) AS file_seq, CAST(bytes AS BIGINT) AS held FROM ranked WHERE rn = 1 UNION ALL
      SELECT r.*, CASE WHEN f.held >= 20000 THEN f.file_seq + 1 ELSE f.file_seq END, CASE WHEN f.held >= 20000 THEN r.bytes ELSE f.held + r.bytes END
      FROM rotated f JOIN ranked r ON r.part = f.part AND r.rn = f.rn + 1)"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _prompt(opening: str, heading: str, body: str, requirements: str, max_words: int, teaser: str) -> str:
    first = _text(opening).replace("{ticker}", "'||tickers[1]||'")
    closing = _text(requirements.format(max_words=max_words))
    return (
        f"{first}||chr(10)||chr(10)||'Title: '||title||chr(10)||{teaser}chr(10)||'{heading}'||chr(10)||{body}"
        f"||chr(10)||chr(10)||{closing}"
    )


_TEASER_LINE = "CASE WHEN teaser_clean<>'' THEN 'Teaser: '||teaser_clean||chr(10) ELSE '' END||"

_ISO = "strftime(ts,'%Y-%m-%dT%H:%M:%S.%f')"
_REST = """',"n":'||event_id||',"type":"'||event_type||'"}'"""

def _legacy(content: str) -> str:
    return f"""legacy AS (SELECT doc_id, source AS path, text AS body, {_title("text")} AS title, doc_id%10 IN (0,1,2) AS failed,
        {_clean("text")} AS body_clean, '' AS teaser_clean FROM documents), done AS (SELECT *, {content} AS content FROM legacy)"""


_BACKFILLED = """SELECT path, doc_id AS news_id, 'T'||(doc_id%20) AS ticker, 1704067200000 AS "timestamp", 'Created' AS action,
    title, content, '' AS authors FROM done WHERE NOT failed"""

ORACLE: dict[str, str] = {
    "validate_split": f"WITH {_articles('documents')} SELECT key, {_OUTCOME} AS outcome FROM article",
    "quarantine_counts": f"""WITH {_articles("documents")} SELECT {_OUTCOME} AS reason, count(*) AS messages FROM article
        WHERE {_OUTCOME} <> 'accepted' GROUP BY 1""",
    "quarantine_errors": f"""WITH {_articles("documents")} SELECT 'validation-failed' AS reason, field, sent, wanted, count(*) AS messages
        FROM article JOIN (VALUES (1,'$','BIGINT','object'), (11,'$','ARRAY','object'), (2,'data.id','missing','integer'), (3,'data.content.type','BIGINT','text'),
        (6,'data.id','DECIMAL','integer'), (8,'data.content.revision_id','STRING','integer'), (9,'data.timestamp','STRING','time')) AS e(k, field, sent, wanted)
        ON k = key%16 GROUP BY ALL""",
    "typed_messages": f"""WITH {_articles("documents")} SELECT key, 'websocket/v1' AS api_version, 'News/v1' AS kind,
        CASE WHEN key%16<>5 THEN CASE key%4 WHEN 0 THEN 'Created' WHEN 1 THEN 'Updated' WHEN 2 THEN '' END END AS action,
        'story' AS type, body, CASE WHEN key%16=4 THEN 'u' ELSE url END AS url, array_to_string(authors,'|') AS authors,
        array_to_string(channels,'|') AS channels, CAST(n_securities AS BIGINT) AS n_securities, CASE WHEN key%16=5 THEN 12 ELSE key END AS id,
        CASE WHEN key%16=5 THEN 1759428000000000 ELSE epoch_us(ts) END AS timestamp_us, key AS content_id,
        CAST(1 AS BIGINT) AS revision_id, title, teaser, created_at AS created_ms, updated_at AS updated_ms
        FROM article WHERE {_OUTCOME} = 'accepted'""",
    "coerce_lists": f"""WITH {_articles("documents")} SELECT key, array_to_string(authors,'|') AS authors,
        array_to_string(channels,'|') AS channels, CAST(n_securities AS BIGINT) AS n_securities FROM article""",
    "extract_symbols": f"""WITH {_articles("documents")} SELECT key, array_to_string(tickers,'|') AS tickers,
        CAST(len(tickers) AS BIGINT) AS n_tickers, tickers[1] AS primary_ticker FROM article""",
    "clean_steps": f"""WITH a AS (SELECT page_id, {_markup("html")} AS stripped FROM pages),
        b AS (SELECT *, {_unescape("stripped")} AS unescaped FROM a) SELECT *, {_tidy("unescaped")} AS cleaned FROM b""",
    "clean_articles": f"""WITH {_cleaned("pages")} SELECT key, body_clean, teaser_clean, tickers[1] AS primary_ticker
        FROM cleaned""",
    "clean_size": f"""WITH {_cleaned("pages")}, s AS (SELECT octet_length(encode(body)) AS r, octet_length(encode(body_clean)) AS c,
        octet_length(encode({_SUMMARY})) AS k FROM cleaned) SELECT count(*) AS articles, CAST(sum(r) AS BIGINT) AS raw_bytes,
        CAST(sum(c) AS BIGINT) AS clean_bytes, CAST(sum(k) AS BIGINT) AS content_bytes,
        round(1 - sum(k)::DOUBLE/sum(r)::DOUBLE,6) AS saved FROM s""",
    "fallback_content": f"""WITH {_articles("documents")} SELECT key, coalesce(nullif(substring(CASE WHEN key%5<>0 THEN body
        ELSE '' END,1,1000),''),nullif(teaser,''),nullif(CASE WHEN key%2<>0 THEN title END,''),'No content available')
        AS content FROM article""",
    "summary_routing": f"""WITH {_cleaned("documents", "blanked")} SELECT key,
        trim(body_clean,{_SPACES})<>'' OR teaser_clean<>'' AS has_summary,
        CAST(CASE WHEN trim(body_clean,{_SPACES})<>'' THEN 1 ELSE 0 END AS BIGINT) AS attempts FROM cleaned""",
    "summarize_extractive": f"""WITH {_cleaned("documents", "blanked")}, w AS (SELECT *, trim(body_clean,{_SPACES})<>'' AS called
        FROM cleaned) SELECT key, CASE WHEN called THEN {_lead("body_clean", 60)} ELSE nullif(teaser_clean,'') END AS summary,
        CAST(called AS BIGINT) AS attempts, CASE WHEN called THEN 'primary' END AS model_used FROM w""",
    "reused_summaries": f"""WITH {_cleaned("documents")}, w AS (SELECT *, trim(body_clean,{_SPACES})<>'' AS called FROM cleaned)
        SELECT key, CASE WHEN called THEN {_lead("body_clean", 200)} ELSE nullif(teaser_clean,'') END AS summary,
        CAST(called AND key%2=1 AS BIGINT) AS attempts FROM w""",
    "summarized_records": f"WITH {_records('documents', _SUMMARY)} {_FLAT}",
    "summarized_lines": f"""WITH {_records("documents", _SUMMARY)}, l AS (SELECT key AS news_id, pos, {_LINE} AS line FROM record)
        SELECT news_id, pos, line, {_LINE_BYTES} AS bytes FROM l""",
    "prompts": f"""WITH {_cleaned("documents", "blanked")} SELECT key, CASE WHEN trim(body_clean,{_SPACES})<>'' THEN
        {_prompt(_ARTICLE_PROMPT, "Article:", "body_clean", _ARTICLE_RULES, 200, _TEASER_LINE)} END
        AS prompt, CAST(360 AS BIGINT) AS max_tokens FROM cleaned""",
    "html_prompts": f"""WITH {_articles("pages")} SELECT key,
        {_prompt(_HTML_PROMPT, "HTML Content:", "body", _HTML_RULES, 150, "")} AS prompt,
        CAST(295 AS BIGINT) AS max_tokens FROM article WHERE {_HAS_TICKER}""",
    "word_count": f"SELECT doc_id, {_words('text')} AS words FROM documents",
    "preview": """SELECT doc_id, substring(text,1,100) AS preview, CAST(length(text) AS BIGINT) AS n_characters
        FROM documents""",
    "ticker_records": f"WITH {_records('pages')} {_FLAT}",
    "document_records": f"WITH {_records('documents')} {_FLAT}",
    "by_ticker": f"WITH {_records('pages')} {_FLAT} WHERE ticker = 'T4'",
    "ndjson_lines": f"""WITH {_records("pages")}, l AS (SELECT key AS news_id, pos, {_LINE} AS line FROM record)
        SELECT news_id, pos, line, {_LINE_BYTES} AS bytes FROM l""",
    "assign_windows": f"""SELECT event_id, strftime({_window(30)},'%Y-%m-%d') AS ingest_dt, strftime({_window(30)},'%H') AS hour,
        {_label(f"({_window(30)})", 30)} AS part, epoch_ms({_window(45)}) AS start_45,
        {_label(f"({_window(45)})", 45)} AS part_45, {_label("date_trunc('hour',ts)", 120)} AS part_120 FROM events""",
    "rotate_files": f"""WITH RECURSIVE {_ROTATED} SELECT news_id, pos, part, bytes, bytes_before, file_seq FROM rotated""",
    "mon_rotation": f"""WITH RECURSIVE {_ROTATED} SELECT strftime(start,'%Y-%m-%d') AS ingest_dt, strftime(start,'%H') AS hour, part,
        CAST(max(file_seq)+1 AS BIGINT) AS files, count(*) AS records, CAST(sum(bytes) AS BIGINT) AS bytes
        FROM rotated GROUP BY ALL""",
    "rewrite_archive": f"""SELECT event_id AS key, CASE event_id%8
        WHEN 1 THEN '{{"timestamp":'||epoch_us(ts)//1000||{_REST}
        WHEN 2 THEN '{{"timestamp": '||CAST(trunc((epoch_us(ts)-18000000000)::DOUBLE/1e6*1e3) AS BIGINT)||{_REST}
        WHEN 3 THEN '{{"meta":{{"timestamp":"'||{_ISO}||'Z"}}'||{_REST}
        WHEN 4 THEN '{{"meta":{{"timestamp":"'||{_ISO}||'Z"}},"timestamp":'||{_MILLIS}||{_REST}
        WHEN 5 THEN '{{"timestamp":"'||{_ISO}||'Z"'
        WHEN 6 THEN '{{"timestamp":"soon"'||{_REST} WHEN 7 THEN ''
        ELSE '{{"timestamp":'||{_MILLIS}||{_REST} END AS line FROM events""",
    "lenient_lines": """SELECT event_id AS key, CAST(event_id%8<>5 AS BIGINT) AS is_json FROM events
        WHERE event_id%8<>7""",
    "bad_line_numbers": """SELECT file, line_number FROM (SELECT event_id%8 AS kind, event_id%3 AS file, row_number() OVER (PARTITION BY event_id%3
        ORDER BY event_id) AS line_number FROM events) WHERE kind=5""",
    "legacy_backfill": f"WITH {_legacy(_SUMMARY)} {_BACKFILLED}",
    "legacy_backfill_html": f"WITH {_legacy(_SUMMARY.replace(_lead('body_clean', 200), _lead('body', 200)))} {_BACKFILLED}",
    "migration_failures": """SELECT source AS path, doc_id AS key, CASE doc_id%10 WHEN 0 THEN 'decode-failed' WHEN 1 THEN
        'missing-ticker' ELSE 'wrong-type' END AS reason FROM documents WHERE doc_id%10<3""",
    "migration_stats": f"""WITH {_legacy(_SUMMARY)} SELECT count(DISTINCT path) AS files_processed, count(*) AS records_processed,
        count(*) FILTER (NOT failed) AS records_transformed, count(*) FILTER (failed) AS records_failed,
        count(*) FILTER (NOT failed AND {_words("body_clean")}>0) AS ai_summaries_generated,
        count(*) FILTER (NOT failed AND {_words("body_clean")}=0) AS html_fallbacks_used FROM done""",
    "log_fields": f"""WITH {_LOG} SELECT level, logger, epoch_us(ts)//1000000*1000 AS time_ms, event,
        CASE WHEN event IN ('bedrock-throttled','article-summarized','article-summarization-failed','writing record') THEN 'T'||user_id END AS ticker,
        CASE WHEN event IN ('summarization-failed','multi-ticker-article','writing record') THEN event_id END AS news_id,
        CASE WHEN event IN ('bedrock-throttled','article-summarization-failed') THEN k%3+1 WHEN event='article-summarized' THEN 1 END AS attempt,
        CASE WHEN event='article-summarized' THEN k END AS words, CASE WHEN event='multi-ticker-article' THEN k%4+2 END AS tickers,
        CASE WHEN event='article-summarization-failed' THEN 'Code'||(k%3) END AS error_code,
        CASE WHEN event='ws-error' THEN 'closed'||(k%2) END AS reason,
        CASE WHEN event='bedrock-throttled' THEN (k%3+1)::DOUBLE WHEN event='ws-error' THEN k%5+1.5::DOUBLE END AS wait_seconds FROM log""",
    "mon_outcomes": f"""WITH {_LOG} SELECT event, count(*) AS total FROM log
        WHERE event IN ('article-summarized','article-summarization-failed','summarization-failed') GROUP BY event""",
    "mon_success_rate": f"""WITH {_LOG} SELECT count(*) FILTER (event='article-summarized') AS successes, count(*) AS attempts,
        round(count(*) FILTER (event='article-summarized')::DOUBLE/count(*),6) AS success_rate FROM log
        WHERE event IN ('article-summarized','summarization-failed')""",
    "mon_retries": f"""WITH {_LOG} SELECT 'T'||user_id AS ticker, count(*) AS retries, {_ROUNDED.format("avg(k%3+1)")} AS avg_attempt
        FROM log WHERE event_type='error' GROUP BY user_id""",
    "mon_multi_ticker": f"""WITH {_LOG} SELECT count(*) AS articles, {_ROUNDED.format("avg(k%4+2)")} AS avg_tickers,
        max(k%4+2) AS max_tickers FROM log WHERE event='multi-ticker-article'""",
    "mon_multi_ticker_articles": f"""WITH {_articles("documents")} SELECT count(*) AS articles,
        {_ROUNDED.format("avg(len(tickers))")} AS avg_tickers, CAST(max(len(tickers)) AS BIGINT) AS max_tickers
        FROM article WHERE len(tickers)>1""",
    "mon_per_minute": """SELECT epoch_us(ts)//60000000*60000 AS minute_ms, count(*) AS records FROM events
        WHERE event_type='purchase' GROUP BY 1""",
    "mon_errors": f"""WITH {_LOG} SELECT logger, event, count(*) AS total, count(*) FILTER (level='ERROR') AS errors,
        count(*) FILTER (event_type='error') AS throttled, count(*) FILTER (event='ws-error') AS reconnects FROM log
        WHERE level IN ('WARNING','ERROR') GROUP BY logger, event""",
    "mon_log_counts": f"""WITH {_LOG}, o AS (SELECT event, count(*) AS outcomes FROM log
        WHERE event IN ('article-summarized','article-summarization-failed','summarization-failed') GROUP BY event),
        e AS (SELECT logger, event, count(*) AS total, count(*) FILTER (level='ERROR') AS errors, count(*) FILTER (event_type='error') AS throttled,
        count(*) FILTER (event='ws-error') AS reconnects FROM log WHERE level IN ('WARNING','ERROR') GROUP BY logger, event) SELECT * FROM e LEFT JOIN o USING (event)""",
    "mon_latency_rollup": """SELECT epoch_ms(date_trunc('day',ts)) AS start_ms, count(*) AS n, max(value) AS highest, round(avg(value),6) AS mean,
        quantile_disc(value,0.5) AS p50, quantile_disc(value,0.99) AS p99 FROM events WHERE value IS NOT NULL GROUP BY 1""",
    "mon_latency": """SELECT nullif(event_type,'signup') AS event_type, count(value) AS n, round(quantile_cont(value,0.5),6) AS p50,
        round(quantile_cont(value,0.99),6) AS p99 FROM events GROUP BY 1""",
    "mon_lag": """WITH l AS (SELECT strftime(ts,'%Y-%m-%d') AS day, CAST(floor(value*1000) AS BIGINT) AS lag FROM events)
        SELECT day, count(*) AS n, round(avg(lag)::DOUBLE,6) AS avg_lag_ms, round(quantile_cont(lag::DOUBLE,0.5),6) AS p50_lag_ms,
        round(quantile_cont(lag::DOUBLE,0.99),6) AS p99_lag_ms, max(lag) AS max_lag_ms FROM l GROUP BY day""",
    "mon_lag_windows": """WITH l AS (SELECT epoch_us(ts) AS e, epoch_us(ts)+CAST(floor(value) AS BIGINT)*1000000 AS i FROM events)
        SELECT i//3600000000*3600000 AS window_ms, count(*) AS n, round(avg(i//1000-e//1000)::DOUBLE,6) AS avg_lag_ms,
        round(quantile_cont((i//1000-e//1000)::DOUBLE,0.5),6) AS p50_lag_ms, round(quantile_cont((i//1000-e//1000)::DOUBLE,0.99),6) AS p99_lag_ms,
        max(i//1000-e//1000) AS max_lag_ms FROM l GROUP BY 1""",
    "mon_cost": f"""WITH u AS (SELECT CASE WHEN doc_id%7=0 THEN NULL WHEN doc_id%5=0 THEN 'unpriced' WHEN doc_id%3=0 THEN 'small' ELSE 'large' END AS model, {_words("text")} AS w
        FROM documents), t AS (SELECT model, count(*) AS calls, CAST(sum(w+100) AS BIGINT) AS tokens_in,
        CAST(sum(least(w,200)) AS BIGINT) AS tokens_out FROM u GROUP BY model)
        SELECT model, calls, tokens_in, tokens_out, round((CASE model WHEN 'small' THEN tokens_in*0.25+tokens_out*1.25
        WHEN 'large' THEN tokens_in*3.0+tokens_out*15.0 END)::DOUBLE/1000000,6) AS cost_usd FROM t""",
}
# The same rows, however the summaries are stored.
ORACLE["store_summaries"] = ORACLE["reused_summaries"]
