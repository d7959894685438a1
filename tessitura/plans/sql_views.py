"""DuckDB text of the views in ``views.Tables``; ``with_views`` adds the ones a query names."""

from __future__ import annotations

import re

SQL_VIEWS: dict[str, str] = {
    "ev": r"""
        SELECT user_id AS song_id, event_id, event_type, value, epoch_us(ts) AS start_us,
               CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS k
        FROM events""",
    "notes": """
        SELECT song_id, row_number() OVER (PARTITION BY song_id ORDER BY start_us, event_id) - 1 AS note_index,
               event_type AS track, 48 + k % 25 AS pitch, start_us,
               start_us + CAST(round(value * 100) AS BIGINT) * 6000000 AS end_us
        FROM ev""",
    "mono_notes": """
        SELECT song_id, note_index, track, pitch, start_us,
               least(end_us, coalesce(lead(start_us) OVER (PARTITION BY song_id ORDER BY note_index), end_us)) AS end_us
        FROM notes""",
    "windows": """
        SELECT song_id, song_id || '-' || day || p AS clip_id,
               day * 86400000000 + f * 3600000000 AS start_us, day * 86400000000 + t * 3600000000 AS end_us
        FROM (SELECT DISTINCT song_id, start_us // 86400000000 AS day FROM ev),
             (VALUES ('a', 0, 12), ('b', 12, 20)) AS w(p, f, t)""",
    "exclusions": "SELECT song_id, start_us, end_us FROM notes WHERE track = 'error'",
    "on_off": """
        SELECT song_id AS track, event_id, start_us, k % 8 AS pitch,
               CASE WHEN event_type = 'click' THEN 'on' ELSE 'off' END AS kind
        FROM ev WHERE event_type IN ('click', 'view')""",
    "clips": """
        SELECT d.doc_id AS clip_id, source AS song_id, sha256(text) AS audio_sha256, n_chars AS duration_ms,
               lang AS language,
               CASE WHEN quality = 1 THEN 'accepted' WHEN quality = 0 THEN 'rejected' ELSE 'review' END AS status,
               CASE WHEN toxic = 0 THEN 'confirmed' ELSE 'uncertain' END AS singer_status,
               CASE WHEN n_chars >= 500 THEN 'clean' ELSE 'artifact' END AS quality,
               CASE WHEN d.doc_id % 10 < 8 THEN 'train' WHEN d.doc_id % 10 = 8 THEN 'validation' ELSE 'benchmark' END AS split
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "members": "SELECT page_id, url AS path, sha256(html) AS sha256, length(html) AS bytes FROM pages",
    "registered": """
        SELECT page_id, url AS path, CASE WHEN page_id % 7 = 0 THEN sha256(html || 'x') ELSE sha256(html) END AS sha256
        FROM pages WHERE page_id % 11 <> 0""",
    "issues": """
        SELECT 'ds-' || substr(sha1(song_id || '|' || event_type || '|' || k), 1, 12) AS issue_id,
               CAST(song_id AS VARCHAR) AS song_id,
               CASE event_type WHEN 'error' THEN 'MIDI_GAP_AUDIO_CONFLICT' WHEN 'signup' THEN 'INTRA_PHRASE_MIDI_GAP'
                    WHEN 'view' THEN 'PRONUNCIATION_CROSSCHECK_MISMATCH' ELSE 'OTHER_ISSUE' END AS type,
               k AS boundary_index, event_type || '-' || k AS segment_id,
               CASE WHEN event_type = 'purchase' THEN 'accepted' ELSE 'pending' END AS status, event_id AS position
        FROM ev""",
    "variants": """
        SELECT conv_id, turn, backend,
               CASE backend WHEN 'a' THEN lower(text) WHEN 'b' THEN regexp_replace(lower(text), '[.,]', '', 'g')
                    ELSE replace(lower(text), 'é', 'e') END AS line
        FROM conversations, (VALUES ('a'), ('b'), ('c')) AS b(backend)""",
    "dictionary": "SELECT p_brand AS key, p_type AS value, p_size % 3 AS layer, p_partkey AS position FROM part",
    "item_elements": """
        SELECT l_orderkey AS item_id, l_linenumber AS line, l_partkey AS part, l_suppkey AS supp,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(l_quantity AS BIGINT) AS note_dur,
               CAST(round(l_extendedprice) AS BIGINT) % 50 AS ph_dur,
               CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS note_slur, l_linestatus AS unit
        FROM lineitem""",
    "frames": "SELECT label AS song_id, vec_id AS frame, embedding AS samples FROM embeddings",
    "frame_values": """
        SELECT label AS song_id, vec_id AS frame, i - 1 AS idx, CAST(embedding[i] AS DOUBLE) AS x,
               embedding[i] > 0 AS voiced, 220.0 * pow(2.0, CAST(embedding[i] AS DOUBLE)) AS f0
        FROM embeddings, range(1, 65) AS r(i)""",
    "captions": """
        SELECT conv_id AS song, turn AS id, text, duration_ms,
               coalesce(sum(duration_ms) OVER (PARTITION BY conv_id ORDER BY turn, text
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start_ms,
               length(text) - length(replace(text, ',', '')) AS commas,
               length(text) - length(replace(text, '.', '')) AS stops,
               length(text) - length(replace(text, ' ', '')) AS blanks
        FROM (SELECT *, greatest(1, length(text)) * 50 AS duration_ms FROM conversations)""",
}

# Interval unions as reusable SQL: macro-like templates filled with a source name.
UNION_SQL = """
    SELECT song_id, min(start_us) AS start_us, max(end_us) AS end_us FROM (
        SELECT *, sum(fresh) OVER (PARTITION BY song_id ORDER BY start_us, end_us ROWS UNBOUNDED PRECEDING) AS island
        FROM (SELECT song_id, start_us, end_us, CASE WHEN start_us > coalesce(max(end_us) OVER (
                  PARTITION BY song_id ORDER BY start_us, end_us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1)
                  THEN 1 ELSE 0 END AS fresh
              FROM {src} WHERE end_us > start_us))
    GROUP BY song_id, island"""
for _src in ("notes", "windows", "exclusions", "mono_notes"):
    SQL_VIEWS[f"u_{_src}"] = UNION_SQL.format(src=_src)


def _needed(text: str) -> list[str]:
    found: list[str] = []

    def visit(body: str) -> None:
        for word in SQL_VIEWS:
            if re.search(rf"\b{word}\b", body) and word not in found:
                visit(SQL_VIEWS[word])
                if word not in found:
                    found.append(word)

    visit(text)
    return found


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the view definitions it uses, in dependency order."""
    views = _needed(sql)
    own = sql.strip()
    parts = [f"{name} AS MATERIALIZED ({SQL_VIEWS[name]})" for name in views]
    if own.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ",\n".join([*parts, own[15:]])
    if own.upper().startswith("WITH "):
        parts.append(own[5:])
        return "WITH " + ",\n".join(parts)
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + own
