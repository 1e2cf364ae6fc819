"""SQL for the queries that SQL can express, for an independent engine."""

from __future__ import annotations

from tripmetrics.llm import licenses, quality

_WORD = r"[^ \t-\r]+"


def _archives() -> str:
    # base 32: every five hexadecimal digits are four letters
    letters = " || ".join(
        "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
        f"1 + ((CAST('0x' || substr(digest, 5 * i + 1, 5) AS INTEGER) >> {shift}) & 31), 1)"
        for shift in (15, 10, 5, 0)
    )
    return f"""
        WITH payloads AS (
          SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
            sha1(coalesce(html, '')) AS digest, max(page_id) OVER (PARTITION BY html) AS first_id
          FROM (SELECT page_id, coalesce(html, '') AS html FROM pages)
        )
        SELECT page_id, payload_bytes,
          array_to_string(list_transform(range(0, 8), lambda i: {letters}), '') AS payload_digest,
          CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN page_id <> first_id THEN first_id END AS refers_to, true AS verified
        FROM payloads"""


def _licenses() -> str:
    def table(entries: dict[str, str]) -> str:
        return ", ".join(f"('{text}', '{name}')" for text, name in entries.items())

    known = table({text: name for name, text in licenses.SENTENCES.items()})
    rules = ", ".join(
        "CASE WHEN regexp_matches(line, ' {}') THEN '{}' END".format(
            " (.* )?".join(f"{one} " for one in sequence), name
        )
        for name, sequence in licenses.RULES
    )
    by_lines = r"[.!?;]+[ \n]+| ?\n[ \n]*"
    across = r"[.!?;]+[ \n]+| ?\n ?\n[ \n]*"
    plain = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
    return rf"""
        WITH known(sentence, name) AS (VALUES {known}),
        notices(sentence, name) AS (VALUES {table(licenses.NOTICES)}),
        tags(sentence, name) AS (VALUES {table(licenses.TAGS)}),
        docs AS (
          SELECT row_number() OVER () AS row_no, doc_id, regexp_replace(regexp_replace(
            coalesce(text, ''), '(?m)^[ \t]*(?:/\*+|\*+/?|//+|#+|--+|;+|%+|<!--)[ \t]?', '', 'g'),
            '[ \t\x0b\f\r]+', ' ', 'g') AS text FROM documents
        ),
        whole AS (
          SELECT row_no, unnest(parts) AS part, generate_subscripts(parts, 1) AS place
          FROM (SELECT row_no, string_split_regex(text, '{across}') AS parts FROM docs)
        ),
        piece AS (
          SELECT row_no, place, 0 AS spot, {plain.format("part")} AS words FROM whole
          UNION ALL
          SELECT row_no, place, generate_subscripts(parts, 1), {plain.format("unnest(parts)")}
          FROM (SELECT row_no, place, string_split_regex(part, '{by_lines}') AS parts FROM whole)
        ),
        named AS (
          SELECT row_no, place, spot, coalesce(known.name, notices.name, tags.name) AS name
          FROM piece LEFT JOIN known ON words = known.sentence
          LEFT JOIN notices ON regexp_extract(words, '{licenses.NOTICE}', 1) = notices.sentence
          LEFT JOIN tags ON regexp_extract(words, '{licenses.TAG}', 1) = tags.sentence
        ),
        found_ids AS (
          SELECT row_no, string_agg(name, ' ' ORDER BY place, spot) AS ids, count(*) AS n
          FROM (SELECT *, bool_or(spot > 0) OVER (PARTITION BY row_no, place, name) AS inside,
                  bool_or(spot > 0 AND name IS NOT NULL) OVER (PARTITION BY row_no, place) AS any_inside
                FROM named)
          WHERE name IS NOT NULL AND (spot > 0 OR NOT inside
            AND NOT (regexp_matches(name, '^(?:notice|spdx)_') AND any_inside)) GROUP BY row_no
        ),
        matched AS (
          SELECT doc_id, coalesce(n, 0) AS n_sentences, coalesce(ids, '') AS ids,
            list_filter([{rules}], lambda x: x IS NOT NULL) AS found
          FROM (SELECT *, ' ' || replace(coalesce(ids, ''), ' ', '  ') || ' ' AS line
                FROM docs LEFT JOIN found_ids USING (row_no))
        ),
        firsts AS (
          SELECT *, list_filter(found, lambda x, i: list_position(found, x) = i) AS names FROM matched
        )
        SELECT doc_id, names[1] AS license, array_to_string(names, ',') AS licenses,
          CAST(n_sentences AS BIGINT) AS n_sentences, ids AS sentence_ids FROM firsts"""


def _quality() -> str:
    count = "len(regexp_extract_all({}, '{}'))"
    symbols = count.format("line", "[#*$%&|<>]")
    shouts = count.format("line", "!")
    menus = count.format("line", " [|»·] ")
    # RE2 has no back references, so a stutter is counted word by word
    return rf"""
        WITH docs AS (
          SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text FROM documents
        ),
        cut AS (
          SELECT *, regexp_extract_all(text, '{_WORD}') AS words,
            list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines
          FROM docs
        ),
        word AS (
          SELECT row_no, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM cut
        ),
        win AS (
          SELECT row_no, place, string_agg(word, ' ') OVER near AS w, count(*) OVER near AS n
          FROM word WINDOW near AS (PARTITION BY row_no ORDER BY place
                                    ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)
        ),
        twice AS (
          SELECT row_no, place FROM win WHERE n = 8
          QUALIFY count(*) OVER (PARTITION BY row_no, w) > 1
        ),
        covered AS (
          SELECT row_no, sum(least(8, coalesce(following - place, 8)))
            AS n FROM (SELECT *, lead(place) OVER (PARTITION BY row_no ORDER BY place) AS following
                       FROM twice) GROUP BY row_no
        ),
        line AS (
          SELECT row_no, unnest(lines) AS line, generate_subscripts(lines, 1) AS line_no FROM cut
        ),
        token AS (
          SELECT row_no, line_no, unnest(parts) AS part, generate_subscripts(parts, 1) AS place
          FROM (SELECT *, string_split(line, ' ') AS parts FROM line)
        ),
        streak AS (
          SELECT row_no, line_no, part, place - row_number() OVER
            (PARTITION BY row_no, line_no, part ORDER BY place) AS streak FROM token
        ),
        stutter AS (
          SELECT row_no, line_no, sum(chars) AS chars FROM (
            SELECT row_no, line_no, count(*) * (length(part) + 1) - 1 AS chars FROM streak
            WHERE regexp_matches(part, '^\S+$') GROUP BY row_no, line_no, part, streak
            HAVING count(*) >= 4) GROUP BY row_no, line_no
        ),
        judged AS (
          SELECT row_no, length(line) AS size,
            {symbols} * {quality.SYMBOL_EVERY} > length(line)
            OR {shouts} * {quality.SHOUT_EVERY} > length(line)
            OR {menus} > {quality.MENU_SEPARATORS}
            OR (length(line) <= {quality.BOILERPLATE_CHARS}
                AND regexp_matches(line, '{quality.BOILERPLATE}'))
            OR (length(line) - coalesce(chars, 0)) * 2 < length(line) AS bad
          FROM line LEFT JOIN stutter USING (row_no, line_no)
        ),
        lost AS (
          SELECT row_no, sum(size) AS size, coalesce(sum(size) FILTER (WHERE bad), 0) AS lost
          FROM judged GROUP BY row_no
        ),
        base AS (
          SELECT doc_id, len(words) AS n_words,
            CAST(list_sum(list_transform(words, lambda x: length(x))) AS BIGINT) AS word_chars,
            len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
            len(lines) - len(list_distinct(lines)) AS n_dup_lines,
            CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
            CAST(coalesce(lost, 0) AS BIGINT) AS lost_chars, coalesce(size, 0) AS size
          FROM cut LEFT JOIN covered USING (row_no) LEFT JOIN lost USING (row_no)
        ),
        failing AS (
          SELECT *, n_words < 20
            OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base
        )
        SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines,
          n_repeat_words, base_failed, lost_chars,
          NOT base_failed AND 100 * lost_chars <= {quality.MAX_LOST_PERCENT} * size AS kept
        FROM failing"""


ORACLE: dict[str, str] = {
    "op2_exact_dedup": """
        WITH normalised AS (
          SELECT doc_id,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
        )
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
          doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
        FROM normalised WINDOW same AS (PARTITION BY norm)""",
    "op3_warc": _archives(),
    "op11_url_filter": r"""
        WITH rest AS (
          SELECT page_id, CASE WHEN contains(url, '://')
            THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
        ),
        located AS (
          SELECT page_id,
            translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
        ),
        ruled AS (
          SELECT page_id, host, path, CASE
            WHEN ends_with('.' || host, '.www.example.com') AND starts_with(path, '/en/')
              THEN 'www.example.com/en/'
            WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/en/')
              THEN 'example.com/en/'
            WHEN ends_with('.' || host, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
            WHEN ends_with('.' || host, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
            WHEN ends_with('.' || host, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule
          FROM located
        )
        SELECT page_id, host, path, rule,
          CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END
            AS verdict FROM ruled""",
    "op6_license_scan": _licenses(),
    "op8_quality_rules": _quality(),
}
