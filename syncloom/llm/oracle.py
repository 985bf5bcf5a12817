"""Check SQL, in DuckDB's dialect, of the queries that SQL can express.

Each function gives the named steps (common table expressions) over a table of documents, the last
of which is the result, so that the pipeline's SQL is the same steps one after the other.
"""

from __future__ import annotations

from syncloom.llm.common import LOWER, UPPER
from syncloom.llm.licenses import COPYRIGHT_LINE, KNOWN, PUNCTUATION, SPELLINGS, full_texts
from syncloom.llm.quality_rules import STOP_WORDS
from syncloom.llm.quotes import MARKS, PUNCTUATION as MARKS_BETWEEN, SENTENCE

Steps = dict[str, str]

WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORDS = r"'[^\x20\x09-\x0D]+'"
TERMS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
SEED = 7


def _words(text: str) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), {WORDS})"


def _lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


def _digest(*parts: str) -> str:
    return "md5('" + str(SEED) + "' || '|' || " + " || '|' || ".join(parts) + ")"


def quality(docs: str, p: str) -> Steps:
    stops = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    return {
        f"{p}_split": f"""
            SELECT *, {_words("text")} AS w, list_filter(
                   string_split(coalesce(text, ''), chr(10)), lambda l: trim(l, {WHITE}) <> '') AS lines
            FROM {docs}""",
        f"{p}_grams": f"""
            SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM {p}_split)""",
        f"{p}_repeated": f"""
            SELECT doc_id, count(DISTINCT i + k) AS n
            FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS k
                  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM {p}_grams)
                  WHERE c > 1)
            GROUP BY doc_id""",
        f"{p}_counted": f"""
            SELECT s.* EXCLUDE (w, lines), CAST(len(w) AS BIGINT) AS n_words,
                   CAST(length(translate(coalesce(text, ''), {WHITE}, '')) AS BIGINT) AS word_chars,
                   CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g')) AS BIGINT)
                       AS n_symbols,
                   CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                   coalesce(r.n, 0) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines,
                   CAST(len(list_filter(w, lambda x: x IN ({stops}))) AS BIGINT) AS n_stop_words
            FROM {p}_split s LEFT JOIN {p}_repeated r USING (doc_id)""",
        f"{p}_based": f"""
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
            FROM {p}_counted""",
        p: f"""
            SELECT *, NOT base_failed AND n_words BETWEEN 50 AND 1000000
                   AND word_chars / n_words BETWEEN 1.5 AND 20
                   AND n_symbols / n_words <= 0.2 AND n_stop_words / n_words >= 0.01
                   AND (n_lines = 0 OR n_dup_lines / n_lines <= 0.5)
                   AND n_repeat_words / n_words <= 0.5 AS kept
            FROM {p}_based""",
    }


def similar(docs: str, p: str) -> Steps:
    return {
        f"{p}_words": f"""
            SELECT doc_id, regexp_extract_all({_lower("text")}, {WORDS}) AS w FROM {docs}""",
        f"{p}_sets": f"""
            SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
                   WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                   ELSE list_transform(range(1, len(w) - 3),
                                       lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
            FROM {p}_words""",
        f"{p}_members": f"SELECT doc_id, len(s) AS n, unnest(s) AS g FROM {p}_sets",
        f"{p}_links": f"""
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM {p}_members a JOIN {p}_members b ON a.g = b.g AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))""",
        f"RECURSIVE {p}_reach": f"""
            SELECT doc_id, doc_id AS other FROM {docs}
            UNION
            SELECT r.doc_id, l.b FROM {p}_reach r JOIN {p}_links l ON l.a = r.other""",
        p: f"""
            SELECT d.*, CAST(len(s) AS BIGINT) AS n_shingles, c.component_id
            FROM {docs} d JOIN {p}_sets USING (doc_id)
            JOIN (SELECT doc_id, min(other) AS component_id FROM {p}_reach GROUP BY doc_id) c
              USING (doc_id)""",
    }


def contamination(docs: str, p: str) -> Steps:
    return {
        f"{p}_items": f"""
            SELECT item_id, w, least(len(w), 13) AS n
            FROM (SELECT item_id, regexp_extract_all({_lower("text")}, {TERMS}) AS w FROM benchmark)
            WHERE len(w) > 0 AND item_id IS NOT NULL""",
        f"{p}_windows": f"""
            SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
            FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM {p}_items)""",
        f"{p}_words": f"""
            SELECT doc_id, regexp_extract_all({_lower("text")}, {TERMS}) AS w FROM {docs}""",
        f"{p}_places": f"""
            SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                  FROM {p}_words, (SELECT DISTINCT n FROM {p}_windows))""",
        f"{p}_found": f"SELECT doc_id, item_id, i, n FROM {p}_places JOIN {p}_windows USING (n, g)",
        f"{p}_hits": f"""
            SELECT doc_id, count(DISTINCT spot) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS spot FROM {p}_found) GROUP BY doc_id""",
        f"{p}_ids": f"""
            SELECT doc_id, list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))) AS ids
            FROM {p}_found GROUP BY doc_id""",
        f"{p}_all": f"""
            SELECT d.*, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
                   CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
                   sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256
            FROM {docs} d JOIN {p}_words USING (doc_id)
            LEFT JOIN {p}_hits USING (doc_id) LEFT JOIN {p}_ids USING (doc_id)""",
        p: f"SELECT *, n_hit > 0 AND 20 * n_hit >= n_words AS contaminated FROM {p}_all",
    }


def mixed(docs: str, p: str) -> Steps:
    return {
        f"{p}_sized": f"""
            SELECT *, CAST(len({_words("text")}) AS BIGINT) AS size,
                   {_digest("CAST(doc_id AS VARCHAR)")} AS digest
            FROM {docs}""",
        f"{p}_weights": f"""
            SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]
                           AS DOUBLE) AS weight
            FROM (SELECT source, CAST(sum(size) AS BIGINT) AS size FROM {p}_sized GROUP BY source)""",
        f"{p}_capped": f"""
            SELECT *, size * CAST(2 AS DOUBLE) AS cap,
                   (sum(size) OVER ()) * CAST(1.5 AS DOUBLE) AS goal
            FROM {p}_weights""",
        f"{p}_shared": f"""
            SELECT *, goal - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
                   sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
            FROM {p}_capped""",
        f"{p}_clamped": f"""
            SELECT *, cap * open_weight <= weight * left_over AS clamped FROM {p}_shared""",
        f"{p}_targets": f"""
            SELECT source, size AS source_size, CASE WHEN clamped THEN cap ELSE weight * (goal -
                       sum(CASE WHEN clamped THEN cap ELSE 0 END) OVER ()) /
                       (sum(CASE WHEN clamped THEN 0 ELSE weight END) OVER ()) END AS target
            FROM {p}_clamped""",
        f"{p}_steps": f"""
            SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END
                           AS BIGINT) AS whole
            FROM {p}_targets""",
        f"{p}_running": f"""
            SELECT d.*, t.source_size, t.target, t.whole, t.target - t.whole * t.source_size AS fraction,
                   coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY digest, d.size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM {p}_sized d JOIN {p}_steps t ON t.source IS NOT DISTINCT FROM d.source""",
        p: f"""
            SELECT *, whole + CASE WHEN fraction > 0 AND 2 * before + size <= 2 * fraction
                              THEN 1 ELSE 0 END AS copies
            FROM {p}_running""",
    }


def sharded(docs: str, p: str, n_shards: int) -> Steps:
    return {
        f"{p}_ranked": f"""
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY digest) AS r,
                   count(*) OVER (PARTITION BY source) AS n,
                   (CAST('0x' || substr(draw, 1, 8) AS BIGINT) + 0.5) / CAST(4294967296 AS DOUBLE) AS u
            FROM (SELECT *, {_digest("CAST(doc_id AS VARCHAR)")} AS digest,
                         {_digest("'draw'", "coalesce(source, chr(0))")} AS draw FROM {docs})""",
        f"{p}_placed": f"""
            SELECT *, row_number() OVER (ORDER BY (r - u) / n, source NULLS FIRST, digest) - 1 AS spot,
                   count(*) OVER () AS total
            FROM {p}_ranked""",
        f"{p}_cut": f"SELECT *, spot * {n_shards} // total AS cut FROM {p}_placed",
        p: f"""
            SELECT *, CAST(cut AS INTEGER) AS shard,
                   spot - (cut * total + {n_shards - 1}) // {n_shards} AS slot
            FROM {p}_cut""",
    }


def checksums(docs: str, p: str) -> Steps:
    """CRC-32 of the texts, byte by byte over a table of 256 remainders made by its rule."""
    rule = "CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return {
        f"{p}_table": f"""
            SELECT list(c ORDER BY n) AS t FROM (
                SELECT n, list_reduce([CAST(n AS BIGINT)] || list_transform(range(8), lambda x: 0::BIGINT),
                                      lambda c, x: {rule}) AS c
                FROM (SELECT unnest(range(256)) AS n))""",
        p: f"""
            SELECT * EXCLUDE (b, t), xor(list_reduce([4294967295::BIGINT] || list_transform(
                       range(1, octet_length(b) + 1), lambda i: CAST('0x' || hex(b[i:i]) AS BIGINT)),
                   lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS BIGINT) + 1])), 4294967295)
                       AS text_crc32
            FROM (SELECT *, encode(coalesce(text, '')) AS b FROM {docs}), {p}_table""",
    }


def lines(docs: str, p: str) -> Steps:
    key = _lower(f"trim(line, {WHITE})")
    return {
        f"{p}_lines": f"""
            SELECT doc_id, i, l[i] AS line
            FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i
                  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM {docs}))""",
        f"{p}_keys": f"SELECT *, {key} AS k FROM {p}_lines",
        f"{p}_gone": f"""
            SELECT k FROM {p}_keys WHERE length(k) >= 1
            GROUP BY k HAVING count(DISTINCT doc_id) >= 10""",
        p: f"""
            SELECT doc_id, count(*) AS n_lines, count(g.k) AS n_dropped,
                   sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (g.k IS NULL), ''))
                       AS kept_sha256
            FROM {p}_keys LEFT JOIN {p}_gone g USING (k) GROUP BY doc_id""",
    }


def licensed(docs: str, p: str) -> Steps:
    def canonical(text: str) -> str:
        plain = f"regexp_replace({_lower(text)}, '{COPYRIGHT_LINE}', '', 'g')"
        found = f"trim(regexp_replace({plain}, '{PUNCTUATION}', ' ', 'g'))"
        found = f"' ' || replace({found}, ' ', '  ') || ' '"
        for variant, usual in SPELLINGS:
            found = f"regexp_replace({found}, '{variant}', '{usual.replace('$', chr(92))}', 'g')"
        return f"trim(regexp_replace({found}, ' +', ' ', 'g'))"

    every = KNOWN + full_texts()
    known = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in every)
    blank = r"\n(?:[ \t\r]*\n)+"
    return {
        f"{p}_known": f"""
            SELECT DISTINCT id, {canonical("body")} AS canon FROM (VALUES {known}) v(id, body)""",
        f"{p}_units": f"""
            SELECT doc_id, 0 AS unit, [coalesce(text, '')] AS l FROM {docs}
            UNION ALL SELECT doc_id, 1, regexp_split_to_array(coalesce(text, ''), '{blank}') FROM {docs}
            UNION ALL SELECT doc_id, 2, string_split(coalesce(text, ''), chr(10)) FROM {docs}""",
        f"{p}_pieces": f"""
            SELECT doc_id, unit, i, {canonical("l[i]")} AS canon
            FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM {p}_units WHERE unit = 0 OR len(l) > 1)""",
        f"{p}_hits": f"""
            SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_matches, array_to_string(list_sort(list(id)), ',') AS licenses
            FROM (SELECT doc_id, id, max(n) AS n FROM (
                      SELECT doc_id, unit, id, count(*) AS n FROM {p}_pieces JOIN {p}_known USING (canon)
                      WHERE canon <> '' GROUP BY ALL) GROUP BY doc_id, id)
            GROUP BY doc_id""",
        p: f"""
            SELECT doc_id, coalesce(n_matches, 0) AS n_matches, coalesce(licenses, '') AS licenses
            FROM {docs} LEFT JOIN {p}_hits USING (doc_id)""",
    }


def mail(messages: str, p: str) -> Steps:
    wrapped = r"""regexp_replace(coalesce(text, ''), '(\S+ \S+) (\S+) ', '\1' || chr(10) || '\2 ', 'g')"""

    def quoted(column: str, marks: str) -> str:
        return f"'{marks}' || replace({column}, chr(10), chr(10) || '{marks}')"

    def above(turn: str) -> str:
        return f"CASE WHEN {turn} > 0 THEN {turn} - 1 - (conv_id % 2) * CAST({turn} > 1 AS BIGINT) END"

    return {
        f"{p}_said": f"""
            SELECT conv_id, turn, min({wrapped}) AS said FROM {messages}
            WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn""",
        f"{p}_up1": f"""
            SELECT m.*, {above("m.turn").replace("conv_id", "m.conv_id")} AS p1 FROM {messages} m""",
        f"{p}_up2": f"""
            SELECT m.*, s.said AS s1, {above("p1").replace("conv_id", "m.conv_id")} AS p2
            FROM {p}_up1 m LEFT JOIN {p}_said s ON s.conv_id = m.conv_id AND s.turn = p1""",
        f"{p}_up3": f"""
            SELECT m.*, s.said AS s2, {above("p2").replace("conv_id", "m.conv_id")} AS p3
            FROM {p}_up2 m LEFT JOIN {p}_said s ON s.conv_id = m.conv_id AND s.turn = p2""",
        p: f"""
            SELECT m.conv_id, m.turn, role, concat_ws(chr(10), {quoted("s.said", "> > > ")},
                   {quoted("s2", ">> ")}, CASE WHEN m.turn % 4 <> 0 THEN {quoted("s1", "> ")} END,
                   coalesce(text, '')) AS text
            FROM {p}_up3 m LEFT JOIN {p}_said s ON s.conv_id = m.conv_id AND s.turn = p3""",
    }


def linked(messages: str, p: str) -> Steps:
    depth = f"length(regexp_replace(regexp_extract(line, '{MARKS}'), '[^>]', '', 'g'))"
    return {
        f"{p}_lines": f"""
            SELECT conv_id, turn, i, line, {depth} AS depth, trim(regexp_replace(line, '{MARKS}', '')) AS bare
            FROM (SELECT conv_id, turn, l[i] AS line, i FROM (
                  SELECT conv_id, turn, l, unnest(range(1, len(l) + 1)) AS i FROM (
                  SELECT *, string_split(coalesce(text, ''), chr(10)) AS l FROM {messages})))""",
        f"{p}_starts": f"""
            SELECT *, CASE WHEN depth = lag(depth) OVER w AND bare <> '' AND lag(bare) OVER w <> ''
                           THEN 0 ELSE 1 END AS new
            FROM {p}_lines WINDOW w AS (PARTITION BY conv_id, turn ORDER BY i)""",
        f"{p}_runs": f"""
            SELECT conv_id, turn, depth, run, string_agg(bare, ' ' ORDER BY i) AS body
            FROM (SELECT *, sum(new) OVER (PARTITION BY conv_id, turn ORDER BY i) AS run FROM {p}_starts)
            GROUP BY ALL""",
        f"{p}_passages": f"""
            SELECT DISTINCT conv_id, turn, depth, x FROM (
                SELECT conv_id, turn, depth, trim(regexp_replace({_lower("s")}, '{MARKS_BETWEEN}', ' ', 'g')) AS x
                FROM (SELECT conv_id, turn, depth,
                             unnest(regexp_split_to_array(body, '{SENTENCE}')) AS s FROM {p}_runs
                      UNION ALL SELECT conv_id, turn, depth, bare FROM {p}_lines))
            WHERE x <> ''""",
        f"{p}_links": f"""
            SELECT q.conv_id, q.turn, q.depth, q.x, max(o.turn) AS source
            FROM {p}_passages q JOIN {p}_passages o
              ON o.conv_id = q.conv_id AND o.x = q.x AND o.depth = q.depth - 1 AND o.turn < q.turn
            GROUP BY ALL""",
        f"{p}_votes": f"""
            SELECT conv_id, turn, depth, source, count(*) AS votes FROM {p}_links GROUP BY ALL""",
        f"{p}_replies": f"""
            SELECT conv_id, turn, max_by(source, {{'d': -depth, 'v': votes, 's': source}}) AS reply_to
            FROM {p}_votes GROUP BY conv_id, turn""",
        f"RECURSIVE {p}_up": f"""
            SELECT conv_id, turn, reply_to AS top, 1 AS far FROM {p}_replies
            UNION
            SELECT u.conv_id, u.turn, r.reply_to, far + 1
            FROM {p}_up u JOIN {p}_replies r ON r.conv_id = u.conv_id AND r.turn = u.top""",
        f"{p}_own": f"""
            SELECT conv_id, turn, count(*) FILTER (depth > 0) AS n_quoted, max(depth) AS deepest,
                   coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (depth = 0), '') AS body
            FROM {p}_lines GROUP BY conv_id, turn""",
        p: f"""
            SELECT m.conv_id, m.turn, role, reply_to, coalesce(t.thread, m.turn) AS thread,
                   CAST(coalesce(t.far, 0) AS BIGINT) AS depth, n_quoted,
                   CAST(deepest AS BIGINT) AS deepest, sha256(body) AS body_sha256
            FROM {messages} m JOIN {p}_own USING (conv_id, turn)
            LEFT JOIN {p}_replies USING (conv_id, turn)
            LEFT JOIN (SELECT conv_id, turn, min(top) AS thread, max(far) AS far FROM {p}_up GROUP BY 1, 2) t
              USING (conv_id, turn)""",
    }


def trie(messages: str, p: str) -> Steps:
    role, text = "coalesce(role, '')", "coalesce(text, '')"
    return {
        f"{p}_turns": f"""
            SELECT conv_id, turn, CAST(len({_words("text")}) AS BIGINT) AS words,
                   md5(CAST(length({role}) AS VARCHAR) || ':' || {role} || {text}) AS tid
            FROM {messages} WHERE conv_id IS NOT NULL""",
        f"{p}_ordered": f"""
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tid) - 1 AS pos
            FROM {p}_turns""",
        f"{p}_ids": f"SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS text FROM {p}_turns",
        **checksums(f"{p}_ids", f"{p}_summed"),
        f"{p}_convs": f"""
            SELECT conv_id AS c, conv_id - conv_id % 20 AS base, text_crc32 % 4 AS h FROM {p}_summed""",
        f"{p}_had": f"""
            SELECT c, h, least(h, (SELECT count(*) FROM {p}_ordered o WHERE o.conv_id = base)) AS got
            FROM {p}_convs""",
        f"{p}_rebuilt": f"""
            SELECT c, pos, tid, words FROM {p}_convs JOIN {p}_ordered ON conv_id = base AND pos < h
            UNION ALL
            SELECT c, pos - h + got, tid, words FROM {p}_had JOIN {p}_ordered ON conv_id = c AND pos >= h""",
        f"{p}_paths": f"""
            SELECT c, pos + 1 AS d, words, md5(string_agg(tid, '') OVER (PARTITION BY c ORDER BY pos)) AS k
            FROM {p}_rebuilt
            UNION ALL
            SELECT c, 0, 0, '' FROM {p}_convs""",
        f"{p}_nodes": f"""
            SELECT d, k, min(c) AS least, count(*) AS n, min(words) AS words
            FROM {p}_paths GROUP BY d, k""",
        f"{p}_parents": f"""
            SELECT n.*, u.k AS up FROM {p}_nodes n
            LEFT JOIN {p}_paths u ON u.c = n.least AND u.d = n.d - 1""",
        f"{p}_children": f"""
            SELECT d - 1 AS d, up AS k, count(*) AS children FROM {p}_parents WHERE d > 0 GROUP BY ALL""",
        f"{p}_sums": f"""
            SELECT a.d, a.k, sum((n.n - 1) * n.words) AS saved,
                   count(*) FILTER (coalesce(children, 0) = 0) AS leaves
            FROM {p}_nodes n LEFT JOIN {p}_children USING (d, k)
            JOIN {p}_paths a ON a.c = n.least AND a.d <= n.d
            GROUP BY a.d, a.k""",
        f"{p}_ends": f"""
            SELECT d, k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS sha
            FROM (SELECT c, max(d) AS d, max_by(k, d) AS k FROM {p}_paths GROUP BY c) GROUP BY d, k""",
        p: f"""
            SELECT n.least AS conv_id, n.d AS depth, u.least AS parent_conv_id, n.n AS n_convs,
                   coalesce(children, 0) AS n_children, leaves AS n_leaves,
                   CAST(saved AS BIGINT) AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256
            FROM {p}_parents n JOIN {p}_sums USING (d, k) LEFT JOIN {p}_children USING (d, k)
            LEFT JOIN {p}_ends USING (d, k)
            LEFT JOIN {p}_nodes u ON u.d = n.d - 1 AND u.k = n.up""",
    }


def filled(docs: str, p: str) -> Steps:
    token = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"

    def draw(group: int) -> str:
        return f"CAST('0x' || substr(h, {8 * group + 1}, 8) AS BIGINT)"

    def joined(first: str, last: str) -> str:
        return f"array_to_string(t[{first}:{last}], '')"

    return {
        f"{p}_tokens": f"""
            SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{token}') AS t,
                   sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
            FROM {docs}""",
        f"{p}_cuts": f"""
            SELECT *, {draw(0)} % (len(t) + 1) AS x, {draw(1)} % (len(t) + 1) AS y,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                             OR contains(text, '<M>') OR {draw(2)} % 100 >= 50 THEN 'plain'
                        WHEN {draw(3)} % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
            FROM {p}_tokens""",
        f"{p}_parts": f"""
            SELECT *, {joined("1", "least(x, y)")} AS prefix,
                   {joined("least(x, y) + 1", "greatest(x, y)")} AS middle,
                   {joined("greatest(x, y) + 1", "len(t)")} AS suffix
            FROM {p}_cuts""",
        p: f"""
            SELECT doc_id, CAST(len(t) AS BIGINT) AS n, form,
                   CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
                   CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
                   sha256(CASE form WHEN 'plain' THEN text
                          WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                          ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
                   sha256(text) AS restored_sha256
            FROM {p}_parts""",
    }


def statement(steps: Steps, select: str) -> str:
    recursive = any(name.startswith("RECURSIVE ") for name in steps)
    body = ",\n".join(
        f"{name.removeprefix('RECURSIVE ')} AS {'' if 'RECURSIVE' in name else 'MATERIALIZED '}({sql})"
        for name, sql in steps.items()
    )
    return f"WITH {'RECURSIVE ' if recursive else ''}{body}\n{select}"


def pipeline(n_shards: int) -> str:
    columns = "doc_id, text, lang, source, n_chars"
    steps = {
        **quality("documents", "good"),
        "s1": f"SELECT {columns} FROM good WHERE kept",
        **similar("s1", "alike"),
        "s2": f"SELECT {columns} FROM alike WHERE n_shingles = 0 OR component_id = doc_id",
        **contamination("s2", "leaks"),
        "s3": f"SELECT {columns} FROM leaks WHERE NOT contaminated",
        **mixed("s3", "mix"),
        "s4": f"""
            SELECT {columns} FROM (SELECT *, unnest(range(copies)) AS turn FROM mix)""",
        **sharded("s4", "cuts", n_shards),
    }
    return statement(steps, f"SELECT {columns}, shard, slot FROM cuts")


ORACLE: dict[str, str] = {
    "op1_sharding": statement(
        {**checksums("documents", "summed"), **sharded("summed", "cuts", 40)},
        "SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 16 AS BIGINT) AS size,"
        " text_crc32, 'rows' AS law, shard, slot, CAST(NULL AS INTEGER) AS grown_shard, source"
        " FROM cuts",
    ),
    "op2_license_scan": statement(licensed("documents", "found"), "SELECT * FROM found"),
    "op8_quotes": statement(
        {**mail("conversations", "mail"), **linked("mail", "found")}, "SELECT * FROM found"
    ),
    "op5_ngram_jaccard_join": statement(
        similar("documents", "alike"), "SELECT doc_id, n_shingles, component_id FROM alike"
    ),
    "op6_decontamination": statement(
        contamination("documents", "leaks"),
        "SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated FROM leaks",
    ),
    "op7_mixing": statement(
        mixed("documents", "mix"),
        "SELECT doc_id, size, source_size, target, size * copies AS taken, source FROM mix",
    ),
    "op9_quality_rules": statement(
        quality("documents", "good"),
        "SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,"
        " kept, n_lines, n_stop_words FROM good",
    ),
    "op10_line_dedup": statement(lines("documents", "found"), "SELECT * FROM found"),
    "op12_prefix_trie": statement(trie("conversations", "nodes"), "SELECT * FROM nodes"),
    "op13_fill_in_middle": statement(filled("documents", "cut"), "SELECT * FROM cut"),
    "pipeline": pipeline(40),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
