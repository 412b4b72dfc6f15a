"""The queries of this folder as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from postwright.llm import (
    collocations, decontaminate, licenses, line_rules, mixing, spelling, substrings, warc,
)

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _lower(column: str) -> str:
    return f"translate({column}, '{licenses.UPPER}', '{licenses.LOWER}')"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def license_scan() -> str:
    values = ", ".join(f"({_text(n)}, {_text(t)})" for n, t in licenses.TEMPLATES)

    def words(column: str) -> str:
        return f"regexp_extract_all({_lower(column)}, '{licenses.WORD}')"

    pairs = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
WITH templates(license_id, t) AS (VALUES {values}),
wanted AS (
  SELECT license_id, {pairs} AS b
  FROM (SELECT license_id, {words('t')} AS w FROM templates) WHERE len(w) > 1
),
paragraphs AS (
  SELECT doc_id, text, regexp_split_to_array(text, '{licenses.BREAK}') AS p
  FROM documents WHERE text IS NOT NULL
),
units AS (
  SELECT doc_id, 'line' AS unit, i AS unit_no, l[i + 1] AS body
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM paragraphs), unnest(range(len(l))) r(i)
  UNION ALL
  SELECT doc_id, 'paragraph', i, p[i + 1] FROM paragraphs, unnest(range(len(p))) r(i)
  WHERE contains(trim(p[i + 1]), chr(10))
  UNION ALL
  SELECT doc_id, 'text', 0, text FROM paragraphs WHERE len(p) > 1
),
sized AS (
  SELECT doc_id, unit, unit_no, {pairs} AS b
  FROM (SELECT doc_id, unit, unit_no, {words('body')} AS w FROM units) WHERE len(w) > 1
),
scored AS (
  SELECT doc_id, unit, unit_no, license_id, len(s.b) AS n_bigrams,
    2.0::DOUBLE * len(list_intersect(s.b, t.b)) / (len(s.b) + len(t.b)) AS dice
  FROM sized s JOIN wanted t
    ON len(s.b) <= len(t.b) * {(2 - licenses.THRESHOLD) / licenses.THRESHOLD} + 1
    AND len(t.b) <= len(s.b) * {(2 - licenses.THRESHOLD) / licenses.THRESHOLD} + 1
)
SELECT doc_id, unit, unit_no::INTEGER AS unit_no, license_id, n_bigrams, dice FROM scored
WHERE dice >= {licenses.THRESHOLD}
QUALIFY row_number() OVER (
  PARTITION BY doc_id, unit, unit_no ORDER BY dice DESC, license_id) = 1
"""


def decontamination() -> str:
    words = rf"regexp_extract_all({_lower('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    n = decontaminate.WINDOW
    return f"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark WHERE item_id IS NOT NULL
),
patterns AS (
  SELECT DISTINCT item, least({n}, len(w)) AS n,
    array_to_string(w[k : k + least({n}, len(w)) - 1], ' ') AS p
  FROM items, unnest(range(1, greatest(len(w) - {n}, 0) + 2)) r(k) WHERE len(w) > 0
),
docs AS (SELECT doc_id, coalesce({words}, []) AS w FROM documents),
places AS (
  SELECT doc_id, k, n, array_to_string(w[k : k + n - 1], ' ') AS p
  FROM docs, (SELECT DISTINCT n FROM patterns) s, unnest(range(1, len(w) - n + 2)) r(k)
),
hits AS (SELECT doc_id, k, n, item FROM places JOIN patterns USING (n, p)),
covered AS (
  SELECT doc_id, count(DISTINCT i) AS n_hit FROM hits, unnest(range(k, k + n)) r(i) GROUP BY doc_id
),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""


def revisits() -> str:
    return f"""
WITH records AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest FROM pages
),
placed AS (
  SELECT *, payload_bytes >= {warc.MIN_BYTES} AND page_id <> min(page_id)
    OVER (PARTITION BY payload_digest) AS again,
    min(page_id) OVER (PARTITION BY payload_digest) AS first FROM records
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first END AS refers_to
FROM placed
"""


def line_quality() -> str:
    r = line_rules
    normal = (
        rf"trim(regexp_replace(regexp_replace({_lower('body')}, "
        r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[0-9]+', '0', 'g'))"
    )
    w = r.WINDOW
    return rf"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    {_WORDS.format("coalesce(text, '')")} AS w FROM documents
),
lines AS (
  SELECT doc_id, coalesce(source, chr(1)) AS host, i, l[i] AS body
  FROM (SELECT doc_id, source, string_split(text, chr(10)) AS l FROM docs),
    unnest(range(1, len(l) + 1)) r(i)
),
repeated_lines AS (
  SELECT doc_id, count(*) - count(DISTINCT body) AS n_dup_lines
  FROM lines WHERE regexp_matches(body, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
places AS (
  SELECT doc_id, k, array_to_string(w[k : k + {w - 1}], ' ') AS p
  FROM docs, unnest(range(1, len(w) - {w - 2})) r(k)
),
twice AS (
  SELECT doc_id, k FROM places QUALIFY count(*) OVER (PARTITION BY doc_id, p) > 1
),
repeated_words AS (
  SELECT doc_id, count(DISTINCT i) AS n_repeat_words
  FROM twice, unnest(range(k, k + {w})) r(i) GROUP BY doc_id
),
normal AS (
  SELECT doc_id, host, i, line, words FROM (
    SELECT doc_id, host, i, {normal} AS line, len({_WORDS.format('body')}) AS words FROM lines
  ) WHERE line <> ''
),
copies AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS same FROM normal GROUP BY doc_id
),
frequent AS (
  SELECT host, line FROM normal JOIN copies USING (doc_id) GROUP BY host, line
  HAVING count(DISTINCT same) >= {r.MIN_DOCUMENTS}
),
removed AS (
  SELECT doc_id, sum(words)::BIGINT AS gone FROM normal JOIN frequent USING (host, line)
  GROUP BY doc_id
),
measured AS (
  SELECT doc_id, len(w) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    len(regexp_extract_all(text, '[{r.SYMBOLS}]')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(gone, 0) AS n_frequent_words
  FROM docs LEFT JOIN repeated_lines USING (doc_id) LEFT JOIN repeated_words USING (doc_id)
    LEFT JOIN removed USING (doc_id)
),
ruled AS (
  SELECT *, n_words < {r.MIN_WORDS} OR 100 * n_repeat_words > {r.MAX_REPEATED} * n_words
    AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words - n_frequent_words >= {r.MIN_LEFT} * n_words AS kept,
  n_frequent_words FROM ruled
"""


def source_mixing() -> str:
    m = mixing
    power = "list_sum(list_transform(s, lambda x: pow(x, {a})))"
    entropy = (
        f"ln({power}) - ({{a}}) * list_sum(list_transform(s, lambda x: pow(x, {{a}}) * ln(x))) / {power}"
    )
    repeats = f"pow(least_share, ({{a}}) - 1) / {power} > {m.MAX_EPOCHS}"
    enough = f"{entropy} >= {m.TARGET_ENTROPY} * ln(n)"
    mid = "(low + high) / 2"
    bisect = "SELECT 0 AS k, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high UNION ALL SELECT k + 1, "
    step = "CASE WHEN {c} THEN {m} ELSE low END, CASE WHEN {c} THEN high ELSE {m} END"
    return f"""
WITH RECURSIVE counted AS (
  SELECT doc_id, source, coalesce(len({_WORDS.format('text')}), 0) AS tokens FROM documents
),
totals AS (SELECT source, sum(tokens)::BIGINT AS n_tokens FROM counted GROUP BY source),
whole AS (SELECT sum(n_tokens)::BIGINT AS budget FROM totals),
shares AS (
  SELECT source, n_tokens, n_tokens::DOUBLE / budget AS share FROM totals, whole WHERE n_tokens > 0
),
facts AS (SELECT list(share) AS s, count(*) AS n, min(share) AS least_share FROM shares),
by_entropy AS (
  {bisect}{step.format(c=enough.format(a=mid), m=mid)} FROM by_entropy, facts WHERE k < 50
),
by_epochs AS (
  {bisect}{step.format(c=repeats.format(a=mid), m=mid)} FROM by_epochs, facts WHERE k < 50
),
chosen AS (
  SELECT CASE WHEN n = 1 THEN 1.0::DOUBLE ELSE round(greatest(
    CASE WHEN {enough.format(a='1.0')} THEN 1.0 ELSE (SELECT low FROM by_entropy WHERE k = 50) END,
    CASE WHEN {repeats.format(a='1.0')} THEN 1.0
      WHEN NOT ({repeats.format(a='0.0')}) THEN 0.0
      ELSE (SELECT high FROM by_epochs WHERE k = 50) END), {m.DECIMALS}) END AS a
  FROM facts
),
scale AS (SELECT sum(pow(share, a)) AS z FROM shares, chosen),
quotas AS (
  SELECT source, n_tokens, pow(share, a) / z AS weight,
    floor(pow(share, a) / z * budget * (1 + 1e-12::DOUBLE))::BIGINT AS quota
  FROM shares, chosen, scale, whole
),
passes AS (SELECT *, quota // n_tokens AS passes, quota % n_tokens AS rest
  FROM quotas WHERE quota > 0),
placed AS (
  SELECT doc_id, source, tokens, epoch, passes, rest, weight, quota, n_tokens,
    md5('0:' || epoch || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS place
  FROM counted JOIN passes USING (source), unnest(range(passes + 1)) r(epoch)
),
reached AS (
  SELECT source, place, sum(sum(tokens)) OVER (PARTITION BY source ORDER BY place) AS reached
  FROM placed WHERE epoch = passes GROUP BY source, place
),
taken AS (
  SELECT placed.* FROM placed LEFT JOIN reached USING (source, place)
  WHERE epoch < passes OR reached <= rest
)
SELECT doc_id, source, tokens AS mix_tokens, round(weight, 9) AS mix_weight, epoch AS mix_epoch,
  floor((epoch + ('0x' || substr(place, 1, 13))::BIGINT::DOUBLE / {float(16**13)})
    * n_tokens / quota * 1e6)::BIGINT AS mix_order
FROM taken
"""


def _crc32(value: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, four bits at a time."""
    table = []
    for c in range(16):
        for _ in range(4):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    values = "[" + ", ".join(f"{c}::BIGINT" for c in table) + "]"
    step = f"xor(c >> 4, {values}[(xor(c, b) & 15) + 1])"
    nibbles = (
        f"list_transform(range(0, 2 * strlen({value})), lambda i: "
        f"('0x' || substr(hex(encode({value})), (i + 2 * ((i + 1) % 2))::BIGINT, 1))::BIGINT)"
    )
    return f"xor(list_reduce({nibbles}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


def spelling_variants() -> str:
    s = spelling
    return rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id,
      unnest(regexp_extract_all({_lower("coalesce(text, '')")}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents)
  WHERE length(run) >= {s.MIN_LENGTH} GROUP BY doc_id, run
),
checked AS (
  SELECT run, n, {_crc32('marked')} AS h
  FROM (SELECT *, doc_id || ':' || run AS marked FROM runs)
),
edited AS (
  SELECT n, CASE WHEN h % {s.EVERY} = 0
    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM checked
),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM edited WHERE length(word) >= {s.MIN_LENGTH}
  GROUP BY word HAVING sum(n) >= {s.MIN_COUNT}
),
holes AS (
  SELECT word, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS hole,
    substr(word, 1, i - 1) || substr(word, i + 1) AS shorter
  FROM words, unnest(range(1, length(word) + 1)) r(i)
),
pairs AS (
  SELECT a.word, b.word AS near FROM holes a JOIN holes b USING (hole) WHERE a.word <> b.word
  UNION SELECT h.word, w.word FROM holes h JOIN words w ON w.word = h.shorter
  UNION SELECT w.word, h.word FROM holes h JOIN words w ON w.word = h.shorter
),
best AS (
  SELECT p.word, near, w.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near
  FROM pairs p JOIN words w ON w.word = near
  QUALIFY row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, near) = 1
),
placed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN near_n >= {s.RATIO} * w.n THEN near END AS form,
    CASE WHEN near_n >= {s.RATIO} * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
),
steps AS (
  SELECT word, word AS at, form AS onward FROM placed
  UNION ALL
  SELECT s.word, p.word, p.form FROM steps s JOIN placed p ON p.word = s.onward
)
SELECT p.word, form, s.at AS root, n, n_near, form_n
FROM placed p JOIN steps s ON s.word = p.word AND s.onward IS NULL
"""


def collocation_mining() -> str:
    c = collocations
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, '{c.UNKNOWN}') AS lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT lang,
    unnest(regexp_split_to_array({_lower("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents)
),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
phrases AS (
  SELECT lang, array_to_string(w[k : k + s - 1], ' ') AS phrase, s, count(*) AS f
  FROM pieces, (SELECT unnest(range(1, {c.LONGEST + 1})) AS s), unnest(range(1, len(w) - s + 2)) r(k)
  GROUP BY ALL HAVING count(*) >= {c.LEAST}
),
cut AS (
  SELECT lang, phrase, f AS a, k, string_split(phrase, ' ') AS w
  FROM phrases, unnest(range(1, s)) r(k) WHERE s > 1
),
parts AS (
  SELECT cut.lang, cut.phrase, a, k, x.f AS l, y.f AS r,
    ({2 * c.UNIT}::HUGEINT * a) // (x.f::HUGEINT + y.f) AS score
  FROM cut JOIN phrases x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1 : k], ' ')
    JOIN phrases y ON y.lang = cut.lang AND y.phrase = array_to_string(w[k + 1 : len(w)], ' ')
),
weakest AS (
  SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
around AS (
  SELECT lang, array_to_string(w[k : k + n - 1], ' ') AS phrase, max(f) AS around
  FROM (SELECT lang, f, string_split(phrase, ' ') AS w FROM phrases WHERE s > 2) q,
    unnest(range(2, len(w))) t(n), unnest(range(1, len(w) - n + 2)) r(k)
  GROUP BY ALL
)
SELECT lang, row_number() OVER o AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM weakest LEFT JOIN around USING (lang, phrase) JOIN totals USING (lang)
WHERE around IS NULL OR 100::HUGEINT * around < {c.INSIDE}::HUGEINT * a
WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY row_number() OVER o <= {c.TOP}
"""


def substring_removal() -> str:
    n = substrings.WINDOW
    return rf"""
WITH docs AS (
  SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents
),
places AS (
  SELECT doc_id, k, md5(array_to_string(w[k : k + {n - 1}], ' ')) AS p
  FROM docs, unnest(range(1, len(w) - {n - 2})) r(k)
),
later AS (
  SELECT doc_id, k FROM places QUALIFY doc_id > min(doc_id) OVER (PARTITION BY p)
),
gone AS (
  SELECT doc_id, list(DISTINCT i) AS removed FROM later, unnest(range(k, k + {n})) r(i)
  GROUP BY doc_id
),
kept AS (
  SELECT doc_id, string_agg(w[i], ' ' ORDER BY i) AS rest
  FROM docs, unnest(range(1, len(w) + 1)) r(i)
  WHERE NOT EXISTS (FROM (SELECT doc_id AS d, unnest(removed) AS x FROM gone) WHERE d = doc_id AND x = i)
  GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(len(removed), 0) AS n_removed,
  sha256(coalesce(rest, '')) AS kept_sha256
FROM docs LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


LLM_ORACLES: dict[str, str] = {
    "op1_license_scan": license_scan(),
    "op5_decontaminate": decontamination(),
    "op6_warc_revisits": revisits(),
    "op8_line_rules": line_quality(),
    "op10_mixing": source_mixing(),
    "op11_spelling_variants": spelling_variants(),
    "op12_collocations": collocation_mining(),
    "op13_substring_dedup": substring_removal(),
}
