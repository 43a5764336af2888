"""The operators as registered queries over the tables of a folder, with SQL where it can say the same."""

import re

import public_tokenizers
from pyspark.sql import functions as F

from rinkflow.llm import byte_bpe, decontamination, filter_audit, katz, languages, licenses, line_dedup, near_copies
from rinkflow.llm import neighbours, phrases, quality, token_files, url_filters
from rinkflow.session import materialize, scratch_folder

QUERIES = {}
SQL = {}


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(function):
    QUERIES[function.__name__] = function
    return function


def bucket(n):
    """crc32 of the document id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


@query
def op1_neighbours(spark, folder):
    """The 20 nearest of every twentieth vector."""
    return neighbours.nearest(table(spark, folder, "embeddings"))


@query
def op2_byte_bpe(spark, folder):
    """Every document encoded and decoded, as digests."""
    model = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = byte_bpe.encode_documents(table(spark, folder, "documents"), *model)
    return byte_bpe.decode_documents(encoded, *model).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op3_katz(spark, folder):
    """Every document's probability by the bigrams of those that are not held out."""
    docs = table(spark, folder, "documents").withColumn("held_out", bucket(5) == 1)
    return katz.score_documents(docs)


@query
def op4_near_copies(spark, folder):
    """Every document's near-copy group: three-word shingles, 85 percent."""
    return near_copies.near_copies(table(spark, folder, "documents"), shingle=3, percent=85)


@query
def op5_token_files(spark, folder):
    """Every document written as token ids and read back from the files."""
    files = scratch_folder(spark)
    model = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_files(table(spark, folder, "documents"), files, model, end_id=1)
    read = token_files.read_token_files(spark, files)
    read = materialize(read.select("shard", "number", "doc_id", "place", "n_tokens", F.crc32("ids").alias("ids_crc32")))
    return token_files.with_starts(read).select("doc_id", "start", "n_tokens", "ids_crc32")


#: Templates of the query: name, notice.
LICENSE_TEMPLATES = [
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
]


@query
def op6_licenses(spark, folder):
    """Every document's license notices."""
    templates = spark.createDataFrame(LICENSE_TEMPLATES, "license_id string, text string")
    return licenses.scan_licenses(table(spark, folder, "documents"), templates)


def _license_sql():
    rows = []
    for name, text in LICENSE_TEMPLATES:
        n = len(re.findall(r"[a-z0-9]+", text.lower()))
        shingle = min(licenses.SHINGLE, n)
        stride, blocks = licenses._plan(licenses.window_size(n), shingle)
        rows.append((name, text, shingle, stride, blocks))
    words = r"""regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-/:-@\[-`{{-\x7f]+')"""
    return f"""
WITH templates AS (
  SELECT *, {words.format("text")} AS w FROM (VALUES {", ".join(map(str, rows))}) t(license_id, text, k, stride, blocks)
),
wanted AS (
  SELECT DISTINCT license_id, k, stride, blocks, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM templates, unnest(range(1, len(w) - k + 2)) u(i)
),
sizes AS (SELECT license_id, count(*) AS n FROM wanted GROUP BY ALL),
docs AS (SELECT doc_id, {words.format("text")} AS w FROM documents),
hits AS (
  SELECT d.doc_id, t.license_id, t.stride, t.blocks, t.s, d.i - 1 AS place
  FROM (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
        FROM docs, (SELECT DISTINCT k FROM wanted), unnest(range(1, len(w) - k + 2)) u(i)) d
  JOIN wanted t ON d.k = t.k AND d.s = t.s
),
windows AS (
  SELECT doc_id, license_id, b * stride AS word, count(DISTINCT s) AS held
  FROM hits, unnest(range(greatest(0, place // stride - blocks + 1), place // stride + 1)) u(b)
  GROUP BY ALL
)
SELECT doc_id, license_id, arg_max(held, (held, -word)) / any_value(n) AS containment,
  arg_max(word, (held, -word)) AS word
FROM windows JOIN sizes USING (license_id)
WHERE 100 * held >= 80 * n GROUP BY doc_id, license_id
"""


SQL["op6_licenses"] = _license_sql()


@query
def op7_quality(spark, folder):
    """Every document's quality, learned from the labelled rows that are not held out."""
    docs = table(spark, folder, "documents").withColumn("held_out", bucket(3) == 1)
    measured = materialize(quality.measure(docs, ("doc_id", "held_out")))
    model = quality.fit(measured.where("not held_out"), table(spark, folder, "labels"))
    return quality.score(measured, model)


@query
def op8_language_id(spark, folder):
    """Every document's language, learned from the rows that are not held out."""
    docs = table(spark, folder, "documents").withColumn("held_out", bucket(4) == 2)
    model = languages.fit(docs.where("not held_out"))
    return languages.identify(docs, model, ("doc_id", "held_out"))


@query
def op9_decontamination(spark, folder):
    """The benchmark items that documents hold."""
    found = decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "word")


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER.format('text')}, '[^\\x20\\x09-\\x0D]+')"

SQL["op9_decontamination"] = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
spots AS (
  SELECT doc_id, len(w) AS n, i - 1 AS place, array_to_string(w[i:i + 4], ' ') AS s
  FROM docs, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) u(i)
),
parts AS (
  SELECT item_id, len(w) AS n, i - 1 AS place, array_to_string(w[i:i + 4], ' ') AS s
  FROM items, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) u(i)
),
windows AS (
  SELECT DISTINCT doc_id, greatest(0, least(d.place - p.place, d.n - p.n)) AS word, p.n AS size
  FROM spots d JOIN parts p USING (s)
),
own AS (
  SELECT v.doc_id, v.word, v.size, d.s, count(*) AS k
  FROM windows v JOIN spots d ON d.doc_id = v.doc_id AND d.place >= v.word AND d.place < v.word + greatest(1, v.size - 4)
  GROUP BY ALL
),
theirs AS (SELECT item_id, s, count(*) AS k FROM parts GROUP BY ALL),
sizes AS (SELECT item_id, sum(k) AS n FROM theirs GROUP BY ALL),
own_sizes AS (SELECT doc_id, word, size, sum(k) AS n FROM own GROUP BY ALL),
shared AS (
  SELECT o.doc_id, o.word, o.size, t.item_id, sum(least(o.k, t.k)) AS k
  FROM own o JOIN theirs t USING (s) GROUP BY ALL
),
fit AS (
  SELECT h.doc_id, h.item_id, h.word, h.k / (o.n + i.n - h.k) AS similarity
  FROM shared h JOIN own_sizes o USING (doc_id, word, size) JOIN sizes i USING (item_id)
  WHERE 100 * h.k >= 80 * (o.n + i.n - h.k)
)
SELECT doc_id, item_id, max(similarity) AS similarity, arg_max(word, (similarity, -word))::BIGINT AS word
FROM fit GROUP BY doc_id, item_id
"""


#: The rules of the query: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query
def op10_url_filters(spark, folder):
    """Every page's URL judged by the rules."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.judge_urls(table(spark, folder, "pages"), rules)


SQL["op10_url_filters"] = f"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages
),
parts AS (
  SELECT page_id,
    translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
),
fits AS (
  SELECT p.page_id, p.host, p.path, r.rule_host || r.rule_path AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule_host || r.rule_path) DESC) AS place
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, 'allow') AS verdict
FROM fits WHERE place = 1
"""


@query
def op11_line_dedup(spark, folder):
    """Every document without lines that at least five documents hold, as digests."""
    docs = table(spark, folder, "documents")
    kept = line_dedup.apply_maps(docs, materialize(line_dedup.keep_maps(docs)))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL["op11_line_dedup"] = f"""
WITH lines AS (
  SELECT doc_id, unnest(s) AS line, unnest(range(1, len(s) + 1)) AS place
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)
),
keyed AS (
  SELECT *, {_LOWER.format("regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")} AS k FROM lines
),
common AS (
  SELECT k, max(doc_id) AS holder FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
),
judged AS (
  SELECT doc_id, place, line, coalesce(doc_id <> holder, false) AS gone FROM keyed LEFT JOIN common USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query
def op12_phrases(spark, folder):
    """Every language's first 2000 phrases of two and three words."""
    return phrases.collocations(table(spark, folder, "documents"))


SQL["op12_phrases"] = f"""
WITH RECURSIVE pieces AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents)
),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
counts AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS g, count(*) AS f
  FROM pieces, unnest(range(1, len(w) + 1)) u(i), unnest([1, 2, 3]) v(m)
  WHERE i + m - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 10
),
threes AS (
  SELECT lang, g, f, string_split(g, ' ') AS w, array_to_string(string_split(g, ' ')[1:2], ' ') AS head,
    array_to_string(string_split(g, ' ')[2:3], ' ') AS tail
  FROM counts WHERE m = 3
),
around AS (
  SELECT lang, g, max(f) AS most
  FROM (SELECT lang, head AS g, f FROM threes UNION ALL SELECT lang, tail, f FROM threes) GROUP BY ALL
),
parts AS (
  SELECT lang, g, f, k, array_to_string(string_split(g, ' ')[1:k], ' ') AS x,
    array_to_string(string_split(g, ' ')[k + 1:m], ' ') AS y
  FROM counts, unnest([1, 2]) u(k) WHERE k < m
),
cuts AS (
  SELECT p.lang, p.g, p.f AS a, k, x.f AS l, y.f AS r, 1000000::HUGEINT * p.f * p.f // (x.f::HUGEINT * y.f) AS score
  FROM parts p JOIN counts x ON x.lang = p.lang AND x.g = p.x JOIN counts y ON y.lang = p.lang AND y.g = p.y
),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS place FROM cuts),
ranked AS (
  SELECT b.lang, b.g AS phrase, a, l, r, score,
    row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.g) AS rank
  FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.g = b.g
  WHERE place = 1 AND coalesce(100 * most < 50 * a, true)
),
links AS (
  SELECT x.lang, x.g AS a, y.g AS b, y.w[3] AS word
  FROM threes x JOIN counts v ON v.lang = x.lang AND v.m = 2 AND v.g = x.tail AND v.f = x.f
  JOIN threes y ON y.lang = v.lang AND y.head = v.g AND y.f = v.f
),
walks AS (
  SELECT lang, g AS start, g AS at, g AS path FROM threes t ANTI JOIN links k ON k.lang = t.lang AND k.b = t.g
  UNION ALL
  SELECT s.lang, start, b, path || ' ' || word FROM walks s JOIN links k ON k.lang = s.lang AND k.a = s.at
),
whole AS (SELECT lang, start, arg_max(path, length(path)) AS path FROM walks GROUP BY ALL),
paths AS (SELECT lang, s.at AS phrase, p.path FROM walks s JOIN whole p USING (lang, start))
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score, coalesce(path, phrase) AS path
FROM ranked JOIN totals USING (lang) LEFT JOIN paths USING (lang, phrase) WHERE rank <= 2000
"""


@query
def op13_filter_audit(spark, folder):
    """What each order of five filters removes, by language."""
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


SQL["op13_filter_audit"] = """
WITH docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
measured AS (
  SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals,
    doc_id > min(doc_id) OVER (PARTITION BY t) AS repeated
  FROM docs
),
known AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
patterns AS (
  SELECT part, (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
      + 4 * (100 * capitals > 10 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * repeated::INT AS fails,
    count(*) AS n, count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS bad
  FROM measured LEFT JOIN known USING (doc_id) GROUP BY ALL
),
letters(l, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT v.l || w.l || x.l || y.l || z.l AS o, [v.b, w.b, x.b, y.b, z.b] AS bits
  FROM letters v, letters w, letters x, letters y, letters z WHERE v.b | w.b | x.b | y.b | z.b = 31
),
steps AS (
  SELECT o, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier
  FROM orders, unnest(range(1, 6)) u(step)
),
counted AS (
  SELECT part, o AS filter_order, step::INT AS step, bit,
    coalesce(sum(n) FILTER (WHERE fails & (earlier | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE fails & earlier = 0 AND fails & bit <> 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE fails & earlier <> 0 AND fails & bit <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE fails = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (WHERE fails & earlier = 0 AND fails & bit <> 0), 0)::BIGINT AS good_lost,
    coalesce(sum(bad) FILTER (WHERE fails & earlier = 0 AND fails & bit <> 0), 0)::BIGINT AS toxic_lost
  FROM patterns, steps GROUP BY ALL
)
SELECT * EXCLUDE (bit), (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM counted
"""
