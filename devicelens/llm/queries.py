"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare_session
from . import bpe as op10
from . import collocations as op12
from . import decontaminate as op4
from . import exact_dedup as op3
from . import hyperminhash as op1
from . import importance as op11
from . import line_dedup as op5
from . import pii as op6
from . import secret_scan as op13
from . import token_store as op2
from . import toxicity as op8
from . import url_filter as op7
from . import warc as op9
from .common import ship_code


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_session(spark)
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def q_minhash(spark, sf_dir):
    return op1.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80).select(
        "doc_id", "n_shingles", "component_id", "kept")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def q_token_store(spark, sf_dir):
    return op2.token_round_trip(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2)


def q_exact_dedup(spark, sf_dir):
    return op3.exact_dedup(table(spark, sf_dir, "documents"))


def q_decontaminate(spark, sf_dir):
    found = op4.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", op4.items_digest(found.items).alias("items_sha256"),
                        "contaminated")


def q_line_dedup(spark, sf_dir):
    return op5.line_digests(table(spark, sf_dir, "documents"))


def q_pii(spark, sf_dir):
    return op6.pii_digests(table(spark, sf_dir, "documents"))


#: (verdict, host, path prefix)
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def q_url_filter(spark, sf_dir):
    return op7.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def q_toxicity(spark, sf_dir):
    return op8.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def q_warc(spark, sf_dir):
    return op9.warc_round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def q_bpe(spark, sf_dir):
    return op10.bpe_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def q_resampling(spark, sf_dir):
    return op11.resampling_digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def q_collocations(spark, sf_dir):
    return op12.top_collocations(table(spark, sf_dir, "documents"))


def q_secrets(spark, sf_dir):
    return op13.secret_digests(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_hyperminhash": q_minhash,
    "op2_token_store": q_token_store,
    "op3_exact_dedup": q_exact_dedup,
    "op4_fm_index": q_decontaminate,
    "op5_line_dedup": q_line_dedup,
    "op6_boosted_pii": q_pii,
    "op7_url_filter": q_url_filter,
    "op8_string_kernel": q_toxicity,
    "op9_warc": q_warc,
    "op10_bpe": q_bpe,
    "op11_importance": q_resampling,
    "op12_collocations": q_collocations,
    "op13_entropy_secrets": q_secrets,
}

ORACLE: dict[str, str] = {}

ORACLE["op3_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS s FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY s) AS kept, sha256(s) AS text_sha256
FROM t"""

_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
ORACLE["op7_url_filter"] = rf"""
WITH rules(verdict, rhost, rpath) AS (VALUES {_RULE_ROWS}),
cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path FROM cut),
fit AS (SELECT page_id, rhost || rpath AS rule, r.verdict,
               row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS k
        FROM parts JOIN rules r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, host, coalesce(path, '') AS path, rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fit f ON p.page_id = f.page_id AND k = 1"""

ORACLE["op9_warc"] = """
WITH t AS (SELECT page_id, coalesce(html, '') AS s FROM pages),
d AS (SELECT page_id, strlen(s) AS payload_bytes, sha1(s) AS payload_digest,
             CASE WHEN strlen(s) >= 1000 THEN max(page_id) OVER (PARTITION BY s) END AS top FROM t)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < top THEN top END AS refers_to
FROM d"""

ORACLE["op4_fm_index"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS k
           FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS s FROM starts),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS s
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes)),
found AS (SELECT g.doc_id, g.k, g.n, v.item_id FROM grams g JOIN windows v ON g.n = v.n AND g.s = v.s),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS list
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN items ON d.doc_id = items.doc_id"""

# Lines of a Jaccard similarity of 0.8 share a word among the ceil(0.2 n) + 1 rarest of either.
ORACLE["op5_line_dedup"] = r"""
WITH l AS (SELECT doc_id, CAST(i AS INTEGER) AS line, string_split(coalesce(text, ''), chr(10))[i + 1] AS s
           FROM (SELECT doc_id, text, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents)),
w AS (SELECT doc_id, line, s, list_sort(list_distinct(list_filter(
             regexp_split_to_array(lower(s), '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS words FROM l),
c AS (SELECT words, len(words) AS n, min((doc_id, line)) AS pos FROM w WHERE len(words) > 0 GROUP BY words),
t AS (SELECT pos, n, unnest(words) AS word FROM c),
f AS (SELECT word, count(*) AS df FROM t GROUP BY word),
r AS (SELECT pos, n, word, row_number() OVER (PARTITION BY pos ORDER BY df, word) AS k FROM t JOIN f USING (word)),
p AS (SELECT pos, n, word FROM r WHERE k <= n - ceil(0.8 * n) + 1),
cand AS (SELECT DISTINCT a.pos AS later, b.pos AS earlier FROM p a JOIN p b
         ON a.word = b.word AND a.pos > b.pos AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n),
near AS (SELECT DISTINCT later FROM cand JOIN c x ON x.pos = later JOIN c y ON y.pos = earlier
         WHERE 9 * len(list_intersect(x.words, y.words)) >= 4 * (x.n + y.n)),
judged AS (SELECT w.doc_id, line, s, len(w.words) > 0 AND (c.pos <> (w.doc_id, line) OR near.later IS NOT NULL) AS gone
           FROM w LEFT JOIN c ON w.words = c.words LEFT JOIN near ON near.later = c.pos)
SELECT doc_id, CAST(count(*) AS INTEGER) AS n_lines, CAST(count(*) FILTER (gone) AS INTEGER) AS n_removed,
       sha256(coalesce(string_agg(s, chr(10) ORDER BY line) FILTER (NOT gone), '')) AS text_sha256
FROM judged GROUP BY doc_id"""

# CRC-32 by bytes: a table of 256 from its rule, then one step a byte of each distinct feature.
ORACLE["op11_importance"] = r"""
WITH crc AS MATERIALIZED (SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
        FROM (SELECT unnest(range(256)) AS b)),
texts AS (SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 'b', row_number() OVER (), text FROM benchmark),
w AS (SELECT side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
runs AS (SELECT side, doc_id, array_to_string(w[k:k + n - 1], ' ') AS f
         FROM (SELECT side, doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM w, (SELECT unnest([1, 2, 3]) AS n))),
feature AS (SELECT f, xor(list_reduce(list_transform(range(1, strlen(f) + 1), lambda i: ('0x' || substr(hex(encode(f)), 2 * i - 1, 2))::BIGINT),
                   lambda c, x: xor(t[1 + (xor(c, x) & 255)], c >> 8), 4294967295), 4294967295) % 10000 AS bucket
            FROM (SELECT DISTINCT f FROM runs), crc),
counts AS (SELECT side, bucket, count(*) AS n FROM runs JOIN feature USING (f) GROUP BY ALL),
whole AS (SELECT coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t FROM counts),
gain AS (SELECT d.bucket, floor(1000 * ln((coalesce(b.n, 0) + 1)::DOUBLE * (s + 10000)::DOUBLE / ((d.n + 1)::DOUBLE * (t + 10000)::DOUBLE)))::BIGINT AS g
         FROM (SELECT * FROM counts WHERE side = 'd') d LEFT JOIN (SELECT * FROM counts WHERE side = 'b') b ON d.bucket = b.bucket, whole),
sums AS (SELECT doc_id, count(*) AS n_features, sum(g) AS weight FROM runs JOIN feature USING (f) JOIN gain USING (bucket)
         WHERE side = 'd' GROUP BY doc_id),
scored AS (SELECT w.doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                  (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || w.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
                   / 4294967296))))::BIGINT AS score
           FROM w LEFT JOIN sums USING (doc_id) WHERE side = 'd'),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 5 * n // 100 THEN r END AS rank FROM scored LEFT JOIN ranked USING (doc_id)"""

ORACLE["op12_collocations"] = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
f AS (SELECT lang, size, array_to_string(w[k:k + size - 1], ' ') AS phrase, count(*) AS f
      FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM w, (SELECT unnest([1, 2, 3]) AS size)) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size >= 2 AND f >= 10),
cuts AS (SELECT lang, size, phrase, a, k, array_to_string(w[:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
         FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
scores AS (SELECT c.lang, c.size, c.phrase, a, k, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
           FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.x JOIN f y ON y.lang = c.lang AND y.phrase = c.y),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM scores),
longer AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM c WHERE size = 3),
kept AS (SELECT lang, phrase, a, l, r, score FROM best b WHERE cut = 1 AND NOT EXISTS (
         SELECT 1 FROM longer g WHERE g.lang = b.lang AND g.phrase = b.phrase AND 100 * g.a >= 50 * b.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""

ORACLE["op1_hyperminhash"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 3], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS k
      FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT a.doc_id AS x, b.doc_id AS y FROM (SELECT a.doc_id, b.doc_id AS other, count(*) AS c
          FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL) a JOIN n p ON p.doc_id = a.doc_id
          JOIN n b ON b.doc_id = a.other WHERE 100 * c >= 80 * (p.n + b.n - c)),
reach AS (SELECT doc_id, doc_id AS r FROM w UNION SELECT reach.doc_id, y FROM reach JOIN links ON x = r),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)"""
