"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.llm import (
    cross_parse, exact_dedup, external_shuffle, importance, license_scan, merkle, ngram_join, preference_chat, ranked_search, secret_ledger,
    sentencepiece_trie, temperature_mix, url_rules,
)
from stationflow.session import materialise, scratch_path

URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
SHARDS = 24
ENTROPY_SHARE, REPETITION = 0.95, 2.0


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sentencepiece_model() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_classes(_table(spark, sf_dir, "documents"), words=4, percent=85)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, decision string")
    return url_rules.judge_urls(_table(spark, sf_dir, "pages"), rules)


def op3_preference_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as chosen; rejected is the same up to its last assistant turn, which is answered as in the next conversation that has one.

    The next conversation is that of the next larger id, after the last the first. A conversation without
    an assistant turn is its own rejected one, so both its completions are empty. Spans are told as text,
    start:end joined by commas.
    """
    turns = _table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    last = F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("answer"))).alias("last")
    answer = turns.filter("role = 'assistant' and pair_id is not null").groupBy("pair_id").agg(last)
    answer = materialise(answer.select("pair_id", F.col("last.turn").alias("at"), "last.answer"), "answers")
    ahead = merkle.following(answer.select(F.col("pair_id").alias("doc_id"))).select(F.col("doc_id").alias("pair_id"), "next_id")
    other = answer.select(F.col("pair_id").alias("next_id"), F.col("answer").alias("other"))
    swapped = answer.join(ahead, "pair_id").join(other, "next_id").drop("next_id")
    has, turn = F.col("other").isNotNull(), F.col("turn")
    upto = F.coalesce(turn <= F.col("at"), turn.isNull())
    at = has & (F.col("role") == "assistant") & turn.eqNullSafe(F.col("at")) & (F.coalesce("text", F.lit("")) == F.col("answer"))
    rejected = turns.join(swapped, "pair_id", "left").filter(~has | upto).select("pair_id", "turn", "role", F.when(at, F.col("other")).otherwise(F.col("text")).alias("text"))
    pairs = preference_chat.format_preferences(turns, rejected)
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias(spans)
    return pairs.select("pair_id", "n_prompt_turns", "prompt", "chosen", told("chosen_spans"), "rejected", told("rejected_spans"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_trie.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), sentencepiece_model(), check="round_trip").drop("text")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(_table(spark, sf_dir, "documents"))


def op6_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprint_edits(_table(spark, sf_dir, "documents"))


def op7_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents written as shards; size, checksum and place are those of the written records."""
    written = external_shuffle.write_shards(_table(spark, sf_dir, "documents"), scratch_path(spark, "shards"), SHARDS)
    text = F.coalesce("text", F.lit(""))
    size, crc = (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    return written.select("doc_id", size, crc, F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_cross_parse_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    models = cross_parse.learn(docs.filter(~cross_parse.held_out()))
    told = cross_parse.identify(docs.select("doc_id", "text"), models)
    return told.select("doc_id", cross_parse.held_out().alias("held_out"), "lang_pred", "score")


def op9_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temperature_mix.mixture_order(_table(spark, sf_dir, "documents"), ENTROPY_SHARE, REPETITION)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents laid out as a tree source / thousand / fifty / name; every tenth is named LICENSE."""
    name = F.when(F.col("doc_id") % 10 == 0, "LICENSE").otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    part = lambda n: F.floor(F.col("doc_id") / n).cast("string")
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), part(1000), part(50), name)
    files = _table(spark, sf_dir, "documents").select(path.alias("path"), "text")
    return license_scan.scan_licenses(files)


def op11_bitsliced_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), percent=10, seed=2024)


def op12_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the versions of a history, scanned into a new ledger with the base rules and those for tokens of known services."""
    found = secret_ledger.scan_history(_table(spark, sf_dir, "documents"), scratch_path(spark, "ledger"), "first", keys=("doc_id",))
    base = [r.kind for r in secret_ledger.BASE_RULES]
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    plain = secret_ledger.spans_text(F.filter("spans", lambda s: s["kind"].isin(base)))
    return found.select("doc_id", *[of(k) for k in base], F.sha2(plain.cast("binary"), 256).alias("base_sha256"), secret_ledger.spans_text(F.col("spans")).alias("spans"))


def op13_lemp_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_ngram_jaccard, op2_url_filters, op3_preference_chat, op4_sentencepiece, op5_exact_dedup, op6_merkle_fingerprints,
    op7_external_shuffle, op8_cross_parse_language, op9_temperature_mix, op10_license_scan,
    op11_bitsliced_importance, op12_secret_ledger, op13_lemp_search,
)}

SQL: dict[str, str] = {}

SQL["op5_exact_dedup"] = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""

SQL["op2_url_filters"] = r"""
WITH RECURSIVE rules(rhost, rpath, decision) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
u AS (
  SELECT page_id, url, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail FROM pages),
p AS (
  SELECT page_id, url, html, translate(regexp_extract(tail, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
bare AS (
  SELECT url, regexp_replace(html, '(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)', ' ', 'g') AS html FROM pages WHERE url IS NOT NULL AND html IS NOT NULL),
l0 AS (
  SELECT url, unnest([regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?is)\bhref\s*=\s*["'']?\s*([^"''>\s]+)', 1),
                      regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?is)\burl\s*=\s*["'']?\s*([^"''>\s]+)', 1)]) AS link
  FROM bare),
l AS (SELECT url, regexp_replace(link, '&(amp|#38|#x26);', '&', 'gi') AS link FROM l0),
ab AS (
  SELECT url, CASE WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN link
                   WHEN link LIKE '//%' THEN regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*:') || link
                   WHEN link LIKE '/%' THEN regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*') || link
                   ELSE regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/?([^?#]*/)?') || link END AS target FROM l WHERE link <> ''),
ends AS (SELECT url AS x, target AS y FROM ab UNION SELECT target, url FROM ab),
named AS (
  SELECT v, lower(regexp_extract(v, '^([^:/?#]*)://', 1)) AS scheme, lower(regexp_extract(v, '://([^/?#]*)', 1)) AS host, regexp_extract(v, '://[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(v, '^[^?#]*(\?[^#]*)?', 1) AS query
  FROM (SELECT x AS v FROM ends UNION SELECT url FROM pages WHERE url IS NOT NULL)),
straight AS (
  SELECT *, array_to_string(list_reduce(list_transform(string_split(path, '/'), lambda s: [s]),
    lambda a, b: CASE b[1] WHEN '.' THEN a WHEN '..' THEN a[1:greatest(len(a) - 1, 1)] ELSE list_concat(a, b) END), '/') AS straight FROM named),
key AS (
  SELECT v, host, path, CASE scheme WHEN 'http' THEN regexp_replace(host, ':(80)?\z', '') WHEN 'https' THEN regexp_replace(host, ':(443)?\z', '') ELSE host END
         || regexp_replace(straight, '/+$', '') || query AS address FROM straight),
e AS (SELECT DISTINCT a.address AS x, b.address AS y FROM ends JOIN key a ON a.v = ends.x JOIN key b ON b.v = ends.y WHERE a.address <> b.address AND a.host <> '' AND b.host <> ''),
reach(x, y) AS (SELECT x, y FROM e UNION SELECT reach.x, e.y FROM reach JOIN e ON e.x = reach.y),
seed AS (
  SELECT address FROM (
    SELECT address, decision, row_number() OVER (PARTITION BY v ORDER BY length(rhost || rpath) DESC) AS k
    FROM key JOIN rules ON (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath)) WHERE k = 1 AND decision = 'block'),
spread AS (SELECT DISTINCT reach.y AS address FROM reach JOIN seed ON seed.address = reach.x),
r AS (
  SELECT page_id, host, path, url, rhost || rpath AS rule, decision,
         row_number() OVER (PARTITION BY page_id, url ORDER BY length(rhost || rpath) DESC NULLS LAST) AS k
  FROM p LEFT JOIN rules ON (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath))
SELECT page_id, r.host, r.path, rule, coalesce(decision, CASE WHEN spread.address IS NOT NULL THEN 'block' END, 'allow') AS verdict,
       CASE WHEN decision IS NOT NULL THEN 'rule' WHEN spread.address IS NOT NULL THEN 'alias' ELSE 'default' END AS via
FROM r LEFT JOIN key ON key.v = r.url LEFT JOIN spread ON spread.address = key.address WHERE k = 1
"""

SQL["op3_preference_chat"] = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text, role = 'assistant' AS answers FROM conversations WHERE conv_id IS NOT NULL),
a AS (
  SELECT conv_id, turn AS last_turn, text AS answer FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, text DESC) AS k FROM t WHERE answers) WHERE k = 1),
swapped AS (SELECT *, coalesce(lead(answer) OVER (ORDER BY conv_id), first_value(answer) OVER (ORDER BY conv_id)) AS other FROM a),
r AS (
  SELECT conv_id, turn, role, CASE WHEN answers AND turn IS NOT DISTINCT FROM last_turn AND text = answer THEN other ELSE text END AS text
  FROM t LEFT JOIN swapped USING (conv_id) WHERE other IS NULL OR coalesce(turn <= last_turn, turn IS NULL)),
sides AS (SELECT 'c' AS side, conv_id, turn, role, text FROM t UNION ALL SELECT 'r', conv_id, turn, role, text FROM r),
k AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, side ORDER BY turn NULLS FIRST, role, text) AS i,
         '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS told FROM sides),
c AS (SELECT * FROM k WHERE side = 'c'),
j AS (SELECT * FROM k WHERE side = 'r'),
p AS (
  SELECT conv_id, CAST(coalesce(min(i) FILTER (c.role IS DISTINCT FROM j.role OR c.text IS DISTINCT FROM j.text) - 1, count(*)) AS INTEGER) AS n
  FROM c FULL JOIN j USING (conv_id, i) GROUP BY 1),
x AS (
  SELECT side, conv_id, i, n, role, told, i > n AS after, coalesce(sum(CASE WHEN i > n THEN length(told) END) OVER (
    PARTITION BY conv_id, side ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM k JOIN p USING (conv_id)),
y AS (SELECT *, CAST(start + length(role) + 5 AS BIGINT) || ':' || CAST(start + length(told) AS BIGINT) AS span FROM x)
SELECT conv_id AS pair_id, n AS n_prompt_turns,
       coalesce(string_agg(told, '' ORDER BY i) FILTER (side = 'c' AND NOT after), '') AS prompt,
       coalesce(string_agg(told, '' ORDER BY i) FILTER (side = 'c' AND after), '') AS chosen,
       coalesce(string_agg(span, ',' ORDER BY i) FILTER (side = 'c' AND after AND role = 'assistant'), '') AS chosen_spans,
       coalesce(string_agg(told, '' ORDER BY i) FILTER (side = 'r' AND after), '') AS rejected,
       coalesce(string_agg(span, ',' ORDER BY i) FILTER (side = 'r' AND after AND role = 'assistant'), '') AS rejected_spans
FROM y GROUP BY conv_id, n
"""

SQL["op6_merkle_fingerprints"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
ahead AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS after FROM d),
e AS (SELECT *, substr(text, 1, n - n // 2) || substr(after, 1, n // 2) AS edited FROM ahead),
texts AS (SELECT text FROM e UNION SELECT edited FROM e),
leaves AS (SELECT text, list_transform(regexp_extract_all(text, '[^\n]{1,96}\n?|\n'), lambda p: substr(sha256(p), 1, 16)) AS leaves FROM texts),
sections AS (
  SELECT text, leaves, list_filter(string_split_regex(array_to_string(list_transform(leaves, lambda h: CASE WHEN h LIKE '%0' THEN h || ';' ELSE h END), ' '), '; ?'), lambda s: s <> '') AS sections FROM leaves),
prints AS (
  SELECT text, list_distinct(leaves) AS leaves, sha256(coalesce(array_to_string(list_transform(sections, lambda s: sha256(s)), ''), '')) AS root,
         coalesce(array_to_string(list_transform(sections, lambda s: ';' || substr(sha256(s), 1, 8) || ' ' || s), ''), '') AS branches FROM sections),
three AS (
  SELECT doc_id, n, edited, a.root || a.branches AS fingerprint, b.root || b.branches AS edited_fingerprint, a.root AS r, b.root AS rb, c.root AS rc, a.leaves AS l, b.leaves AS lb, c.leaves AS lc
  FROM e JOIN prints a ON a.text = e.text JOIN prints b ON b.text = e.edited JOIN prints c ON c.text = e.after)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, fingerprint, edited_fingerprint,
       CASE WHEN r = rb THEN 1 ELSE CAST(2 AS DOUBLE) * len(list_intersect(l, lb)) / greatest(len(l) + len(lb), 1) END AS near_edited,
       CASE WHEN r = rc THEN 1 ELSE CAST(2 AS DOUBLE) * len(list_intersect(l, lc)) / greatest(len(l) + len(lc), 1) END AS near_next
FROM three
"""

SQL["op1_ngram_jaccard"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda k: array_to_string(w[k:k + 3], ' ')) END) AS gram FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (
  SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * m >= 85 * (p.n + q.n - m)),
reach(x, y) AS (SELECT x, y FROM e UNION SELECT reach.x, e.y FROM reach JOIN e ON e.x = reach.y),
c AS (SELECT x, min(y) AS least FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.least, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.x = d.doc_id
"""

# crc32 by its table of 256 remainders, over the bytes of each distinct word.
SQL["op11_bitsliced_importance"] = r"""
WITH RECURSIVE steps(i, k, v) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS tab FROM steps WHERE k = 8),
texts AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
words AS (
  SELECT side, id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts),
coded AS (SELECT DISTINCT word, hex(encode(word)) AS code FROM words),
bytes AS (
  SELECT word, list_transform(range(0, length(code) // 2), lambda k:
    CAST(16 * (strpos('0123456789ABCDEF', substr(code, CAST(2 * k + 1 AS BIGINT), 1)) - 1) + strpos('0123456789ABCDEF', substr(code, CAST(2 * k + 2 AS BIGINT), 1)) - 1 AS BIGINT)) AS b FROM coded),
hashed AS (
  SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b), lambda crc, x: xor(crc >> 8, tab[CAST((xor(crc, x) & 255) + 1 AS BIGINT)])), 4294967295) % 10000 AS bucket
  FROM bytes, tab),
occurs AS (SELECT side, id, bucket FROM words JOIN hashed USING (word)),
per AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM occurs GROUP BY 1),
total AS (SELECT CAST(sum(s) AS DOUBLE) AS s, CAST(sum(t) AS DOUBLE) AS t FROM per),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(((CAST(per.t AS DOUBLE) + 1) * (total.s + 10000)) / ((CAST(per.s AS DOUBLE) + 1) * (total.t + 10000)))) AS BIGINT) AS gain FROM per, total),
mean AS (
  SELECT id AS doc_id, count(*) AS n_features, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
  FROM occurs JOIN gain USING (bucket) WHERE side = 'd' GROUP BY 1),
noisy AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((
    list_reduce(list_transform(range(1, 9), lambda k: CAST(strpos('0123456789abcdef', substr(sha256('2024:' || doc_id), CAST(k AS BIGINT), 1)) - 1 AS BIGINT)),
      lambda a, b: 16 * a + b) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN mean USING (doc_id)),
able AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM noisy WHERE n_features >= 20)
SELECT noisy.*, able.rank FROM noisy LEFT JOIN able ON able.doc_id = noisy.doc_id AND rank <= 10 * n // 100
"""

SQL["op13_lemp_search"] = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM documents),
size AS (SELECT doc_id, count(*) AS n FROM words GROUP BY 1),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM size),
post AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY 1, 2),
weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM post, corpus GROUP BY term, docs),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // total))))) AS BIGINT) AS score
  FROM asked JOIN post USING (term) JOIN weight USING (term) JOIN size USING (doc_id), corpus GROUP BY 1, 2),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""

# Matches are marked by two characters that texts are freed of before, and positions are sums of lengths.
_KINDS = [
    ("assign", "(([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+))"),
    ("access", "(AKIA[A-Z0-9]+)"),
    ("hex", "([0-9a-f]+)"),
    ("private_key", "(-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----)"),
    ("github", "(\\bgh[pousr]_[A-Za-z0-9]{36,})"),
    ("slack", "(\\bxox[abprs]-[A-Za-z0-9-]{10,})"),
    ("google", "(\\bAIza[A-Za-z0-9_-]{35})"),
    ("jwt", "(\\beyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,})"),
]
_LEAST = """CASE kind WHEN 'assign' THEN length(regexp_extract(found, pattern, 3)) >= 12
  WHEN 'access' THEN length(found) >= 18 WHEN 'hex' THEN length(found) >= 16 ELSE TRUE END"""

SQL["op12_secret_ledger"] = f"""
WITH kinds(place, kind, pattern) AS (VALUES {", ".join(f"({i}, '{kind}', '{pattern}')" for i, (kind, pattern) in enumerate(_KINDS))}),
texts AS (SELECT DISTINCT coalesce(text, '') AS text FROM documents),
cut AS (
  SELECT text, place, kind, pattern, unnest(string_split(regexp_replace(translate(text, chr(1) || chr(2), chr(3) || chr(3)), pattern, chr(1) || '\\1' || chr(2), 'g'), chr(1))) AS part,
         generate_subscripts(string_split(regexp_replace(translate(text, chr(1) || chr(2), chr(3) || chr(3)), pattern, chr(1) || '\\1' || chr(2), 'g'), chr(1)), 1) AS k
  FROM texts, kinds),
marked AS (
  SELECT text, place, kind, pattern, k, string_split(part, chr(2))[1] AS found,
         coalesce(sum(length(replace(part, chr(2), ''))) OVER (PARTITION BY text, place ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM cut),
spans AS (SELECT text, place, kind, start, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + length(found) AS BIGINT) AS span FROM marked WHERE k > 1 AND {_LEAST}),
per AS (
  SELECT text, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(span, ',' ORDER BY start, place) FILTER (place < 3) AS base, string_agg(span, ',' ORDER BY start, place) AS spans FROM spans GROUP BY text)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN per ON per.text = coalesce(d.text, '')
"""
