"""One query for each operator, over its whole table with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sievepoint.llm import (chat, decontamination, hnsw, language, licences, lines, manifest, mixing, phrases, pii, shards,
                            simhash, urls)
from sievepoint.llm.text import sha256

QUERIES, ORACLES = {}, {}
WEIGHTS = {"src0": 0.2, "src1": 0.1, "src2": 0.1, "src3": 0.1}
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql.strip()
        return fn
    return register


@query("""
WITH placed AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS pos
  FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL)),
prefixes AS (
  SELECT conv_id, pos, count(*) OVER (PARTITION BY conv_id) AS n_turns,
         string_agg('<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10), '')
           OVER (PARTITION BY conv_id ORDER BY pos) AS text
  FROM placed),
ends AS (SELECT text, max(n_turns) AS n_turns, min(conv_id) AS conv_id, count(*) AS n_copies
         FROM prefixes WHERE pos = n_turns GROUP BY text)
SELECT conv_id, n_turns, n_copies, text FROM ends
WHERE text NOT IN (SELECT text FROM prefixes WHERE pos < n_turns)
""")
def op1_maximal_conversations(spark, sf_dir):
    return chat.maximal_conversations(_table(spark, sf_dir, "conversations"))


@query("""
WITH sizes AS (SELECT source, CAST(sum(length(coalesce(text, ''))) AS DOUBLE) AS chars FROM documents GROUP BY source),
given AS (SELECT source, chars, CASE source WHEN 'src0' THEN 0.2::DOUBLE WHEN 'src1' THEN 0.1::DOUBLE WHEN 'src2' THEN 0.1::DOUBLE
                 WHEN 'src3' THEN 0.1::DOUBLE END AS given FROM sizes),
rates AS (
  SELECT source, coalesce(given, 0.5::DOUBLE / (SELECT count(*) FROM given WHERE given IS NULL AND chars > 0))
           * (SELECT sum(chars) FROM sizes) / chars AS rate
  FROM given WHERE chars > 0),
terms AS (
  SELECT source, j, exp(-rate + j * ln(rate) - lgamma(j + 1.0::DOUBLE)) AS p
  FROM (SELECT *, unnest(range(CAST(greatest(floor(rate - 12 * sqrt(rate)), 0) AS BIGINT), CAST(ceil(rate + 12 * sqrt(rate)) AS BIGINT) + 31)) AS j FROM rates)),
upto AS (SELECT source, j, sum(p) OVER (PARTITION BY source ORDER BY j) AS p FROM terms),
drawn AS (
  SELECT doc_id, text, lang, source, n_chars,
         CAST(CAST('0x' || substr(md5('mix:' || doc_id), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496 AS u
  FROM documents),
counted AS (SELECT d.*, (SELECT coalesce(max(t.j) + 1, 0) FROM upto t WHERE t.source IS NOT DISTINCT FROM d.source AND t.p <= d.u) AS n FROM drawn d)
SELECT doc_id, text, lang, source, n_chars, CAST(copy_no AS INTEGER) AS copy_no,
       CAST(CAST('0x' || substr(md5('mix:order:' || doc_id || ':' || copy_no), 1, 13) AS BIGINT) AS DOUBLE)
         / 4503599627370496 AS order_key
FROM (SELECT *, unnest(range(1, n + 1)) AS copy_no FROM counted)
""")
def op2_poisson_mix(spark, sf_dir):
    return mixing.mix_sources(_table(spark, sf_dir, "documents"), WEIGHTS)


@query()
def op3_language_spans(spark, sf_dir):
    found = language.identify(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.coalesce(language.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                        "lang_pred", "score", F.size("spans").alias("n_spans"))


@query()
def op4_path_templates(spark, sf_dir):
    return urls.judge_pages(_table(spark, sf_dir, "pages"), RULES)


@query()
def op5_simhash_components(spark, sf_dir):
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query()
def op6_nearest_vectors(spark, sf_dir):
    return hnsw.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


_LOWER_WORDS = (r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
_PAIRS = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
_TEMPLATE_ROWS = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in licences.TEMPLATES.items())


@query(f"""
WITH tpl AS (SELECT name, {_PAIRS} AS b FROM (SELECT name, {_LOWER_WORDS.format("t")} AS w FROM (VALUES {_TEMPLATE_ROWS}) v(name, t))),
d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
unit AS (
  SELECT doc_id, unnest(string_split(body, chr(10))) AS unit FROM d
  UNION SELECT doc_id, unnest(regexp_split_to_array(body, chr(10) || '{{2,}}')) FROM d WHERE contains(body, chr(10) || chr(10))
  UNION SELECT doc_id, body FROM d WHERE contains(body, chr(10))),
a AS (SELECT doc_id, unit, {_PAIRS} AS a FROM (SELECT doc_id, unit, {_LOWER_WORDS.format("unit")} AS w FROM unit) WHERE len(w) > 1),
s AS (SELECT doc_id, unit, name, 2 * len(list_intersect(a, b)) / (len(a) + len(b)) AS dice FROM a, tpl
      WHERE len(a) BETWEEN len(b) * 0.8 / 1.2 AND len(b) * 1.2 / 0.8),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, unit ORDER BY dice DESC, name) AS r FROM s WHERE dice >= 0.8),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, name) AS rank, count(*) OVER (PARTITION BY doc_id) AS n
           FROM best WHERE r = 1)
SELECT doc_id, name AS licence, dice, CAST(coalesce(n, 0) AS INTEGER) AS n_found FROM d LEFT JOIN (FROM ranked WHERE rank = 1) USING (doc_id)
""")
def op7_licence_statements(spark, sf_dir):
    found = licences.scan_licences(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "licence", "dice", F.size("licences").alias("n_found"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


@query()
def op8_personal_data(spark, sf_dir):
    found = pii.find_personal_data(_table(spark, sf_dir, "documents"))
    of_kind = lambda k: F.filter("spans", lambda x: x["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in pii.BASE]
    base = F.filter("spans", lambda x: x["kind"].isin(*pii.BASE))
    return found.select("doc_id", *counts, sha256(_joined(base)).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


@query("""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM split),
shared AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, s.key IS NOT NULL AS hit FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (hit) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT hit), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""")
def op9_shared_lines(spark, sf_dir):
    found = lines.drop_shared_lines(_table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return found.select("doc_id", "n_lines", "n_dropped", sha256(F.col("text")).alias("kept_sha256"))


_WORDS = _LOWER_WORDS.format("coalesce(text, '')")


@query(f"""
WITH doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT d.*, l.n, unnest(range(1, len(w) - l.n + 2)) AS i FROM doc d, (SELECT DISTINCT n FROM windows) l WHERE len(w) >= l.n)),
hits AS (SELECT doc_id, p.n, i, item_id FROM places p JOIN windows USING (n, s)),
words AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""")
def op10_benchmark_passages(spark, sf_dir):
    found = decontamination.find_passages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        sha256(F.array_join("item_ids", ",")).alias("items_sha256"), "contaminated")


@query(r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
f AS MATERIALIZED (
  SELECT lang, size, p, count(*) AS a FROM (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS p
    FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, range(1, 5) t(size) WHERE len(w) >= size))
  GROUP BY lang, size, p),
candidate AS MATERIALIZED (SELECT *, string_split(p, ' ') AS w FROM f WHERE size > 1 AND a >= 30),
often AS MATERIALIZED (SELECT lang, p, a FROM f WHERE a >= 30),
cut AS (SELECT lang, p, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
        FROM (SELECT *, unnest(range(1, size)) AS k FROM candidate)),
scored AS (
  SELECT c.lang, c.p, c.a, k, l.a AS l, r.a AS r,
         CAST(CAST(2000000 AS HUGEINT) * c.a // (CAST(l.a AS HUGEINT) + r.a) AS BIGINT) AS score
  FROM cut c JOIN often l ON l.lang = c.lang AND l.p = c.x JOIN often r ON r.lang = c.lang AND r.p = c.y),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS p, max(a) AS most
  FROM (SELECT *, unnest(range(1, size - k + 2)) AS i FROM candidate, range(2, 4) t(k) WHERE size > k) GROUP BY ALL),
kept AS (SELECT w.*, w.p AS phrase FROM worst w LEFT JOIN inner_parts s ON s.lang = w.lang AND s.p = w.p
         WHERE most IS NULL OR 100 * most < 80 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
""")
def op11_collocations(spark, sf_dir):
    return phrases.collocations(_table(spark, sf_dir, "documents"), longest=4, least=30, covered=80, top=2000)


# CRC-32 of a list of bytes, bit by bit; DuckDB has none built in.
_BIT = "xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)"
_CRC_TABLE = ("SELECT list(x ORDER BY b) AS t FROM (SELECT b, list_reduce(range(8), lambda x, i: "
              + _BIT + ", b::BIGINT) AS x FROM range(256) r(b))")


def _crc(table: str, codes: str) -> str:
    return f"xor(list_reduce({codes}, lambda x, b: xor(x >> 8, {table}[xor(x & 255, b) + 1]), 4294967295::BIGINT), 4294967295)"


_FRAME = "coalesce(CAST(strlen({0}) AS VARCHAR) || ':' || {0}, '-')"
_LEAF = "sha256({})".format(" || ".join(
    _FRAME.format(f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars", "text")))


@query(f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
leaf AS (
  SELECT doc_id, lang, n_chars, {_LEAF} AS leaf, {_LEAF.replace("n_chars", "(n_chars + 1)")} AS changed,
         {_crc("t", "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)")} % 7 = 0 AS tampered,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos
  FROM documents, crc),
node AS (
  SELECT lang, 0 AS level, pos, leaf AS d, count(*) OVER (PARTITION BY lang) AS n FROM leaf
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (n + 1) // 2 FROM node WHERE n > 1
  GROUP BY lang, level, pos // 2, n),
subroot AS (SELECT lang, level AS height, d AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS spot FROM node WHERE n = 1),
top AS (
  SELECT 0 AS level, spot AS pos, subroot AS d, count(*) OVER () AS n FROM subroot
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY level, pos // 2, n),
tree AS (
  SELECT s.lang, n.level, n.pos AS pos, n.d FROM node n JOIN subroot s ON s.lang IS NOT DISTINCT FROM n.lang WHERE n.level < s.height
  UNION ALL SELECT s.lang, s.height + t.level, t.pos, t.d FROM top t, subroot s),
heights AS (SELECT lang, height, height + (SELECT max(level) FROM top) AS whole, spot, subroot FROM subroot),
path AS (
  SELECT l.doc_id, l.lang, 0 AS level, l.pos, CASE WHEN tampered THEN coalesce(changed, leaf) ELSE leaf END AS d, '' AS proof FROM leaf l
  UNION ALL
  SELECT p.doc_id, p.lang, p.level + 1, CASE WHEN p.level < h.height THEN p.pos ELSE h.spot >> (p.level - h.height) END // 2,
         sha256(CASE WHEN o.d IS NULL THEN p.d WHEN o.pos % 2 = 1 THEN p.d || o.d ELSE o.d || p.d END), p.proof || coalesce(o.d, '')
  FROM path p JOIN heights h ON h.lang IS NOT DISTINCT FROM p.lang
  LEFT JOIN tree o ON o.lang IS NOT DISTINCT FROM p.lang AND o.level = p.level
    AND o.pos = xor(CASE WHEN p.level < h.height THEN p.pos ELSE h.spot >> (p.level - h.height) END, 1)
  WHERE p.level < h.whole),
root AS (SELECT d AS root FROM top WHERE n = 1)
SELECT l.doc_id, l.leaf, h.subroot, root, sha256(p.proof) AS proof_sha256, p.d AS folded_root, p.d = root AS verified
FROM leaf l JOIN heights h ON h.lang IS NOT DISTINCT FROM l.lang JOIN path p ON p.doc_id = l.doc_id AND p.level = h.whole, root
""")
def op12_merkle_manifest(spark, sf_dir):
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = [F.col("n_chars") + 1 if i == 3 else c for i, c in enumerate(fields)]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id", "lang", manifest.leaf_digest(*fields).alias("leaf"),
        F.when(tampered, manifest.leaf_digest(*changed)).alias("changed"))
    found = manifest.manifest(rows, group="lang", order="doc_id", fanout=2)
    folded = manifest.fold(F.coalesce("changed", "leaf"), F.col("proof"))
    return found.select("doc_id", "leaf", "subroot", "root", sha256(manifest.siblings(F.col("proof"))).alias("proof_sha256"),
                        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


_DRAW = "CAST('0x' || substr(md5('shard:' || doc_id || ':' || s), 1, 13) AS BIGINT)"
_BYTES = "list_transform(range(1, strlen(coalesce(text, '')) + 1), lambda i: CAST('0x' || substr(h, 2 * i - 1, 2) AS BIGINT))"


@query(f"""
WITH crc AS ({_CRC_TABLE}),
drawn AS (SELECT doc_id, s, {_DRAW} AS u FROM documents, range(41) r(s)),
spot AS (
  SELECT doc_id, arg_max(s, u) FILTER (s < 40) AS shard, arg_max(s, u) AS grown_shard FROM drawn GROUP BY doc_id),
bytes AS (SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size, {_crc("t", _BYTES)} AS text_crc32
          FROM (SELECT *, hex(encode(coalesce(text, ''))) AS h FROM documents), crc)
SELECT doc_id, size, text_crc32, 'key' AS law, shard // 18 AS region, shard // 6 AS rack, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(grown_shard AS INTEGER) AS grown_shard
FROM bytes JOIN spot USING (doc_id)
""")
def op13_weighted_shards(spark, sf_dir):
    return shards.assign(_table(spark, sf_dir, "documents"), shards=40)
