"""The registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.llm import (bpe, collocations, embeddings, fingerprint, langid, licenses, merkle, minhash, mixing, packing, pii,
                             toxicity, url_filter)
from tablewright.llm.common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


_REACH = """,
reach(node, other) AS (SELECT id, id FROM nodes UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
lowest AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)"""


@query("op1_embedding_dedup", f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.9),
nodes AS (SELECT vec_id AS id FROM embeddings){_REACH}
SELECT n.id AS vec_id, CAST((SELECT count(*) FROM links WHERE a = n.id) AS BIGINT) AS n_links, component_id,
       component_id = n.id AS kept FROM nodes n JOIN lowest ON node = n.id""")
def op1(spark, sf):
    return embeddings.near_duplicates(table(spark, sf, "embeddings"), 0.9)


@query("op2_source_mixing", """
WITH sources AS (SELECT source, CAST(sum(length(coalesce(text, '')) + 1) AS DOUBLE) AS units FROM documents GROUP BY source),
sums AS (SELECT sum(units) AS u, sum(pow(units, 0.5)) AS t FROM sources),
rates AS (SELECT source, u / t * pow(units, 0.5) / units AS rate FROM sources, sums),
drawn AS (SELECT d.*, rate, CAST('0x' || substr(md5('20|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
  FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
terms AS (SELECT source, k, sum(exp(-rate + i * ln(rate) - lgamma(i + 1))) AS below
  FROM rates, (SELECT unnest(range(0, 400)) AS k) ks, (SELECT unnest(range(0, 400)) AS i) js WHERE i <= k GROUP BY source, k),
counted AS (SELECT doc_id, text, lang, d.source, n_chars, rate, (SELECT count(*) FROM terms t WHERE t.source IS NOT DISTINCT FROM d.source AND below <= u) AS copies
  FROM drawn d)
SELECT doc_id, text, lang, source, n_chars, CAST(c AS INTEGER) AS _copy, round(rate, 9) AS _rate,
       CAST('0x' || substr(md5('21|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || c), 1, 13) AS BIGINT) / 4503599627370496.0 AS _order
FROM (SELECT *, unnest(range(1, copies + 1)) AS c FROM counted)""")
def op2(spark, sf):
    units = F.length(F.coalesce("text", F.lit(""))) + 1
    return mixing.mix(table(spark, sf, "documents"), units=units).withColumn("_rate", F.round("_rate", 9))


@query("op3_toxicity")
def op3(spark, sf):
    docs = table(spark, sf, "documents")
    model = toxicity.train(docs, table(spark, sf, "labels"), fold("doc_id", 3) != 1)
    out = toxicity.score(docs, model, carry=("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out")))
    return out.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query("op4_pii_pseudonyms")
def op4(spark, sf):
    return pii.pseudonymise(table(spark, sf, "documents").select("doc_id", "text"), "op4", count="n_replaced")


@query("op5_minhash_dedup", f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
nodes AS (SELECT doc_id AS id FROM documents){_REACH}
SELECT id AS doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, component_id = id AS kept
FROM nodes JOIN lowest ON node = id LEFT JOIN sizes ON sizes.doc_id = id""")
def op5(spark, sf):
    return minhash.near_duplicates(table(spark, sf, "documents"), size=3, percent=85)


@query("op6_url_filter", r"""
WITH rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
parts AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
fits AS (SELECT page_id, arg_max(r, length(h || p) * 1000 + length(h)) AS r
  FROM parts JOIN (SELECT *, {'rule': h || p, 'verdict': verdict} AS r FROM rules) ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id)
SELECT page_id, host, path, r.rule AS rule, coalesce(r.verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (page_id)""")
def op6(spark, sf):
    return url_filter.judge(table(spark, sf, "pages"), url_filter.rule_frame(spark))


def _license_sql() -> str:
    rows = ", ".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(licenses.TEMPLATES))
    clean = "trim(regexp_replace(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g'))"
    grams = ("list_distinct(CASE WHEN len(w) = 1 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)")
    return f"""
WITH t AS (SELECT template, license, {grams} AS g FROM (SELECT template, license, string_split({clean.format('text')}, ' ') AS w
  FROM (VALUES {rows}) v(template, license, text))),
lines AS (SELECT doc_id, unnest(list) AS line, generate_subscripts(list, 1) - 1 AS line_no
  FROM (SELECT doc_id, string_split(text, chr(10)) AS list FROM documents WHERE text IS NOT NULL)),
units AS (SELECT doc_id, line_no, {grams} AS g FROM (SELECT doc_id, line_no, string_split({clean.format('line')}, ' ') AS w FROM lines)
  WHERE w <> ['']),
met AS (SELECT doc_id, line_no, license, template, 2.0 * len(list_intersect(u.g, t.g)) / (len(u.g) + len(t.g)) AS dice
  FROM units u JOIN t ON len(u.g) <= 2 * len(t.g) AND len(t.g) <= 2 * len(u.g))
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, license, CAST(template AS INTEGER) AS template, CAST(dice AS DOUBLE) AS dice FROM met WHERE dice >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, line_no ORDER BY dice DESC, template) = 1"""


@query("op7_license_scan", _license_sql())
def op7(spark, sf):
    return licenses.scan(table(spark, sf, "documents"), licenses.template_frame(spark))


@query("op8_fingerprints")
def op8(spark, sf):
    return fingerprint.with_edit(table(spark, sf, "documents"))


@query("op9_byte_bpe")
def op9(spark, sf):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(table(spark, sf, "documents"), path, public_tokenizers.PATTERN, derive=bpe.digests(spark, path)).drop("ids")


@query("op10_language_id")
def op10(spark, sf):
    docs = table(spark, sf, "documents")
    out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    model = langid.train(docs.where(fold("doc_id", 4) != 2), public_tokenizers.path("piece_bpe_32k.model"))
    return langid.identify(docs, model, carry=("doc_id", out))



def _leaf_sql(text: str) -> str:
    field = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR) END"
    return "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# crc32, bit by bit: each byte enters before the first of its eight steps
_ODD_CRC = """list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(d) + 1),
  lambda i: [ascii(d[i])::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1)))"""


@query("op11_merkle_manifest", f"""
WITH RECURSIVE leaves AS (SELECT doc_id, coalesce('s' || source, 'n') AS tree, {_leaf_sql('text')} AS leaf,
    {_leaf_sql("replace(text, chr(10), '')")} AS cleaned, CAST(doc_id AS VARCHAR) AS d FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n,
    CASE WHEN d IS NOT NULL AND xor({_ODD_CRC}, 4294967295) % 2 = 0 THEN cleaned ELSE leaf END AS seen FROM leaves),
low(tree, lvl, pos, n, h) AS (SELECT tree, 0, pos, n, leaf FROM placed
  UNION ALL SELECT tree, lvl + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY tree, lvl, pos // 3),
subroots AS (SELECT tree, lvl AS height, h AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
high(lvl, pos, n, h) AS (SELECT 0, pos, n, subroot FROM subroots
  UNION ALL SELECT lvl + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY lvl, pos // 3),
sides AS (SELECT x.tree, x.lvl, x.pos, coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS l,
    coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS r
  FROM (SELECT * FROM low WHERE n > 1 UNION ALL SELECT NULL, * FROM high WHERE n > 1) x
  JOIN (SELECT * FROM low UNION ALL SELECT NULL, * FROM high) y ON x.tree IS NOT DISTINCT FROM y.tree AND x.lvl = y.lvl AND x.pos // 3 = y.pos // 3
  GROUP BY x.tree, x.lvl, x.pos),
steps(tree, start, lvl, pos, step, h, proof, last) AS (
  SELECT tree, pos, 0, pos, 0, seen, '', false FROM placed
  UNION ALL SELECT s.tree, start, CASE WHEN up THEN 1 ELSE s.lvl + 1 END, (CASE WHEN up THEN o.pos ELSE s.pos END) // 3, step + 1, sha256(d.l || s.h || d.r),
    proof || d.l || d.r, s.last OR up
  FROM (SELECT steps.*, subroots.pos AS own, lvl >= height AND NOT last AS up FROM steps JOIN subroots USING (tree)) s
  JOIN subroots o ON s.tree = o.tree
  JOIN sides d ON d.tree IS NOT DISTINCT FROM (CASE WHEN up OR s.last THEN NULL ELSE s.tree END) AND d.lvl = (CASE WHEN up THEN 0 ELSE s.lvl END)
    AND d.pos = (CASE WHEN up THEN own ELSE s.pos END)),
ended AS (SELECT tree, start, arg_max(h, step) AS folded, sha256(arg_max(proof, step)) AS proof FROM steps GROUP BY tree, start),
top AS (SELECT h AS root FROM high WHERE n = 1)
SELECT doc_id, leaf, subroot, root, proof AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM placed p JOIN ended e ON p.tree = e.tree AND p.pos = e.start JOIN subroots s ON s.tree = p.tree CROSS JOIN top""")
def op11(spark, sf):
    return merkle.manifest(table(spark, sf, "documents"))


@query("op12_best_fit_packing")
def op12(spark, sf):
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, 2048)


def _grams_sql(k: int) -> str:
    return (f"SELECT lang, unnest(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i : i + {k - 1}], ' '))) AS g, {k} AS k"
            f" FROM words WHERE len(w) >= {k}")


@query("op13_phrase_collocations", f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
f AS (SELECT lang, g, k, count(*) AS f FROM ({' UNION ALL '.join(_grams_sql(k) for k in (1, 2, 3, 4))}) GROUP BY ALL HAVING count(*) >= 30),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
c AS (SELECT lang, g, k, f AS a, string_split(g, ' ') AS w FROM f WHERE k > 1),
cuts AS (SELECT c.*, j, array_to_string(w[1:j], ' ') AS gl, array_to_string(w[j+1:], ' ') AS gr FROM c, (SELECT unnest([1, 2, 3]) AS j) WHERE j < k),
scored AS (SELECT cuts.*, x.f AS l, y.f AS r, CAST(2000000 * CAST(a AS HUGEINT) // (x.f + y.f) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.g = gl JOIN f y ON y.lang = cuts.lang AND y.g = gr),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
kept AS (SELECT * FROM lowest s WHERE NOT EXISTS (SELECT 1 FROM c x WHERE x.lang = s.lang AND x.k > s.k
  AND contains(' ' || x.g || ' ', ' ' || s.g || ' ') AND 100 * CAST(x.a AS HUGEINT) >= 80 * CAST(s.a AS HUGEINT)))
SELECT lang, rank, g AS phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(g)) AS rank FROM kept) JOIN total USING (lang) WHERE rank <= 2000""")
def op13(spark, sf):
    return collocations.collocations(table(spark, sf, "documents"))
