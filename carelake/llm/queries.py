"""Registered queries of the operators, over whole tables, with oracle SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.catalog.registry import register
from carelake.llm import (
    collocations, decontaminate, edit_prints, embed_dedup, language, licenses, lm, mixing, passages, simhash, token_frames, toxicity, vector_codes,
)
from carelake.llm.common import crc_mod


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.groups(table(spark, sf, "documents")).select("doc_id", "fingerprint", "component_id")


def op2_lm_score(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score(table(spark, sf, "documents"), crc_mod("doc_id", 7) == 2)


def op3_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = language.fit(docs.where(crc_mod("doc_id", 5) != 0), key=F.col("doc_id"))
    found = docs.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), language.predictions(model, F.col("text")).alias("p"))
    return found.select("doc_id", "held_out", "p.*")


def op4_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.labelled(licenses.scan(table(spark, sf, "documents")))


def op5_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return passages.repeated(table(spark, sf, "documents"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_token_output(spark: SparkSession, sf: str) -> DataFrame:
    return token_frames.digests(token_frames.write_shards(table(spark, sf, "documents"), tokenizer_path()))


def op7_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.drop("row_key").distinct()


def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    learn = docs.where(crc_mod("doc_id", 5) != 0).join(labels.select("doc_id", "toxic").where("toxic IS NOT NULL"), "doc_id")
    model = toxicity.fit(learn, key=F.col("doc_id"))
    scored = docs.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), toxicity.score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op9_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"))


def op10_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embed_dedup.links(table(spark, sf, "embeddings"))


def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))


def op12_edit_prints(spark: SparkSession, sf: str) -> DataFrame:
    return edit_prints.digests(table(spark, sf, "documents"))


def op13_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    return vector_codes.digests(table(spark, sf, "embeddings"))


def _license_sql() -> str:
    """Brute force: every start of every template in every text."""

    def places(t: licenses.Template) -> str:
        text, key, base = t.text.split(), t.key.split(), licenses.key_offset(t)
        here = " AND ".join(f"w[s + {base + k + 1}] = '{x}'" for k, x in enumerate(key))
        part = " + ".join(f"CASE WHEN s + {k + 1} >= 1 AND w[s + {k + 1}] = '{x}' THEN 1 ELSE 0 END" for k, x in enumerate(text))
        return (
            f"list_filter(list_transform(range(-{base}, len(w)), lambda s: {{'label': '{t.label}', 'at': s, 'part': CASE WHEN s + {base} >= 0 "
            f"AND {here} THEN ({part}) / {len(text)}.0::DOUBLE ELSE 0 END}}), lambda x: x.part >= 0.8)"
        )

    base, notices = (" || ".join(map(places, ts)) for ts in (licenses.BASE, licenses.NOTICES))
    return f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
hits AS (SELECT doc_id, len(w) AS n_words, {base} AS b, {notices} AS o FROM words)
SELECT doc_id, n_words, len(b) AS n_base, list_min(list_transform(b, lambda x: x.at)) AS first_word,
  list_max(list_transform(b, lambda x: x.at)) AS last_word,
  array_to_string(list_sort(list_distinct(list_transform(b, lambda x: x.label))), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_transform(b || o, lambda x: x.label))), ',') AS labels,
  coalesce(list_max(list_transform(b || o, lambda x: x.part)), 0.0)::DOUBLE AS score
FROM hits"""


DECONTAMINATE_SQL = """
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark),
places AS (SELECT kind, id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0),
short AS (SELECT DISTINCT len(w) AS m FROM words WHERE kind = 'b' AND len(w) BETWEEN 1 AND 4),
short_places AS (SELECT id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words, short WHERE kind = 'd' AND len(w) >= m),
shingles AS (SELECT kind, id, array_to_string(w[i:i + 4], ' ') AS s FROM places
  UNION SELECT 'd', id, array_to_string(w[i:i + m - 1], ' ') FROM short_places),
sizes AS (SELECT id, count(*) AS n FROM shingles WHERE kind = 'b' GROUP BY id),
pairs AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS shared FROM shingles d JOIN shingles b ON d.s = b.s
  WHERE d.kind = 'd' AND b.kind = 'b' GROUP BY ALL)
SELECT doc_id, item_id, shared, n AS item_shingles, shared::DOUBLE / n AS containment
FROM pairs JOIN sizes ON sizes.id = item_id WHERE shared >= n * 0.8::DOUBLE"""


MIX_SQL = """
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS u FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight, 3 * source_size AS cap FROM sizes),
turns AS (SELECT *, cap::DOUBLE / weight AS turn FROM weighed),
lefts AS (SELECT *,
    sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS left_size,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS left_weight
  FROM turns WINDOW before AS (ORDER BY turn, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
capped AS (SELECT *, turn < left_size::DOUBLE / left_weight AS capped FROM lefts),
free AS (SELECT sum(source_size) - coalesce(sum(cap) FILTER (capped), 0) AS free_size, sum(weight) FILTER (NOT capped) AS free_weight
  FROM capped),
targets AS (SELECT source, source_size,
    CASE WHEN capped THEN cap::DOUBLE ELSE least(free_size::DOUBLE * weight / free_weight, cap::DOUBLE) END AS target
  FROM capped, free),
rests AS (SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS whole FROM targets),
placed AS (
  SELECT d.*, r.source_size, r.target, r.whole, r.target - r.whole * r.source_size AS rest,
    sum(size) OVER (PARTITION BY d.source ORDER BY u) AS upto,
    sum(size) OVER (PARTITION BY d.source, u) AS here
  FROM docs d JOIN rests r ON d.source IS NOT DISTINCT FROM r.source),
cuts AS (SELECT source, min(u) AS value, arg_min(here, u) AS here, arg_min(upto, u) AS upto, any_value(rest) AS rest
  FROM placed WHERE upto > rest GROUP BY source),
chosen AS (
  SELECT p.*, least(whole + CASE WHEN c.value IS NULL OR u < c.value OR (u = c.value AND c.here - (c.rest - (c.upto - c.here))
    < c.rest - (c.upto - c.here)) THEN 1 ELSE 0 END, 3)::BIGINT AS copies
  FROM placed p LEFT JOIN cuts c ON p.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, source, size, source_size, target, copies, copies * size AS taken FROM chosen"""


COLLOCATIONS_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\\x0A-\\x0D]+')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (SELECT lang, unnest([w[i:i + m - 1] FOR m IN range(1, 5) IF i + m - 1 <= len(w)]) AS g FROM starts),
counts AS MATERIALIZED (SELECT lang, g, count(*) AS f FROM grams GROUP BY lang, g HAVING count(*) >= 30),
candidates AS MATERIALIZED (SELECT lang, g, f FROM counts WHERE len(g) > 1),
cuts AS (SELECT lang, g, f, unnest(range(1, len(g))) AS k FROM candidates),
scores AS (
  SELECT c.lang, c.g, c.f AS a, c.k, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.f) // (x.f + y.f))::BIGINT AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.g = c.g[:c.k] JOIN counts y ON y.lang = c.lang AND y.g = c.g[c.k + 1:]),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inside AS (SELECT lang, f, g[i:i + m - 1] AS g FROM candidates, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS i)
  WHERE m < len(g) AND i + m - 1 <= len(g)),
around AS (SELECT lang, g, max(f) AS longer FROM inside GROUP BY lang, g),
ranked AS (
  SELECT s.lang, array_to_string(s.g, ' ') AS phrase, a, l, r, score,
    row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, array_to_string(s.g, ' ')) AS rank
  FROM lowest s LEFT JOIN around x ON x.lang = s.lang AND x.g = s.g
  WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT)
SELECT r.lang, rank, phrase, a, l, r, n, score FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= 2000"""


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Full search in every round."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
near{k} AS MATERIALIZED (
  SELECT r, v.part, min({{'d': list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': c.entry}}) AS best
  FROM vals v JOIN book{k} c ON c.part = v.part GROUP BY r, v.part)""")
        if k < rounds:
            steps.append(f"""
places{k} AS (SELECT n.part, n.best.e AS entry, unnest(x) AS y, generate_subscripts(x, 1) AS pos
  FROM near{k} n JOIN vals v ON v.r = n.r AND v.part = n.part),
means{k} AS (SELECT part, entry, pos, ((sum(y) - ((sum(y) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS y
  FROM places{k} GROUP BY part, entry, pos),
lists{k} AS (SELECT part, entry, list(y ORDER BY pos) AS x FROM means{k} GROUP BY part, entry),
book{k + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.x, c.x) AS x
  FROM book{k} c LEFT JOIN lists{k} m ON m.part = c.part AND m.entry = c.entry)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
vals AS MATERIALIZED (SELECT r, part, q[part * (len(q) // {parts}) + 1:(part + 1) * (len(q) // {parts})] AS x
  FROM kept, (SELECT unnest(range({parts})) AS part)),
book0 AS (SELECT part, r - 1 AS entry, x FROM vals WHERE r <= {entries}),{",".join(steps)},
coded AS (SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM near{rounds} GROUP BY r),
named AS (SELECT vec_id, label, code, error FROM kept JOIN coded ON coded.r = kept.r),
books AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM named, books"""


register("op1_simhash", op1_simhash)
register("op2_lm_score", op2_lm_score)
register("op3_language_id", op3_language_id)
register("op4_license_scan", op4_license_scan, _license_sql())
register("op5_substring_dedup", op5_substring_dedup)
register("op6_token_output", op6_token_output)
register("op7_decontaminate", op7_decontaminate, DECONTAMINATE_SQL)
register("op8_toxicity", op8_toxicity)
register("op9_mix_sources", op9_mix_sources, MIX_SQL)
register("op10_embedding_dedup", op10_embedding_dedup)
register("op11_collocations", op11_collocations, COLLOCATIONS_SQL)
register("op12_edit_prints", op12_edit_prints)
register("op13_vector_codes", op13_vector_codes, _codes_sql())
