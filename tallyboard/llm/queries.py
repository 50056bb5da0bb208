"""The operators of this subpackage bound to the driver's tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.llm import ann, bpe, chats, fingerprint, hamming, jaccard, line_dedup, packing, passages, phrases, pii, quality, spelling
from tallyboard.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: DuckDB: lower-casing of A-Z alone.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def bind(sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql:
            SQL[query.__name__] = sql.strip()
        return query
    return register


@bind(f"""
WITH lines AS (
  SELECT doc_id, unnest(s) AS line, unnest(range(len(s))) AS place
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
keyed AS (SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS kept FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE doc_id < kept) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE kept IS NULL OR doc_id >= kept), '')) AS kept_sha256
FROM keyed LEFT JOIN repeated USING (key) GROUP BY doc_id
""")
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def packed(docs: DataFrame) -> DataFrame:
    """Pieces with the digest of their ids."""
    pieces = packing.pack(docs.select("doc_id", "text"))
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@bind()
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


@bind()
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@bind()
def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


@bind("""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
p AS (
  SELECT conv_id, list({'r': role, 't': text}) OVER w AS turns, count(*) OVER w AS place,
         count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
whole AS (
  SELECT turns, min(conv_id) AS conv_id, any_value(n_turns) AS n_turns, count(*) AS n_copies
  FROM p WHERE place = n_turns GROUP BY turns)
SELECT conv_id, n_turns, n_copies,
       array_to_string(list_transform(turns, lambda x:
         '<|' || coalesce(x.r, '') || '|>' || chr(10) || coalesce(x.t, '') || chr(10)), '') AS rendered
FROM whole ANTI JOIN (SELECT DISTINCT turns FROM p WHERE place < n_turns) USING (turns)
""")
def op5_chat_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.maximal(table(spark, sf_dir, "conversations"))


def fold() -> Column:
    """0 for rows that nothing learns from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5


#: Documents that score at least this are taken as good.
GOOD = 0.3


def quality_weights(spark: SparkSession, docs: DataFrame, sf_dir: str):
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(fold() != 0)
    return quality.train(docs.select("doc_id", "text"), labels)


@bind()
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality_weights(spark, docs, sf_dir), keep=["doc_id"])
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


@bind(f"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) END AS s
  FROM w),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
rare AS (SELECT g FROM one GROUP BY g HAVING count(*) > 1),
shared AS (SELECT one.* FROM one SEMI JOIN rare USING (g)),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shared AS a JOIN shared AS b USING (g) WHERE a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (
  WITH RECURSIVE r(id, seen) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT r.id, pairs.b FROM r JOIN pairs ON pairs.a = r.seen)
  SELECT id, min(seen) AS component_id FROM r GROUP BY id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM s JOIN reach ON id = doc_id
""")
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.similar_groups(table(spark, sf_dir, "documents"), words=3, percent=90)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@bind()
def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = passages.drop_repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in pii.KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def _is(kind: int) -> Callable[[Column], Column]:
    return lambda k: (k == kind).cast("int")


@bind()
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.with_spans(docs, pii.learn(docs)).select("doc_id", "pii_spans")
    base = F.filter("pii_spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    numbers = [F.size(F.array_remove(F.transform(kinds, _is(k)), 0)).cast("long").alias(f"n_{kind}") for k, kind in enumerate(pii.BASE)]
    return found.select("doc_id", *numbers, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("pii_spans")).alias("spans"))


@bind()
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_edit(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


#: DuckDB: one step of the checksum for a byte, by its table of 256 entries.
_CRC_TABLE = """SELECT list_transform(range(256), lambda x: list_reduce(list_concat([x], range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc"""


@bind(f"""
WITH RECURSIVE crc_table AS ({_CRC_TABLE}),
found AS (
  SELECT doc_id, {_LOWER.format("run")} AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents) GROUP BY ALL),
bytes AS (
  SELECT run, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda x:
    CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, unicode(x) - 64] END)) AS b FROM found),
checked AS (
  SELECT run, n, xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295) AS h
  FROM bytes, crc_table),
slipped AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
         ELSE run END AS word, n FROM checked),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words),
less AS (SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest FROM cut),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM less AS a JOIN less AS b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less AS a JOIN words AS b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less AS a JOIN words AS b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS other, max(other_n) AS other_n FROM near GROUP BY word),
formed AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form,
         CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best ON best.word = words.word),
way AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT way.word, formed.form FROM way JOIN formed ON formed.word = way.root WHERE formed.form IS NOT NULL)
SELECT formed.word, form, root, n, n_near, form_n
FROM formed JOIN way ON way.word = formed.word WHERE root IN (SELECT word FROM formed WHERE form IS NULL)
""")
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"), divisor=97)
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


@bind(f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, 1 AS size, unnest(w) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) FROM w
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) FROM w),
f AS (SELECT lang, size, phrase, count(*) AS n FROM grams GROUP BY ALL),
total AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND n >= 10),
cut AS (
  SELECT *, array_to_string(w[1:k], ' ') AS first_part, array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
cuts AS (
  SELECT cut.lang, cut.size, cut.phrase, a, k, x.n AS l, y.n AS r,
         CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.n AS HUGEINT) * y.n) AS BIGINT) AS score
  FROM cut JOIN f AS x ON x.lang = cut.lang AND x.phrase = first_part JOIN f AS y ON y.lang = cut.lang AND y.phrase = rest),
lowest AS (SELECT lang, size, phrase, a, min({{'score': score, 'k': k, 'l': l, 'r': r}}) AS m FROM cuts GROUP BY ALL),
inner_ AS (
  SELECT lang, phrase, max(a) AS around
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM c WHERE size = 3) GROUP BY ALL),
ranked AS (
  SELECT lowest.lang, lowest.phrase, a, m.l AS l, m.r AS r, m.score AS score,
         row_number() OVER (PARTITION BY lowest.lang ORDER BY m.score DESC, a DESC, encode(lowest.phrase)) AS rank
  FROM lowest LEFT JOIN inner_ ON inner_.lang = lowest.lang AND inner_.phrase = lowest.phrase
  WHERE around IS NULL OR 100 * around < 50 * a)
SELECT ranked.lang, rank, phrase, a, l, r, total.n AS n, score FROM ranked JOIN total ON total.lang = ranked.lang WHERE rank <= 2000
""")
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(phrases.frequent_phrases(table(spark, sf_dir, "documents")))


@bind("""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS norm
  FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95),
r(id, seen) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, pairs.b FROM r JOIN pairs ON pairs.a = r.seen),
least AS (SELECT id, min(seen) AS component_id FROM r GROUP BY id)
SELECT vec_id, (SELECT count(*) FROM pairs WHERE pairs.a = embeddings.vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON id = vec_id
""")
def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
