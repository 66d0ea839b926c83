"""Registered queries of the training-data operators, with SQL where it can say the same."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwork.llm import (
    chat_format, collocations, decontamination, exact_dedup, license_scan, line_dedup, merkle, mixing, ngram_join, pii,
    token_counts, token_store, toxicity,
)
from duskwork.llm.frames import map_slices, table, texts_of, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE: dict[str, str] = {}


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_spans"
    )


def with_sha256(df: DataFrame, ddl: str) -> DataFrame:
    """Replace ``text`` by kept_sha256; ``ddl`` lists the other columns."""
    names = [field.split()[0] for field in ddl.split(", ")]

    def digest(parts):
        for part in parts:
            yield [*(part.column(n) for n in names), [hashlib.sha256(t.encode()).hexdigest() for t in texts_of(part)]]

    return map_slices(df.select(*names, "text"), digest, f"{ddl}, kept_sha256 string")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_sha256(line_dedup.deduplicated(table(spark, sf_dir, "documents")), "doc_id long, n_lines long, n_dropped long")


ORACLE["op2_line_dedup"] = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS i FROM split),
keyed AS (
  SELECT doc_id, i, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS k
  FROM lines),
owners AS (
  SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines,
  count(*) FILTER (WHERE owner <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE owner IS NULL OR owner = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN owners USING (k) GROUP BY doc_id
"""


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


ORACLE["op3_exact_dedup"] = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.read_documents(token_store.write_shards(table(spark, sf_dir, "documents")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


ORACLE["op7_source_mixing"] = f"""
WITH RECURSIVE sizes AS (
  SELECT source, count(*) AS n, pow(count(*)::DOUBLE, {mixing.POWER}) AS w FROM documents GROUP BY source),
rates AS (
  SELECT source, w / sum(w) OVER () * (sum(n) OVER ())::DOUBLE / n AS rate FROM sizes),
pieces AS (
  SELECT source, greatest(1, ceil(rate / {mixing.PIECE}))::BIGINT AS pieces,
    rate / greatest(1, ceil(rate / {mixing.PIECE})) AS mean FROM rates),
cdf AS (
  SELECT source, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS c FROM pieces
  UNION ALL
  SELECT source, mean, k + 1, p * mean / (k + 1)::DOUBLE, c + p * mean / (k + 1)::DOUBLE FROM cdf WHERE k < {mixing.TERMS}),
counted AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars,
    (SELECT count(*) FROM (SELECT unnest(range(1, p.pieces + 1)) AS piece) x JOIN cdf ON cdf.source = d.source
     WHERE c <= ('0x' || substr(md5('{mixing.SEED}:' || d.doc_id || ':' || piece), 1, 13))::BIGINT::DOUBLE / {1 << 52}.0) AS copies
  FROM documents d JOIN pieces p ON p.source = d.source)
SELECT doc_id, text, lang, source, n_chars, copy,
  md5('{mixing.SEED}:place:' || doc_id || ':' || copy) AS position
FROM (SELECT *, unnest(range(0, copies)) AS copy FROM counted)
"""


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.groups(table(spark, sf_dir, "documents"))


ORACLE["op8_ngram_join"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS sh FROM d),
t AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
b AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM t x JOIN t y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, b.b FROM reach JOIN b ON reach.b = b.a)
SELECT s.doc_id, len(sh) AS n_shingles, c.component_id
FROM s JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


PROBE = "<|im_end|><|im_start|>assistant ok"


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat_format.read_back(written(chat_format.formatted(rows), "chat"))


ORACLE["op10_chat_format"] = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
sized AS (
  SELECT *, length(role) + len(regexp_extract_all(role, '<\\|\\\\*(?:im_start|im_end)\\|>'))
    + length(text) + len(regexp_extract_all(text, '<\\|\\\\*(?:im_start|im_end)\\|>')) + 24 AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.ranked(table(spark, sf_dir, "documents"))


ORACLE["op11_phrases"] = f"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, {collocations.LONGEST} + 1)) AS k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= {collocations.LEAST}),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
inside AS (
  SELECT DISTINCT lang, f, array_to_string(string_split(phrase, ' ')[i:i + m - 1], ' ') AS phrase
  FROM f, (SELECT unnest(range(2, {collocations.LONGEST})) AS m), (SELECT unnest(range(1, {collocations.LONGEST})) AS i)
  WHERE m < k AND i + m - 1 <= k),
c AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f
  WHERE k > 1 AND NOT EXISTS (SELECT 1 FROM inside x WHERE x.lang = f.lang AND x.phrase = f.phrase AND 100 * x.f >= 100 * f.f)),
cuts AS (
  SELECT c.*, cut, l.f AS l, r.f AS r, n.n,
    ((1000::HUGEINT * a * n.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c JOIN n ON n.lang = c.lang
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(ws[:cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(ws[cut + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= {collocations.TOP}
"""


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))


def manifest_sql(levels: int) -> str:
    """Trees of up to ``levels`` levels over documents, unrolled: n(k) has the nodes of level k, s(k) their siblings."""

    def encoded(value: str) -> str:
        return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(encoded, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    crc = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), "
        "lambda r, b: list_reduce(list_prepend(xor(r, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
    )

    def rising(start: str, at: str) -> list[str]:
        parts = [start]
        for k in range(levels):
            n, s = f"{at}{k}", f"{at}s{k}"
            parts.append(
                f"{s} AS (SELECT t, p, n, "
                f"coalesce(string_agg(h, '') OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
                f"coalesce(string_agg(h, '') OVER (b ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r "
                f"FROM {n} WHERE n > 1 WINDOW b AS (PARTITION BY t, p // 8 ORDER BY p))"
            )
            parts.append(
                f"{at}{k + 1} AS (SELECT t, p // 8 AS p, (n + 7) // 8 AS n, sha256(string_agg(h, '' ORDER BY p)) AS h "
                f"FROM {n} WHERE n > 1 GROUP BY t, p // 8, n UNION ALL SELECT t, p, n, h FROM {n} WHERE n = 1)"
            )
        return parts

    ctes = rising(
        f"d AS (SELECT doc_id, lang, {leaf('text')} AS leaf, "
        f"CASE WHEN {crc} % 3 = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {leaf('text')} END AS shown, "
        "dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS p, "
        "count(*) OVER (PARTITION BY lang) AS n FROM documents), a0 AS (SELECT t, p, n, leaf AS h FROM d)", "a")
    ctes += rising(f"b0 AS (SELECT 0 AS t, t AS p, count(*) OVER () AS n, h FROM a{levels})", "b")
    joins, pairs = [], []
    for k in range(levels):
        joins.append(f"LEFT JOIN as{k} ON as{k}.t = d.t AND as{k}.p = d.p // {8 ** k}")
        pairs.append(f"as{k}")
    for k in range(levels):
        joins.append(f"LEFT JOIN bs{k} ON bs{k}.p = d.t // {8 ** k}")
        pairs.append(f"bs{k}")
    folded = "shown"
    steps = []
    for number, pair in enumerate(pairs):
        steps.append(
            f"f{number + 1} AS (SELECT * REPLACE (CASE WHEN l{number} IS NULL THEN folded ELSE sha256(l{number} || folded || r{number}) END AS folded) "
            f"FROM f{number})"
        )
    sides = ", ".join(f"{pair}.l AS l{i}, {pair}.r AS r{i}" for i, pair in enumerate(pairs))
    joined = " || ".join(f"coalesce(l{i} || r{i}, '')" for i in range(len(pairs)))
    start = f"f0 AS (SELECT d.doc_id, d.leaf, {folded} AS folded, a{levels}.h AS subroot, {sides} FROM d JOIN a{levels} ON a{levels}.t = d.t " + " ".join(joins) + ")"
    return (
        "WITH " + ",\n".join([*ctes, start, *steps]) + f"\nSELECT doc_id, leaf, subroot, b{levels}.h AS root, sha256({joined}) AS proof_sha256, "
        f"folded AS folded_root, folded = b{levels}.h AS verified FROM f{len(pairs)} CROSS JOIN b{levels}"
    )


ORACLE["op13_manifest"] = manifest_sql(9)

QUERIES = {
    f.__name__: f
    for f in (
        op1_personal_data, op2_line_dedup, op3_exact_dedup, op4_decontamination, op5_token_store, op6_toxicity, op7_source_mixing,
        op8_ngram_join, op9_license_scan, op10_chat_format, op11_phrases, op12_token_counts, op13_manifest,
    )
}
